"""fleetpulse: server-fleet metric windows and alerts on Spark DataFrames."""

from .plans.jobs import alerts, alerts_from_long, combined_windows, cpu_mem_alerts, net_disk_alerts
from .schemas import CPU, CPU_MEM, DISK, MEM, NET, NET_DISK

__all__ = [
    "CPU",
    "CPU_MEM",
    "DISK",
    "MEM",
    "NET",
    "NET_DISK",
    "alerts",
    "alerts_from_long",
    "combined_windows",
    "cpu_mem_alerts",
    "net_disk_alerts",
]
