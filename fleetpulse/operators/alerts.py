"""Alert labelling (L1, L2, L3) and output shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..schemas import CPU_MEM, MetricPair


def _null_text() -> Column:
    return F.lit(None).cast("string")


def _bounds(full_time: bool) -> list[Column]:
    """Window bounds as `HH:mm:ss` text (P14 struct access + P15), and with
    full event times (D8) also as timestamps: labels alone lose the date."""
    labels = [
        F.date_format(F.col("window.start"), K.LABEL_FORMAT).alias("window_start"),
        F.date_format(F.col("window.end"), K.LABEL_FORMAT).alias("window_end"),
    ]
    if not full_time:
        return labels
    return [
        *labels,
        F.col("window.start").cast("timestamp_ntz").alias("window_start_time"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end_time"),
    ]


def cpu_mem_alert(cpu: Column, mem: Column, cpu_threshold: float, mem_threshold: float) -> Column:
    """L1. A missing side does not block an alert on the present side."""
    c_hot = cpu >= F.lit(float(cpu_threshold))
    m_hot = mem >= F.lit(float(mem_threshold))
    return (
        F.when(c_hot & m_hot, F.lit(K.ALERT_CPU_AND_MEM))
        .when(m_hot, F.lit(K.ALERT_MEM))
        .when(c_hot, F.lit(K.ALERT_CPU))
        .otherwise(_null_text())
    )


def net_disk_alert(net: Column, disk: Column, net_threshold: float, disk_threshold: float) -> Column:
    """L2. Single-side branches need the other side below its threshold,
    so a missing side (null comparison) gives no alert."""
    nt, dt = F.lit(float(net_threshold)), F.lit(float(disk_threshold))
    return (
        F.when((net >= nt) & (disk >= dt), F.lit(K.ALERT_NET_AND_DISK))
        .when((net >= nt) & (disk < dt), F.lit(K.ALERT_NET))
        .when((disk >= dt) & (net < nt), F.lit(K.ALERT_DISK))
        .otherwise(_null_text())
    )


def label_cpu_mem(
    df: DataFrame,
    cpu_threshold: float = K.CPU_THRESHOLD,
    mem_threshold: float = K.MEM_THRESHOLD,
    full_time: bool = False,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """CPU/MEM output rows (L1 + P14-P16), and the columns `carried` along.

    Thresholds are tested on the rounded double averages; the float cast
    (P16) comes after, as in the reference: float(80.07) < 80.07 but the
    rounded double average of 80.07f is exactly 80.07.
    """
    cpu, mem = F.col("avg_cpu"), F.col("avg_mem")
    return df.select(
        "server_id",
        *_bounds(full_time),
        cpu.cast("float").alias("avg_cpu"),
        mem.cast("float").alias("avg_mem"),
        cpu_mem_alert(cpu, mem, cpu_threshold, mem_threshold).alias("alert"),
        *carried,
    )


def label_net_disk(
    df: DataFrame,
    net_threshold: float = K.NET_THRESHOLD,
    disk_threshold: float = K.DISK_THRESHOLD,
    full_time: bool = False,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """NET/DISK output rows (L2 + P14-P16), and the columns `carried` along."""
    net, disk = F.col("max_net_in"), F.col("max_disk_io")
    return df.select(
        "server_id",
        *_bounds(full_time),
        net.cast("double").alias("max_net_in"),
        disk.cast("double").alias("max_disk_io"),
        net_disk_alert(net, disk, net_threshold, disk_threshold).alias("alert"),
        *carried,
    )


def label(
    windows: DataFrame,
    pair: MetricPair,
    thresholds: tuple[float, float] | None = None,
    full_time: bool = False,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Output rows of a pair, with its default thresholds unless given (L3)."""
    if pair.name == CPU_MEM.name:
        return label_cpu_mem(windows, *(thresholds or (K.CPU_THRESHOLD, K.MEM_THRESHOLD)), full_time, carried)
    return label_net_disk(windows, *(thresholds or (K.NET_THRESHOLD, K.DISK_THRESHOLD)), full_time, carried)
