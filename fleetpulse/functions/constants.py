"""Fixed values that must equal the reference's for identical results.

Everything here is a plain literal; change none of it without changing
what the engine computes.
"""

# --- fixed values: thresholds (defaults of the two batch jobs) -------------
CPU_THRESHOLD = 80.07
MEM_THRESHOLD = 89.36
NET_THRESHOLD = 6104.83
DISK_THRESHOLD = 1839.94

# README thresholds, accepted as caller parameters (L3).
README_CPU_THRESHOLD = 80.0
README_MEM_THRESHOLD = 89.0
README_NET_THRESHOLD = 6100.0
README_DISK_THRESHOLD = 1800.0

# --- fixed values: alert labels ---------------------------------------------
ALERT_CPU_AND_MEM = "CPU and Memory spike"
ALERT_MEM = "Memory saturation suspected"
ALERT_CPU = "CPU spike suspected"
ALERT_NET_AND_DISK = "Network flood + Disk thrash suspected"
ALERT_NET = "Possible DDoS"
ALERT_DISK = "Disk thrash suspected"

# --- fixed values: topics -----------------------------------------------------
TOPIC_CPU = "topic-cpu"
TOPIC_MEM = "topic-mem"
TOPIC_NET = "topic-net"
TOPIC_DISK = "topic-disk"
TOPICS = (TOPIC_CPU, TOPIC_MEM, TOPIC_NET, TOPIC_DISK)

# --- fixed values: windowing ----------------------------------------------------
WINDOW_SECONDS = 30
SLIDE_SECONDS = 10
WARMUP_WINDOWS = 2
ROUND_DIGITS = 2

# --- fixed values: time text ------------------------------------------------------
EPOCH_DATE_PREFIX = "1970-01-01 "
PARSE_FORMAT = "yyyy-MM-dd HH:mm:ss"
LABEL_FORMAT = "HH:mm:ss"
SECONDS_PER_DAY = 86400
