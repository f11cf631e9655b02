"""Table schemas and the per-metric specs that drive the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from .functions import constants as K


def _fields(*spec: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


S = T.StringType()
F32 = T.FloatType()
F64 = T.DoubleType()

# Wide sample table the producer replays.
WIDE_SCHEMA = _fields(
    ("ts", S), ("server_id", S), ("cpu_pct", F64), ("mem_pct", F64),
    ("net_in", F64), ("net_out", F64), ("disk_io", F64),
)

# Kafka-shaped record (S6-S8, P1): the columns the Kafka sink/source use.
RECORD_SCHEMA = _fields(("topic", S), ("key", T.BinaryType()), ("value", T.BinaryType()))
# The same with the time the broker received the record.
TIMED_RECORD_SCHEMA = T.StructType([*RECORD_SCHEMA.fields, T.StructField("timestamp", T.TimestampType(), True)])

# Landed, typed metric tables (S2-S5). Column order matters for CSV.
CPU_SCHEMA = _fields(("ts", S), ("server_id", S), ("cpu_pct", F32))
MEM_SCHEMA = _fields(("ts", S), ("server_id", S), ("mem_pct", F32))
NET_SCHEMA = _fields(("ts", S), ("server_id", S), ("net_in", F64), ("net_out", F64))
DISK_SCHEMA = _fields(("ts", S), ("server_id", S), ("disk_io", F64))

# Alert outputs (L1, L2).
CPU_MEM_ALERT_SCHEMA = _fields(
    ("server_id", S), ("window_start", S), ("window_end", S),
    ("avg_cpu", F32), ("avg_mem", F32), ("alert", S),
)
NET_DISK_ALERT_SCHEMA = _fields(
    ("server_id", S), ("window_start", S), ("window_end", S),
    ("max_net_in", F64), ("max_disk_io", F64), ("alert", S),
)


def with_window_times(schema: T.StructType) -> T.StructType:
    """An alert schema with the window's full start and end after the labels (full event time, D8)."""
    times = [T.StructField(n, T.TimestampNTZType(), True) for n in ("window_start_time", "window_end_time")]
    return T.StructType([*schema.fields[:3], *times, *schema.fields[3:]])


@dataclass(frozen=True)
class Metric:
    """One metric family: its topic, landed columns and window aggregate."""

    name: str
    topic: str
    schema: T.StructType
    measures: tuple[str, ...]  # value columns carried in the landed table
    measure: str  # the one that is aggregated
    dtype: str  # Spark type of the aggregated measure
    agg: str  # "avg" or "max"
    output: str  # name of the rounded aggregate column

    @property
    def value_alias(self) -> str:
        """Name of the measure after the typed projection (P10)."""
        return f"{self.name}_val" if self.agg == "avg" else self.measure


CPU = Metric("cpu", K.TOPIC_CPU, CPU_SCHEMA, ("cpu_pct",), "cpu_pct", "float", "avg", "avg_cpu")
MEM = Metric("mem", K.TOPIC_MEM, MEM_SCHEMA, ("mem_pct",), "mem_pct", "float", "avg", "avg_mem")
NET = Metric("net", K.TOPIC_NET, NET_SCHEMA, ("net_in", "net_out"), "net_in", "double", "max", "max_net_in")
DISK = Metric("disk", K.TOPIC_DISK, DISK_SCHEMA, ("disk_io",), "disk_io", "double", "max", "max_disk_io")

METRICS = {m.name: m for m in (CPU, MEM, NET, DISK)}
METRIC_BY_TOPIC = {m.topic: m for m in (CPU, MEM, NET, DISK)}


@dataclass(frozen=True)
class MetricPair:
    """The two metric families one alert job combines."""

    name: str
    left: Metric
    right: Metric
    output_schema: T.StructType


CPU_MEM = MetricPair("cpu_mem", CPU, MEM, CPU_MEM_ALERT_SCHEMA)
NET_DISK = MetricPair("net_disk", NET, DISK, NET_DISK_ALERT_SCHEMA)
PAIRS = {p.name: p for p in (CPU_MEM, NET_DISK)}
