"""Random landed rows as streams: streamed rows + closing windows = batch result.

Covers null servers (D3), bad times, null values and gaps on the stream
path: two chained window aggregations and the per-server warm-up state.
"""

from conftest import rows
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

import model
from fleetpulse import cpu_mem_alerts
from fleetpulse.operators.event_time import with_event_time
from fleetpulse.operators.windows import long_form
from fleetpulse.schemas import CPU, CPU_MEM, CPU_MEM_ALERT_SCHEMA, CPU_SCHEMA, MEM, MEM_SCHEMA
from fleetpulse.session import shared_dir
from fleetpulse.streaming.windows import (
    bootstrap_offset,
    closing_windows,
    enable_state_store,
    final_watermark,
    stream_alert_rows,
    stream_alerts,
)

times = st.one_of(
    st.integers(0, 120).map(lambda k: model.hms(6 * 3600 + 13 * k)),
    st.sampled_from(["9:05:00", "", None]),
)
servers = st.sampled_from(["s1", "s2", None])
vals = st.one_of(st.none(), st.integers(0, 10000).map(lambda k: k / 100))


@settings(max_examples=4, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@example(  # null servers only: the warm-up state is keyed by a null server id
    left=[("06:00:00", None, 50.0), ("06:00:20", None, 90.0), ("06:01:00", None, 95.0), ("06:02:10", "s1", 81.0)],
    right=[("06:00:05", None, 95.0), ("9:05:00", None, 99.0)],
)
@given(st.lists(st.tuples(times, servers, vals), min_size=1, max_size=50), st.lists(st.tuples(times, servers, vals), max_size=50))
def test_stream_plus_closing_is_batch(spark, left, right):
    base = shared_dir(spark, "sprop")
    enable_state_store(spark)
    spark.createDataFrame(left, CPU_SCHEMA).write.parquet(f"{base}/cpu")
    spark.createDataFrame(right, MEM_SCHEMA).write.parquet(f"{base}/mem")
    cpu_b, mem_b = spark.read.parquet(f"{base}/cpu"), spark.read.parquet(f"{base}/mem")
    off = bootstrap_offset(cpu_b, mem_b)
    cpu_s = spark.readStream.schema(CPU_SCHEMA).parquet(f"{base}/cpu")
    mem_s = spark.readStream.schema(MEM_SCHEMA).parquet(f"{base}/mem")
    q = stream_alerts(stream_alert_rows(cpu_s, mem_s, CPU_MEM, offset=off), f"{base}/out", f"{base}/ck")
    q.awaitTermination()
    streamed = spark.read.schema(CPU_MEM_ALERT_SCHEMA).option("header", True).csv(f"{base}/out")
    long_b = long_form(with_event_time(cpu_b, CPU), with_event_time(mem_b, MEM), CPU_MEM)
    both = streamed.unionByName(closing_windows(long_b, CPU_MEM, off, final_watermark(q)))
    assert rows(both) == rows(cpu_mem_alerts(cpu_b, mem_b, offset=off))
