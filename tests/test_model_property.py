"""Random inputs: both plan forms and the one-scan path equal the brute-force model."""

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import model
from fleetpulse import cpu_mem_alerts, net_disk_alerts
from fleetpulse.operators.windows import tagged_long_form
from fleetpulse.plans.jobs import alerts_from_long
from fleetpulse.schemas import CPU_MEM, CPU_SCHEMA, DISK_SCHEMA, MEM_SCHEMA, NET_SCHEMA

times = st.one_of(
    st.integers(0, 150).map(lambda k: model.hms(20 * 3600 + 7 * k)),
    st.integers(0, 25).map(lambda k: model.hms(3 * k)),
    st.sampled_from(["9:05:00", "24:00:00", "", "20:00:00.5", None]),
)
servers = st.sampled_from(["s1", "s2", "s3", None])
cpu_vals = st.one_of(st.none(), st.sampled_from([80.07, 89.36, 0.0, 100.0]), st.integers(1, 10000).map(lambda k: k / 100))
net_vals = st.one_of(st.none(), st.sampled_from([6104.83, 6104.824, 1839.94, 1839.936, 0.0]), st.integers(0, 900000).map(lambda k: k / 100))


def _norm(rs):
    return sorted(rs, key=lambda t: tuple((x is not None, x) for x in t))


SETTINGS = settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(times, servers, cpu_vals), max_size=60), st.lists(st.tuples(times, servers, cpu_vals), max_size=60))
def test_cpu_mem_matches_model(spark, left, right):
    cpu, mem = spark.createDataFrame(left, CPU_SCHEMA), spark.createDataFrame(right, MEM_SCHEMA)
    want = _norm(model.alerts(left, right, "cpu_mem", (80.07, 89.36)))
    assert rows(cpu_mem_alerts(cpu, mem)) == want
    assert rows(cpu_mem_alerts(cpu, mem, form="join")) == want
    both = cpu.select("ts", "server_id", F.col("cpu_pct"), F.lit(None).cast("float").alias("mem_pct"), F.lit(0).alias("side")).unionByName(
        mem.select("ts", "server_id", F.lit(None).cast("float").alias("cpu_pct"), "mem_pct", F.lit(1).alias("side"))
    )
    long = tagged_long_form(both, CPU_MEM, F.col("side") == 0, F.col("side") == 1)
    assert rows(alerts_from_long(long, CPU_MEM)) == want


@SETTINGS
@given(st.lists(st.tuples(times, servers, net_vals), max_size=60), st.lists(st.tuples(times, servers, net_vals), max_size=60))
def test_net_disk_matches_model(spark, left, right):
    net = spark.createDataFrame([(t, s, v, 1.0) for t, s, v in left], NET_SCHEMA)
    disk = spark.createDataFrame(right, DISK_SCHEMA)
    want = _norm(model.alerts(left, right, "net_disk", (6104.83, 1839.94)))
    assert rows(net_disk_alerts(net, disk)) == want
    assert rows(net_disk_alerts(net, disk, form="join")) == want
