"""Goldens G1 (CPU/MEM) and G2 (NET/DISK) from FIXTURES.md, both plan forms."""

import pytest
from conftest import rows

from fleetpulse import cpu_mem_alerts, net_disk_alerts
from fleetpulse.schemas import CPU_MEM_ALERT_SCHEMA, CPU_SCHEMA, DISK_SCHEMA, MEM_SCHEMA, NET_DISK_ALERT_SCHEMA, NET_SCHEMA

CPU_ROWS = [
    ("20:52:03", "s1", 80.07), ("20:52:13", "s1", 80.07), ("20:52:23", "s1", 80.07),
    ("20:52:33", "s1", 10.0), ("20:52:43", "s1", None), ("9:05:00", "s1", 99.0),
    ("", "s1", 99.0), ("00:00:05", "s2", 95.0), ("00:00:15", "s2", 95.0),
    ("21:00:05", "s3", 90.0),
]
MEM_ROWS = [
    ("20:52:03", "s1", 89.36), ("20:52:13", "s1", 89.36), ("20:52:23", "s1", 50.0),
    ("20:52:53", "s1", 95.0), ("00:00:05", "s2", 10.0), ("21:00:05", "s3", 95.0),
]
G1 = [
    ("s1", "20:51:55", "20:52:25", 80.07, 76.24, "CPU spike suspected"),
    ("s1", "20:52:05", "20:52:35", 56.71, 69.68, None),
    ("s1", "20:52:15", "20:52:45", 45.03, 50.0, None),
    ("s1", "20:52:25", "20:52:55", 10.0, 95.0, "Memory saturation suspected"),
    ("s1", "20:52:35", "20:53:05", None, 95.0, "Memory saturation suspected"),
    ("s1", "20:52:45", "20:53:15", None, 95.0, "Memory saturation suspected"),
    ("s2", "00:00:05", "00:00:35", 95.0, 10.0, "CPU spike suspected"),
    ("s2", "00:00:15", "00:00:45", 95.0, None, "CPU spike suspected"),
    ("s3", "21:00:05", "21:00:35", 90.0, 95.0, "CPU and Memory spike"),
]

NET_ROWS = [
    ("10:00:00", "s1", 100.0, 1.0), ("10:00:10", "s1", 6104.83, -5.0), ("10:00:20", "s1", 6104.824, 9e9),
    ("10:00:30", "s1", 9000.0, None), ("10:01:30", "s1", 9000.0, 0.0), ("11:00:00", "s2", 5.0, 3.0),
]
DISK_ROWS = [
    ("10:00:00", "s1", 1839.94), ("10:00:10", "s1", 10.0), ("10:00:20", "s1", 10.0),
    ("10:00:40", "s1", 1839.936), ("11:00:00", "s2", 2000.0),
]
G2 = [
    ("s1", "10:00:00", "10:00:30", 6104.83, 1839.94, "Network flood + Disk thrash suspected"),
    ("s1", "10:00:10", "10:00:40", 9000.0, 10.0, "Possible DDoS"),
    ("s1", "10:00:20", "10:00:50", 9000.0, 1839.94, "Network flood + Disk thrash suspected"),
    ("s1", "10:00:30", "10:01:00", 9000.0, 1839.94, "Network flood + Disk thrash suspected"),
    ("s1", "10:00:40", "10:01:10", None, 1839.94, None),
    ("s1", "10:01:10", "10:01:40", 9000.0, None, None),
    ("s1", "10:01:20", "10:01:50", 9000.0, None, None),
    ("s1", "10:01:30", "10:02:00", 9000.0, None, None),
    ("s2", "11:00:00", "11:00:30", 5.0, 2000.0, "Disk thrash suspected"),
]


def _f32(x):
    import struct

    return None if x is None else struct.unpack("f", struct.pack("f", x))[0]


@pytest.fixture(scope="module")
def cpu_mem(spark):
    return spark.createDataFrame(CPU_ROWS, CPU_SCHEMA), spark.createDataFrame(MEM_ROWS, MEM_SCHEMA)


@pytest.fixture(scope="module")
def net_disk(spark):
    return spark.createDataFrame(NET_ROWS, NET_SCHEMA), spark.createDataFrame(DISK_ROWS, DISK_SCHEMA)


@pytest.mark.parametrize("form", ["slots", "join"])
def test_g1_cpu_mem(cpu_mem, form):
    out = cpu_mem_alerts(*cpu_mem, form=form)
    assert out.schema == CPU_MEM_ALERT_SCHEMA
    want = [(s, a, b, _f32(c), _f32(m), al) for s, a, b, c, m, al in G1]
    assert rows(out) == sorted(want, key=lambda t: tuple((x is not None, x) for x in t))


@pytest.mark.parametrize("form", ["slots", "join"])
def test_g2_net_disk(net_disk, form):
    out = net_disk_alerts(*net_disk, form=form)
    assert out.schema == NET_DISK_ALERT_SCHEMA
    assert rows(out) == sorted(G2, key=lambda t: tuple((x is not None, x) for x in t))


def test_net_out_does_not_matter(spark, net_disk):
    net, disk = net_disk
    from pyspark.sql import functions as F

    changed = net.withColumn("net_out", F.lit(123456.0))
    assert rows(net_disk_alerts(changed, disk)) == rows(net_disk_alerts(net, disk))


def test_readme_thresholds(cpu_mem):
    out = cpu_mem_alerts(*cpu_mem, cpu_threshold=80.0, mem_threshold=89.0)
    got = {(r.server_id, r.window_start): r.alert for r in out.collect()}
    # 76.24 < 89 still; 80.07 >= 80 -> CPU spike
    assert got[("s1", "20:51:55")] == "CPU spike suspected"
    assert got[("s3", "21:00:05")] == "CPU and Memory spike"


def test_explicit_offset_matches_derived(cpu_mem):
    assert rows(cpu_mem_alerts(*cpu_mem, offset=5)) == rows(cpu_mem_alerts(*cpu_mem))


def test_empty_inputs_give_no_rows(spark):
    cpu = spark.createDataFrame([], CPU_SCHEMA)
    mem = spark.createDataFrame([], MEM_SCHEMA)
    assert cpu_mem_alerts(cpu, mem).count() == 0


def test_one_side_empty(spark, cpu_mem):
    cpu, _ = cpu_mem
    mem = spark.createDataFrame([], MEM_SCHEMA)
    a = rows(cpu_mem_alerts(cpu, mem))
    b = rows(cpu_mem_alerts(cpu, mem, form="join"))
    assert a == b and all(r[4] is None for r in a)
