"""Landed CSV tables survive a write/read round trip (S2-S5, S12): quoting,
nulls and float values, for every metric schema."""

import struct

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetpulse.schemas import CPU_SCHEMA, NET_SCHEMA
from fleetpulse.session import shared_dir
from fleetpulse.sources.csv_tables import read_metric, write_table

text = st.one_of(st.none(), st.sampled_from(["s1", "a,b", 'q"uote', "  pad ", "x\ty", "ünï", "a\nb", "c\r\nd", "%0A", "50%"]))
times = st.one_of(st.none(), st.sampled_from(["20:52:00", "00:00:05", "9:05:00"]))
doubles = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64, min_value=-1e12, max_value=1e12))


def _f32(x):
    return None if x is None else struct.unpack("f", struct.pack("f", x))[0]


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(times, text, doubles), max_size=30),
    st.lists(st.tuples(times, text, doubles, doubles), max_size=30),
)
def test_csv_round_trip(spark, cpu_rows, net_rows):
    base = shared_dir(spark, "csvprop")
    cpu = [(t, s, _f32(v)) for t, s, v in cpu_rows]
    write_table(spark.createDataFrame(cpu, CPU_SCHEMA), f"{base}/cpu")
    assert rows(read_metric(spark, "cpu", f"{base}/cpu")) == rows(spark.createDataFrame(cpu, CPU_SCHEMA))
    write_table(spark.createDataFrame(net_rows, NET_SCHEMA), f"{base}/net")
    assert rows(read_metric(spark, "net", f"{base}/net")) == rows(spark.createDataFrame(net_rows, NET_SCHEMA))
