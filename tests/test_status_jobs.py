"""Guards, offset and the CSV job runner."""

import pytest
from conftest import rows

from fleetpulse.operators.status import input_status, window_offset
from fleetpulse.plans.run import NoEventTimeError, run_alert_job
from fleetpulse.schemas import CPU_MEM_ALERT_SCHEMA, CPU_SCHEMA, MEM_SCHEMA
from fleetpulse.session import shared_dir
from fleetpulse.sources.csv_tables import write_table


def _cm(spark, cpu, mem):
    return spark.createDataFrame(cpu, CPU_SCHEMA), spark.createDataFrame(mem, MEM_SCHEMA)


def test_status_values(spark):
    cpu, mem = _cm(spark, [("00:00:07", "a", 1.0), ("bad", "a", 2.0)], [("00:00:13", "b", 1.0)])
    r = input_status(cpu, mem).first()
    assert (r.left_rows, r.right_rows, r.left_timed, r.right_timed, r.earliest, r.window_offset, r.status) == (2, 1, 1, 1, "00:00:07", 7, "ok")


def test_status_no_data_and_no_time(spark):
    cpu, mem = _cm(spark, [], [])
    assert input_status(cpu, mem).first().status == "no data"
    cpu, mem = _cm(spark, [("x", "a", 1.0)], [(None, "b", 1.0)])
    r = input_status(cpu, mem).first()
    assert r.status == "no event time" and r.window_offset == 0 and r.earliest is None


def test_offset_ignores_side_without_time(spark):
    cpu, mem = _cm(spark, [("bad", "a", 1.0)], [("00:01:03", "b", 1.0)])
    assert window_offset(cpu, mem).first().window_offset == 3


def _run(spark, cpu, mem):
    base = shared_dir(spark, "job")
    c, m = _cm(spark, cpu, mem)
    write_table(c, f"{base}/cpu")
    write_table(m, f"{base}/mem")
    return base, run_alert_job(spark, "cpu_mem", f"{base}/cpu", f"{base}/mem", f"{base}/out", single_file=True)


def test_job_no_data(spark):
    _, res = _run(spark, [], [])
    assert res.status == "no data" and res.output is None


def test_job_no_time_raises(spark):
    with pytest.raises(NoEventTimeError):
        _run(spark, [("x", "a", 1.0)], [])


def test_job_one_side_only(spark):
    base, res = _run(spark, [("00:00:05", "a", 90.0), ("00:00:25", "a", 10.0)], [])
    assert res.status == "ok" and res.window_offset == 5 and res.right_rows == 0
    out = spark.read.schema(CPU_MEM_ALERT_SCHEMA).option("header", True).csv(f"{base}/out")
    assert rows(out) == [
        ("a", "00:00:05", "00:00:35", 50.0, None, None),
        ("a", "00:00:15", "00:00:45", 10.0, None, None),
        ("a", "00:00:25", "00:00:55", 10.0, None, None),
    ]
