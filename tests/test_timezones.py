"""Results do not depend on the session time zone (times are wall-clock text)."""

import pytest
from conftest import SF001, rows

from fleetpulse import cpu_mem_alerts
from fleetpulse.operators.records import decode, route
from fleetpulse.operators.status import window_offset
from fleetpulse.schemas import CPU, CPU_MEM_ALERT_SCHEMA, CPU_SCHEMA, MEM, MEM_SCHEMA
from fleetpulse.session import shared_dir
from fleetpulse.sources.events import event_records, read_events
from fleetpulse.streaming.ingest import metric_stream, read_record_files
from fleetpulse.streaming.windows import enable_state_store, stream_alert_rows, stream_alerts
from test_alerts_golden import CPU_ROWS, MEM_ROWS

ZONES = ["Asia/Kolkata", "America/Los_Angeles", "Pacific/Kiritimati"]


@pytest.fixture
def zone(spark, request):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", old)


def _utc_rows(spark, fn):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        return fn()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("zone", ZONES, indirect=True)
def test_batch_same_in_every_zone(spark, zone):
    cpu, mem = spark.createDataFrame(CPU_ROWS, CPU_SCHEMA), spark.createDataFrame(MEM_ROWS, MEM_SCHEMA)
    want = _utc_rows(spark, lambda: rows(cpu_mem_alerts(cpu, mem)))
    assert rows(cpu_mem_alerts(cpu, mem)) == want
    assert rows(cpu_mem_alerts(cpu, mem, form="join")) == want
    r = window_offset(cpu, mem).first()
    assert (r.earliest, r.window_offset) == ("00:00:05", 5)


@pytest.mark.parametrize("zone", ["Asia/Kolkata"], indirect=True)
def test_stream_keeps_early_morning_east_of_utc(spark, zone):
    base = shared_dir(spark, "tzstream")
    enable_state_store(spark)
    event_records(read_events(spark, SF001)).write.parquet(f"{base}/in")
    s = read_record_files(spark, f"{base}/in")
    stream_alerts(stream_alert_rows(metric_stream(s, "cpu"), metric_stream(s, "mem"), offset=0), f"{base}/out", f"{base}/ck").awaitTermination()
    got = spark.read.schema(CPU_MEM_ALERT_SCHEMA).option("header", True).csv(f"{base}/out")
    d = decode(spark.read.parquet(f"{base}/in"))
    batch = cpu_mem_alerts(route(d, CPU), route(d, MEM), offset=0)
    assert got.exceptAll(batch).count() == 0
    assert batch.exceptAll(got).count() <= 10
    assert got.filter("window_start < '05:00:00'").count() > 0
