"""Streaming (T2-T5, S9-S11): micro-batches with restart, stream = batch on closed windows."""

import os

from conftest import SF001
from pyspark.sql import functions as F

from fleetpulse import cpu_mem_alerts
from fleetpulse.operators.records import decode, route
from fleetpulse.schemas import CPU, CPU_MEM_ALERT_SCHEMA, MEM, NET
from fleetpulse.session import shared_dir
from fleetpulse.sources.csv_tables import read_metric
from fleetpulse.sources.events import event_records, read_events
from fleetpulse.streaming.ingest import land_stream, metric_stream, read_record_files
from fleetpulse.streaming.windows import bootstrap_offset, enable_state_store, stream_alert_rows, stream_alerts, stream_session


def _split_records(spark, base):
    """Records of the first and second half of the day, as two file drops."""
    recs = decode(event_records(read_events(spark, SF001)))
    raw = event_records(read_events(spark, SF001))
    sec = F.unix_seconds(F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), F.get_json_object(F.col("value").cast("string"), "$.original_ts"))))
    early = raw.filter(sec < 43200)
    late = raw.filter((sec >= 43200) | sec.isNull())
    return recs, early, late


def test_landing_two_batches_and_restart(spark):
    base = shared_dir(spark, "land2")
    _, early, late = _split_records(spark, base)
    early.write.parquet(f"{base}/in/1")
    land_stream(read_record_files(spark, f"{base}/in/*"), f"{base}/landed", ("cpu", "mem"), f"{base}/ck").awaitTermination()
    n1 = read_metric(spark, "cpu", f"{base}/landed/cpu", recursive=True).count()
    late.write.parquet(f"{base}/in/2")
    # restart from the same checkpoint: only the new files are read
    land_stream(read_record_files(spark, f"{base}/in/*"), f"{base}/landed", ("cpu", "mem"), f"{base}/ck").awaitTermination()
    cpu = read_metric(spark, "cpu", f"{base}/landed/cpu", recursive=True)
    batches = [d for d in os.listdir(f"{base}/landed/cpu") if d.startswith("batch=")]
    assert len(batches) == 2 and 0 < n1 < cpu.count()
    want = route(decode(spark.read.parquet(f"{base}/in/*")), CPU)
    assert cpu.exceptAll(want).count() == 0 and want.exceptAll(cpu).count() == 0


def test_empty_metric_lands_typed(spark):
    base = shared_dir(spark, "landempty")
    event_records(read_events(spark, SF001)).filter(F.col("topic") == "topic-cpu").write.parquet(f"{base}/in")
    land_stream(read_record_files(spark, f"{base}/in"), f"{base}/landed", ("cpu", "mem"), f"{base}/ck").awaitTermination()
    mem = read_metric(spark, "mem", f"{base}/landed/mem", recursive=True)
    assert mem.count() == 0 and mem.columns == ["ts", "server_id", "mem_pct"]


def test_stream_equals_batch_on_closed_windows(spark):
    base = shared_dir(spark, "salerts")
    enable_state_store(spark)
    _, early, late = _split_records(spark, base)
    early.write.parquet(f"{base}/in/1")
    late.write.parquet(f"{base}/in/2")
    d = decode(spark.read.parquet(f"{base}/in/*"))
    cpu_b, mem_b = route(d, CPU), route(d, MEM)
    off = bootstrap_offset(cpu_b, mem_b)

    def run():
        s = read_record_files(spark, f"{base}/in/*", max_files=1)
        rows_ = stream_alert_rows(metric_stream(s, "cpu"), metric_stream(s, "mem"), offset=off, watermark="60 seconds")
        stream_alerts(rows_, f"{base}/out", f"{base}/ck").awaitTermination()

    run()
    run()  # a restart with nothing new changes nothing
    got = spark.read.schema(CPU_MEM_ALERT_SCHEMA).option("header", True).csv(f"{base}/out")
    batch = cpu_mem_alerts(cpu_b, mem_b, offset=off)
    assert got.exceptAll(batch).count() == 0
    missing = batch.exceptAll(got).collect()
    # only windows still open behind the final watermark are missing
    assert len(missing) <= 10 and all(r.window_end >= "23:5" for r in missing)
    assert got.count() > 2000


def test_stream_plus_closing_windows_is_batch(spark):
    from fleetpulse.operators.records import records_long
    from fleetpulse.schemas import CPU_MEM
    from fleetpulse.streaming.windows import closing_windows, final_watermark

    base = shared_dir(spark, "closing")
    enable_state_store(spark)
    event_records(read_events(spark, SF001)).write.parquet(f"{base}/in")
    s = read_record_files(spark, f"{base}/in")
    q = stream_alerts(stream_alert_rows(long=records_long(decode(s), CPU_MEM), offset=0), f"{base}/out", f"{base}/ck")
    q.awaitTermination()
    wm = final_watermark(q)
    assert wm is not None
    streamed = spark.read.schema(CPU_MEM_ALERT_SCHEMA).option("header", True).csv(f"{base}/out")
    long = records_long(decode(spark.read.parquet(f"{base}/in")), CPU_MEM)
    tail = closing_windows(long, CPU_MEM, 0, wm)
    batch = cpu_mem_alerts(*[route(decode(spark.read.parquet(f"{base}/in")), m) for m in (CPU, MEM)], offset=0)
    both = streamed.unionByName(tail)
    assert tail.count() > 0
    assert both.exceptAll(batch).count() == 0 and batch.exceptAll(both).count() == 0


def test_batch_landing_and_parquet_landing(spark):
    from fleetpulse.sources.csv_tables import land_metrics
    from fleetpulse.streaming.ingest import landing_counts, read_landed

    base = shared_dir(spark, "landbatch")
    recs = event_records(read_events(spark, SF001))
    d = decode(recs)
    paths = land_metrics(d, f"{base}/csv", ("net", "disk"))
    net = read_metric(spark, "net", paths["net"])
    assert net.exceptAll(route(d, NET)).count() == 0 and route(d, NET).exceptAll(net).count() == 0
    recs.write.parquet(f"{base}/in")
    land_stream(read_record_files(spark, f"{base}/in"), f"{base}/pq", ("cpu",), f"{base}/ck", fmt="parquet").awaitTermination()
    cpu = read_landed(spark, "cpu", f"{base}/pq/cpu", fmt="parquet")
    assert cpu.columns == ["ts", "server_id", "cpu_pct"]
    assert cpu.exceptAll(route(d, CPU)).count() == 0 and route(d, CPU).exceptAll(cpu).count() == 0
    counts = {r.topic: (r.messages, r.stored, r.quarantined) for r in landing_counts(spark, f"{base}/pq").collect()}
    assert counts["topic-disk"][2] > 0 and counts["topic-other"][1] == 0


def test_full_time_stream_runs_past_midnight(spark):
    """On full event times a stream crosses days without dropping the next
    day's rows as late; stream + closing windows = batch."""
    from fleetpulse.plans.jobs import alerts_from_long
    from fleetpulse.schemas import CPU_MEM
    from fleetpulse.sources.events import EVENTS_SCHEMA, pair_long_table, read_events_at
    from fleetpulse.streaming.windows import closing_windows, final_watermark

    base = shared_dir(spark, "fullday")
    enable_state_store(spark)
    ev = read_events(spark, SF001)
    ev.filter("ts < timestamp_ntz'2024-01-16 00:00:00'").write.parquet(f"{base}/in/1")
    ev.filter("ts >= timestamp_ntz'2024-01-16 00:00:00'").write.parquet(f"{base}/in/2")
    long_batch = pair_long_table(read_events_at(spark, f"{base}/in/*"), CPU_MEM, full_time=True)
    off = int(long_batch.agg(F.pmod(F.min("sec"), F.lit(10)).alias("o")).first().o)
    src = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    q = stream_alerts(stream_alert_rows(long=pair_long_table(src, CPU_MEM, full_time=True), offset=off), f"{base}/out", f"{base}/ck")
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2
    streamed = spark.read.schema(CPU_MEM_ALERT_SCHEMA).option("header", True).csv(f"{base}/out")
    both = streamed.unionByName(closing_windows(long_batch, CPU_MEM, off, final_watermark(q)))
    batch = alerts_from_long(long_batch, CPU_MEM, offset=off)
    assert both.exceptAll(batch).count() == 0 and batch.exceptAll(both).count() == 0
    assert streamed.count() > 0.9 * batch.count()


def test_stream_plan_aggregates_slots_before_expanding(spark):
    """Raw rows are shuffled once as slot partial states; only slots are
    expanded into their three windows (two chained stateful aggregations)."""
    from fleetpulse.operators.records import records_long
    from fleetpulse.plans.inspect import plan_text
    from fleetpulse.schemas import CPU_MEM
    from fleetpulse.streaming.windows import stream_windows_long

    base = shared_dir(spark, "splan")
    event_records(read_events(spark, SF001)).write.parquet(f"{base}/in")
    df = stream_windows_long(records_long(decode(read_record_files(spark, f"{base}/in")), CPU_MEM), CPU_MEM)
    lines = plan_text(df, "simple").splitlines()
    expand = [i for i, ln in enumerate(lines) if "Expand [" in ln]
    exchanges = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    assert sum("StateStoreSave" in ln for ln in lines) == 2
    assert len(expand) == 1 and len(exchanges) == 2 and expand[0] < exchanges[-1]
    assert sum("from_json(" in ln for ln in lines) == 1


def test_state_partitions_fixed_in_checkpoint_only(spark):
    import glob
    import json

    from fleetpulse.operators.records import records_long
    from fleetpulse.schemas import CPU_MEM

    base = shared_dir(spark, "stateparts")
    own = stream_session(spark, 3)
    event_records(read_events(spark, SF001)).write.parquet(f"{base}/in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows_ = stream_alert_rows(long=records_long(decode(read_record_files(own, f"{base}/in")), CPU_MEM))
    stream_alerts(rows_, f"{base}/out", f"{base}/ck").awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    meta = [json.loads(ln) for ln in open(sorted(glob.glob(f"{base}/ck/offsets/[0-9]*"))[0]) if ln.startswith("{")]
    assert any(m.get("conf", {}).get("spark.sql.shuffle.partitions") == "3" for m in meta)
