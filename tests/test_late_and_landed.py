"""Streams give one result at any micro-batch size; landings add up; jobs read guards from them."""

import random

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

import __spark_entry__ as E
from fleetpulse.operators.records import decode, full_event_time, quarantine, record_offset, records_long, route
from fleetpulse.operators.status import input_status, landed_status
from fleetpulse.plans.inspect import plan_text
from fleetpulse.plans.jobs import alerts_from_long, full_time_alerts, kept_windows, long_windows
from fleetpulse.plans.flows import keyed_records
from fleetpulse.plans.run import run_alert_job
from fleetpulse.operators.warmup import drop_warmup
from fleetpulse.schemas import CPU, CPU_MEM, CPU_MEM_ALERT_SCHEMA, MEM, NET_DISK
from fleetpulse.session import shared_dir
from fleetpulse.sources.csv_tables import read_alerts, read_metric, write_table
from fleetpulse.sources.events import event_records, pair_long_table, read_events
from fleetpulse.streaming.ingest import land_stream, landing_counts, read_landed, read_landed_times, read_quarantine, read_record_files
from fleetpulse.streaming.windows import (
    LateRowsError,
    bootstrap_offset,
    close_stream,
    dropped_rows,
    final_watermark,
    input_batches,
    stream_alert_rows,
    stream_alerts,
    stream_session,
)


def _run(spark, base, name, files_per_batch, pair=CPU_MEM):
    own = stream_session(spark, 4)
    batch = decode(spark.read.parquet(f"{base}/records/*"))
    offset = bootstrap_offset(*[route(batch, m) for m in (pair.left, pair.right)])
    src = read_record_files(own, f"{base}/records/*", max_files=files_per_batch)
    q = stream_alerts(stream_alert_rows(long=records_long(decode(src), pair), pair=pair, offset=offset), f"{base}/{name}/out", f"{base}/{name}/ck")
    q.awaitTermination()
    return q, read_alerts(spark, pair.output_schema, f"{base}/{name}/out"), records_long(batch, pair), offset


@pytest.fixture(scope="module")
def by_days(spark):
    """Records of a month in three files by day: the time of day starts over in each."""
    base = shared_dir(spark, "late")
    ev = read_events(spark, SF001)
    for i, (lo, hi) in enumerate([(1, 10), (11, 20), (21, 31)]):
        event_records(ev.filter(F.dayofmonth("ts").between(lo, hi))).coalesce(1).write.parquet(f"{base}/records/{i}")
    return base


@pytest.mark.parametrize("pair", [CPU_MEM, NET_DISK], ids=lambda p: p.name)
def test_one_batch_and_three_give_equal_rows(spark, by_days, pair):
    found = {}
    for name, files in (("one", None), ("three", 1)):
        q, streamed, long, offset = _run(spark, by_days, f"{name}-{pair.name}", files, pair)
        done = close_stream(q, streamed, long, pair, offset)
        found[name] = (rows(done.rows), done.dropped, done.batches)
        if name == "three":
            with pytest.raises(LateRowsError):
                close_stream(q, streamed, long, pair, offset, on_late="fail")
    assert found["one"][0] == found["three"][0] == rows(alerts_from_long(long, pair, offset=offset))
    assert found["one"][1:] == (0, 1)
    assert found["three"][1] > 0 and found["three"][2] == 3


def test_dropped_count_is_not_trusted_when_progress_is_gone(spark, by_days, monkeypatch):
    q, streamed, long, offset = _run(spark, by_days, "gone", None)
    monkeypatch.setattr("fleetpulse.streaming.windows.PROGRESS", 1)
    assert dropped_rows(q) is None and final_watermark(q) is not None and input_batches(q) == 1
    done = close_stream(q, streamed, long, CPU_MEM, offset)
    assert rows(done.rows) == rows(alerts_from_long(long, CPU_MEM, offset=offset))


def test_stream_settings_stay_on_their_session(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    own = stream_session(spark, 3)
    assert own.conf.get("spark.sql.shuffle.partitions") == "3"
    assert {k: spark.conf.get(k, None) for k in before} == before


def test_two_checkpoints_on_one_base_keep_both_landings(spark):
    base = shared_dir(spark, "land-twice")
    recs = event_records(read_events(spark, SF001))
    half = F.pmod(F.xxhash64("value", "key"), F.lit(2))
    for i in (0, 1):
        recs.filter(half == i).repartition(2).write.parquet(f"{base}/in{i}")
        land_stream(read_record_files(spark, f"{base}/in{i}", max_files=1), f"{base}/landed", ("cpu", "mem"), f"{base}/ck{i}").awaitTermination()
    d = decode(recs)
    assert rows(read_landed(spark, "cpu", f"{base}/landed/cpu")) == rows(route(d, CPU))
    want = quarantine(d)
    assert rows(read_quarantine(spark, f"{base}/landed").select("topic", "text")) == rows(want.select("topic", "text"))
    assert {r.topic: r.quarantined for r in landing_counts(spark, f"{base}/landed").collect()}["topic-disk"] == want.count()
    # Guards, offset and result of a job on the landed tables, without a first pass over them.
    times = landed_status(read_landed_times(spark, f"{base}/landed"), CPU_MEM).first()
    assert times == input_status(route(d, CPU), route(d, MEM)).first()
    landed = f"{base}/landed"
    done = run_alert_job(spark, CPU_MEM, f"{landed}/cpu", f"{landed}/mem", f"{base}/out", landed_base=landed)
    out = read_alerts(spark, CPU_MEM_ALERT_SCHEMA, f"{base}/out")
    assert done.rows == out.count() and (done.left_rows, done.right_rows) == (times.left_rows, times.right_rows)
    assert rows(out) == rows(alerts_from_long(records_long(d, CPU_MEM), CPU_MEM))


@pytest.mark.parametrize("seed", [1, 2])
def test_first_event_rule_equals_rank(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice(["a", "b", None, ""]), rnd.randrange(-500, 4000), rnd.choice([None, 1.5, 99.0]), rnd.choice([None, 2.5])) for _ in range(150)]
    long = spark.createDataFrame(data, "server_id string, sec long, l float, r float")
    for offset in (0, 7):
        want = rows(drop_warmup(long_windows(long, CPU_MEM, offset)).select("server_id", "window.start", "avg_cpu", "avg_mem"))
        assert rows(kept_windows(long, CPU_MEM, offset).select("server_id", "window.start", "avg_cpu", "avg_mem")) == want
        since = 1000
        late = [w for w in want if w[1].timestamp() >= since]
        assert rows(kept_windows(long, CPU_MEM, offset, since=since).select("server_id", "window.start", "avg_cpu", "avg_mem")) == late


def test_full_time_plan_gathers_no_server(spark):
    df = full_time_alerts(pair_long_table(read_events(spark, SF001), CPU_MEM, full_time=True), CPU_MEM)
    plan = plan_text(df, "simple")
    keys = [line.split("hashpartitioning(")[1].split("), ")[0] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert keys and "Window" not in plan.replace("window", "")
    # Only the servers' first slots (partial minima, one row a server and task) meet on the server alone.
    alone = [line for line in plan.splitlines() if "hashpartitioning(server_id" in line and "slot" not in line and "ws" not in line]
    assert len(alone) <= 1
    times = df.select("server_id", "window_start_time", "window_end_time")
    assert times.distinct().count() == times.count()


def test_offset_pass_parses_times_only(spark):
    recs = spark.read.parquet(_records(spark))
    df = spark.range(1).select(record_offset(recs, ("topic-cpu", "topic-mem")))
    plan = plan_text(df, "simple")
    assert "original_ts" in plan and "cpu_pct" not in plan and "mem_pct" not in plan


def _records(spark):
    path = f"{shared_dir(spark, 'recs')}/records"
    event_records(read_events(spark, SF001)).write.parquet(path)
    return path


@pytest.mark.parametrize(
    "tod,received,want",
    [
        ("23:59:30", "2024-03-01 00:01:00", "2024-02-29 23:59:30"),
        ("00:00:10", "2024-02-29 23:59:50", "2024-03-01 00:00:10"),
        ("12:00:00", "2024-03-01 12:01:30", "2024-03-01 12:00:00"),
        ("00:00:00", "2024-03-01 11:59:59", "2024-03-01 00:00:00"),
    ],
)
def test_date_of_a_time_of_day(spark, tod, received, want):
    df = spark.range(1).select(full_event_time(F.to_timestamp(F.lit(f"1970-01-01 {tod}")), F.to_timestamp(F.lit(received))).cast("string").alias("t"))
    assert df.first().t == want


def test_a_servers_records_are_sent_in_order_by_one_task(spark):
    data = [(f"{h:02d}:00:0{k}", f"s{k}") for h in random.Random(3).sample(range(24), 24) for k in range(4)]
    cols = "ts string, server_id string, cpu_pct double, mem_pct double, net_in double, net_out double, disk_io double"
    df = spark.createDataFrame([(*r, 1.0, 1.0, 1.0, 1.0, 1.0) for r in data], cols)
    got = keyed_records(df, 3, "00:00:00").withColumn("p", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    ts = F.get_json_object(F.col("value").cast("string"), "$.original_ts").alias("ts")
    by = {}
    for r in got.select(F.col("key").cast("string").alias("k"), "p", "at", ts).orderBy("at").collect():
        by.setdefault(r.k, []).append((r.p, r.ts))
    assert all(len({p for p, _ in v}) == 1 and [t for _, t in v] == sorted(t for _, t in v) for v in by.values()) and len(by) == 4


def test_text_with_line_breaks_survives_csv(spark):
    data = [("10:00:00", s, 1.5) for s in ("a\nb", "a\r\nb", "%0A", "%250A", "%", "%%25", "%2\n5", "plain", None)]
    base = shared_dir(spark, "breaks")
    df = spark.createDataFrame(data, CPU.schema)
    write_table(df, f"{base}/cpu")
    assert rows(read_metric(spark, "cpu", f"{base}/cpu")) == rows(df)


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_ordered_stream_query_runs_three_batches(spark):
    assert E.ARRIVALS >= 3 and E.q_stream_cpu_mem_alerts(spark, SF001).count() > 0
