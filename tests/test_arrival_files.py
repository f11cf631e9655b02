"""Inputs of the stream queries: files and micro-batches as tables grow."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as E
from fleetpulse.operators.records import decode, records_long
from fleetpulse.plans.inspect import plan_text
from fleetpulse.schemas import CPU_MEM


@pytest.fixture
def events(spark, tmp_path, monkeypatch):
    """A table with many more events than a file is to hold here."""
    monkeypatch.setattr(E, "FILE_RECORDS", 160)
    monkeypatch.setattr(E, "FILE_EVENTS", 40)
    monkeypatch.setattr(E, "LEAST_ROWS", 10)
    kinds = F.array(*[F.lit(k) for k in ("click", "view", "purchase", "error", "signup")])
    n = F.col("id")
    spark.range(0, 1200, 1, 2).select(
        n.alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + n * 2000).cast("timestamp_ntz").alias("ts"), (n % 7).alias("user_id"),
        F.element_at(kinds, (n % 5 + 1).cast("int")).alias("event_type"), (n % 100).cast("double").alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def _files(spark, path):
    return len(spark.read.parquet(path).inputFiles())


def test_drops_have_more_files_as_they_grow(spark, events):
    base, files = E._days(spark, events, "drops")
    assert files == 12 and [_files(spark, f"{base}/records/{i}") for i in range(3)] == [12, 12, 12]
    records = E.event_records(E.read_events(spark, events))
    n = E._arrivals(records, E._event_seconds_of(records), f"{base}/again")
    assert n > E.FILES and [_files(spark, f"{base}/again/{i}") for i in range(3)] == [n, n, n]
    assert rows(spark.read.parquet(f"{base}/again/*")) == rows(records)


def test_a_quarantine_s_micro_batches_stay_as_many(spark, events, monkeypatch):
    taken = []
    plain = E.read_record_files
    monkeypatch.setattr(E, "read_record_files", lambda s, path, max_files: taken.append((max_files, _files(s, path))) or plain(s, path, max_files=max_files))
    got = E.q_landed_quarantine(spark, events)
    assert got.count() == 240 and taken == [(8, 16), (8, 16)]


@pytest.mark.parametrize("query", [E.q_landed_states_alerts, E.q_produced_landed_alerts])
def test_produced_records_have_more_files_as_they_grow(spark, events, monkeypatch, query):
    taken = {}

    class Taken(Exception):
        pass

    def consume(*args, **kwargs):
        taken.update(kwargs)
        raise Taken

    monkeypatch.setattr(E, "consume", consume)
    with pytest.raises(Taken):
        query(spark, events)
    got = spark.read.parquet(taken["record_files"])
    assert got.count() == 4800 and got.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 160
    assert taken["max_files"] == -(-_files(spark, taken["record_files"]) // 3) >= 10


@pytest.mark.parametrize("query", [E.q_stream_records_full_time, E.q_stream_cpu_mem_alerts_closed])
def test_a_closed_stream_s_records_are_decoded_once_as_a_batch(spark, events, query):
    assert "from_json" in plan_text(records_long(decode(E.event_records(E.read_events(spark, events))), CPU_MEM))
    got = query(spark, events)
    assert got.count() and "from_json" not in plan_text(got)


def test_shares_and_counts():
    assert E._file_count(25_000, 24_000, E.FILE_EVENTS) == E.FILES and E._file_count(0, 0, E.FILE_EVENTS) == E.FILES
    assert E._file_count(12_000_000, 11_000_000, E.FILE_EVENTS) == 120
    assert E._file_count(12_000_000, 9_000, E.FILE_EVENTS) == 2 * E.FILES
    assert [E._share(4, 2), E._share(4, 4), E._share(3, 3, 2), E._share(1000, 2)] == [2, 1, 2, E.BATCH_FILES]


def test_drops_deal_events_and_build_each_record_once(spark):
    data = [(k % 9 if k % 10 else None, None if k % 7 == 0 else f"2024-01-0{1 + k % 3} 10:00:{k % 60:02d}", k % 4 or None, kind, float(k))
            for k in range(120) for kind in ("click", "error", "signup", "nothing", None)]
    ev = spark.createDataFrame(data * 2, "event_id long, t string, user_id long, event_type string, value double")
    ev = ev.withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    drops, files = E._drops(ev, 3)
    assert files == E.FILES and sum(d.count() for d in drops) == ev.count() and all(d.count() for d in drops)
    sent = E.event_records(drops[0]).unionByName(E.event_records(drops[1])).unionByName(E.event_records(drops[2]))
    whole = E.event_records(ev)
    assert rows(sent) == rows(whole) and whole.count() == 240 * (4 + 5 + 1)
    plan = plan_text(E.event_records(drops[0]), "simple")
    assert plan.count("Generate explode") == 1 and "Union" not in plan and plan.index("Generate explode") < plan.index("xxhash64(event_id")


@pytest.mark.parametrize("timed", [False, True])
def test_events_are_shuffled_not_their_records(spark, events, timed):
    ev = E.read_events(spark, events)
    dealt = E.event_records(ev, timed=timed, tasks=12)
    plan = plan_text(dealt, "simple")
    assert plan.index("Generate explode") < plan.index("RoundRobinPartitioning(12)") and plan.count("RoundRobinPartitioning") == 1
    assert rows(dealt) == rows(E.event_records(ev, timed=timed))


@pytest.mark.parametrize("few", [1, 2])
def test_few_events_fill_all_files_of_a_drop(spark, events, few):
    base = E.shared_dir(spark, "few")
    E._write_drop(E.read_events(spark, events).filter(F.col("event_id").isin(list(range(few)))), E.FILES, f"{base}/records")
    assert _files(spark, f"{base}/records") == E.FILES
