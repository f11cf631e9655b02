"""What a landing caches of a micro-batch, and that its tables and counts come out of it whole."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetpulse.operators.records import decode, quarantine, records_long, route, topic_counts
from fleetpulse.operators.windows import second_states
from fleetpulse.plans.inspect import plan_text
from fleetpulse.schemas import CPU, CPU_MEM, MEM, NET
from fleetpulse.streaming.ingest import decode_batch, topic_summary

GOOD = '{"original_ts": "10:00:0%d", "server_id": "%s", "cpu_pct": 12.5, "mem_pct": "7", "net_in": 3}'
DATA = [
    *[(topic, "k", GOOD % (i, s)) for i, s in enumerate("ab") for topic in ("topic-cpu", "topic-mem", "topic-net", "topic-other", None)],
    ("topic-cpu", None, '{"original_ts": "25:00:00", "server_id": "a", "cpu_pct": "NaN"}'),
    ("topic-mem", "k", '{"server_id": 5, "mem_pct": "x"}'),
    ("topic-net", "k", '{"net_in": 1'),
    ("topic-cpu", "k", "[1]"),
    ("topic-cpu", "k", None),
    (None, None, ""),
]


@pytest.fixture(scope="module")
def records(spark):
    df = spark.createDataFrame(DATA, "topic string, key string, value string")
    return df.select("topic", F.col("key").cast("binary"), F.col("value").cast("binary"), F.timestamp_seconds(F.lit(1704103300)).alias("timestamp"))


@pytest.mark.parametrize("full_time", [False, True])
def test_tables_and_counts_are_those_of_whole_records(spark, records, full_time):
    whole, batch = decode(records), decode_batch(records, ("cpu", "mem"), full_time)
    for m in (CPU, MEM):
        assert rows(route(batch, m)) == rows(route(whole, m))
    assert rows(quarantine(batch)) == rows(quarantine(whole))
    want = second_states(records_long(whole, CPU_MEM, full_time), CPU_MEM)
    assert rows(second_states(records_long(batch, CPU_MEM, sec=F.col("sec")), CPU_MEM)) == rows(want) and want.count() == 2
    counts = topic_summary(batch)
    assert rows(counts.select("topic", "messages", "stored", "quarantined")) == rows(topic_counts(whole))
    first = want.agg(F.min("sec")).first()[0]
    assert {r.topic: (r.timed, r.min_sec) for r in counts.collect()} == {t: (2, first) for t in ("topic-cpu", "topic-mem", "topic-net", "topic-other", None)}


def test_a_batch_holds_what_its_tables_need(spark, records):
    batch = decode_batch(records, ("cpu", "mem"))
    assert set(batch.columns) == {"topic", "valid", "sec", "ts", "server_id", "cpu_pct", "mem_pct", "key", "text"}
    assert batch.filter("valid and (text is not null or key is not null)").isEmpty()
    assert batch.filter("topic = 'topic-net' and (ts is not null or server_id is not null)").isEmpty()
    assert set(decode_batch(records, ("net",)).columns) >= {*NET.measures}
    # One time parse for the states and the commit record.
    cached = batch.persist()
    try:
        for df in (topic_summary(cached), second_states(records_long(cached, CPU_MEM, sec=F.col("sec")), CPU_MEM)):
            above = plan_text(df).split("InMemoryRelation")[0]
            assert "InMemoryTableScan" in above and "gettimestamp" not in above.lower()
    finally:
        cached.unpersist()
