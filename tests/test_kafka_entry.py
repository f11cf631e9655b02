"""Kafka option maps (S6-S8) and the driver entry points."""

import pytest
from conftest import SF001

import __spark_entry__ as E
from fleetpulse.sources import kafka


def test_source_options():
    o = kafka.source_options(["b1:9092", "b2:9092"], kafka.CPU_MEM_TOPICS)
    assert o == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092",
        "subscribe": "topic-cpu,topic-mem",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    assert kafka.source_options("b:9092", kafka.CPU_MEM_TOPICS, fail_on_data_loss=False)["failOnDataLoss"] == "false"
    assert kafka.sink_options("b:9092") == {"kafka.bootstrap.servers": "b:9092", "kafka.acks": "all"}
    assert kafka.source_options("b:9092", kafka.NET_DISK_TOPICS, min_partitions=64)["minPartitions"] == "64"


class _Reader:
    """Stands where Spark's reader does and notes what is asked of it."""

    def __init__(self):
        self.asked = {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **opts):
        self.asked["options"] = opts
        return self

    def load(self):
        return self

    def select(self, *cols):
        self.asked["columns"] = cols
        return self


class _Session:
    def __init__(self):
        self.read, self.readStream = _Reader(), _Reader()


def test_readers_are_built_with_the_options():
    s = _Session()
    kafka.read_topics(s, "b:9092", kafka.NET_DISK_TOPICS, min_partitions=8)
    assert s.readStream.asked["format"] == "kafka" and s.read.asked == {}
    assert s.readStream.asked["columns"] == ("topic", "key", "value", "timestamp")
    assert s.readStream.asked["options"] == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "topic-net,topic-disk", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "minPartitions": "8", "maxOffsetsPerTrigger": str(kafka.MAX_OFFSETS),
    }
    s = _Session()
    kafka.read_topics(s, "b:9092", kafka.CPU_MEM_TOPICS, streaming=False, fail_on_data_loss=False)
    assert s.readStream.asked == {}
    assert s.read.asked["options"] == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "topic-cpu,topic-mem", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "endingOffsets": "latest",
    }


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["server_id", "window_start", "window_end", "avg_cpu", "avg_mem", "alert"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert all(n == "pipeline" or n.startswith("op") for n in set(q) - set(o))


@pytest.mark.parametrize("name", ["window_offset", "input_status", "topic_counts", "empty_metric_landed", "job_guards", "sorted_alerts"])
def test_small_queries_run(spark, name):
    assert E.queries()[name](spark, SF001).count() >= 1
