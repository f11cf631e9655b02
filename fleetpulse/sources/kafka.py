"""Kafka adapters.

Thin wrappers over Spark's own Kafka source and sink; they only fix the
options the reference uses. The Kafka connector package must be on the
cluster's class path (`spark-sql-kafka-0-10`); it is not bundled with
PySpark and is not installed in this build environment, so only the
option maps and the (topic, key, value) shape are tested here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import constants as K

CPU_MEM_TOPICS = (K.TOPIC_CPU, K.TOPIC_MEM)
NET_DISK_TOPICS = (K.TOPIC_NET, K.TOPIC_DISK)

#: Records per micro-batch of a stream unless told otherwise.
MAX_OFFSETS = 5_000_000


def source_options(
    servers: str | list[str],
    topics: tuple[str, ...],
    starting: str = "earliest",
    min_partitions: int | None = None,
    max_offsets: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Subscribe to `topics` from the earliest offset.

    The reference's consumer group with auto-commit becomes the stream's
    checkpoint (offsets are stored there, so a restarted query resumes);
    its 30 s idle stop becomes `trigger(availableNow=True)`: read what is
    there, then stop. A query fails when the broker has already aged out offsets
    it has not read; `fail_on_data_loss=False` skips them unread instead.
    `max_offsets` bounds the records of a micro-batch.

    Spark reads one task per Kafka partition by default, and the
    reference's topics have two partitions. `min_partitions` (for
    example the cluster's core count) has Spark split each partition's
    offset range over more tasks, so decoding scales past the broker's
    partition count.
    """
    bootstrap = servers if isinstance(servers, str) else ",".join(servers)
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


def sink_options(servers: str | list[str]) -> dict[str, str]:
    """Publish acknowledged by all in-sync replicas."""
    bootstrap = servers if isinstance(servers, str) else ",".join(servers)
    return {"kafka.bootstrap.servers": bootstrap, "kafka.acks": "all"}


def read_topics(
    spark: SparkSession,
    servers,
    topics: tuple[str, ...],
    streaming: bool = True,
    min_partitions: int | None = None,
    max_offsets: int | None = MAX_OFFSETS,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Records (topic, key, value, timestamp) from Kafka, as a stream or a batch.

    `timestamp` is the record's own in Kafka; with it a record's time of
    day gets its date (`records.full_event_time`).
    """
    reader = spark.readStream if streaming else spark.read
    opts = source_options(servers, topics, min_partitions=min_partitions, max_offsets=max_offsets if streaming else None, fail_on_data_loss=fail_on_data_loss)
    if not streaming:
        opts["endingOffsets"] = "latest"
    return reader.format("kafka").options(**opts).load().select("topic", "key", "value", "timestamp")


def write_topics(records: DataFrame, servers, checkpoint: str | None = None):
    """Publish (topic, key, value) records. Batch write, or a started
    streaming query when `records` is a stream (needs `checkpoint`)."""
    cols = records.select("topic", "key", "value")
    if records.isStreaming:
        if checkpoint is None:
            raise ValueError("a streaming write needs a checkpoint location")
        return (
            cols.writeStream.format("kafka")
            .options(**sink_options(servers))
            .option("checkpointLocation", checkpoint)
            .start()
        )
    cols.write.format("kafka").options(**sink_options(servers)).save()
    return None
