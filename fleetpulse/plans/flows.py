"""End-to-end flows of the three roles: producer, consumer, alert job.

Each is a short composition of the operators; the Kafka ends are the
thin adapters of `sources.kafka`, and every flow also runs on files of
(topic, key, value) records, which is how it is tested here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.records import fan_out, fan_out_of, replay_order
from ..session import shared_dir
from ..sources.csv_tables import read_samples
from ..sources.kafka import CPU_MEM_TOPICS, MAX_OFFSETS, NET_DISK_TOPICS, read_topics, write_topics
from ..streaming.ingest import MAX_FILES, land_stream, read_record_files

CONSUMER_TOPICS = {"cpu_mem": CPU_MEM_TOPICS, "net_disk": NET_DISK_TOPICS}
CONSUMER_METRICS = {"cpu_mem": ("cpu", "mem"), "net_disk": ("net", "disk")}


def producer_records(samples: DataFrame, stamp: Column | str | None = None) -> DataFrame:
    """Wide samples -> (topic, key, value) records in replay order.

    The rows of the result are in `ts` order over its partitions. A write
    runs those partitions at the same time, so for the order inside a
    Kafka partition use `publish_samples`.
    """
    return fan_out(replay_order(samples), stamp)


def keyed_records(samples: DataFrame, partitions: int, stamp: Column | str | None = None) -> DataFrame:
    """Records dealt out by server, each server's in `ts` order (P5).

    All of a server's records are in one partition and so are sent by one
    task, one after another: a server that holds a large share of all
    samples makes that task long. `publish_epochs` bounds it.
    """
    return fan_out(_dealt(samples.filter(F.col("ts").isNotNull()), partitions), stamp)


def _dealt(samples: DataFrame, partitions: int) -> DataFrame:
    return samples.repartition(partitions, "server_id").sortWithinPartitions("ts", "server_id")


def replay_epochs(samples: DataFrame, epoch_rows: int) -> DataFrame:
    """Stretches of the replay that are short for every server: ts, epoch (from 0, in the order of ts), alone.

    Each second weighs as many rows as the server with most rows in it; an
    epoch ends where the weights pass `epoch_rows`, so no server has more
    rows in it than that and one second's. A second that weighs more is an
    epoch `alone`: its rows are tied, any order of them is a replay order.

    The sums run over one row for each ts text, at most 86,400 for times
    of day, however many samples there are.
    """
    counts = samples.filter(F.col("ts").isNotNull()).groupBy("ts", "server_id").agg(F.count("*").alias("n"))
    seconds = counts.groupBy("ts").agg(F.max("n").alias("weight")).withColumn("alone", F.col("weight") > epoch_rows)
    before = Window.orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.count_if("alone").over(before), F.lit(0))
    light = F.coalesce(F.sum(F.when(F.col("alone"), 0).otherwise(F.col("weight"))).over(before), F.lit(0))
    placed = seconds.select("ts", "alone", passed.alias("passed"), F.floor(light / F.lit(epoch_rows)).alias("part"))
    # Light seconds with p epochs alone behind them, then the next epoch alone, and so on.
    turn = F.struct((2 * F.col("passed") + F.col("alone").cast("long")).alias("turn"), F.when(~F.col("alone"), F.col("part")).alias("part"))
    return placed.select("ts", (F.dense_rank().over(Window.orderBy(turn)) - 1).cast("long").alias("epoch"), "alone")


def publish_epochs(
    samples: DataFrame,
    write: Callable[[DataFrame, int], None],
    epoch_rows: int,
    partitions: int,
    stamp: Column | str | None = None,
) -> int:
    """Send records in `ts` order per server, an epoch after the other; returns the number of epochs (P5).

    Within an epoch each server's records are one task's, at most about
    `epoch_rows` of them; the next epoch starts when all tasks are done, so
    a server's records stay in order however large its share is.
    `write(records, epoch)` sends one epoch. Samples are written once, by
    epoch, under the shared folder, so an epoch reads its own alone: from
    a few files, however many tasks wrote them. What is the same for all
    epochs is built before the first.
    """
    spark = samples.sparkSession
    base = shared_dir(spark, "epochs")
    epochs = replay_epochs(samples, epoch_rows)
    epochs.write.parquet(f"{base}/epochs")
    epochs = spark.read.schema(epochs.schema).parquet(f"{base}/epochs")
    samples.join(epochs.drop("alone"), "ts").hint("rebalance", "epoch").write.partitionBy("epoch").parquet(f"{base}/samples")
    alone = {r.epoch: r.alone for r in epochs.select("epoch", "alone").distinct().collect()}  # one row for each epoch
    reader, fanned = spark.read.schema(samples.schema), fan_out_of(samples.columns, stamp)
    for epoch in sorted(alone):
        part = reader.parquet(f"{base}/samples/epoch={epoch}")
        write(fanned(part.repartition(partitions) if alone[epoch] else _dealt(part, partitions)), epoch)
    return len(alone)


def publish_samples(
    spark: SparkSession, samples_path: str, servers, stamp: str | None = None, partitions: int = 200, epoch_rows: int | None = None
) -> None:
    """Producer: read the sample CSV and publish four records per sample, each server's in order.

    `epoch_rows` publishes epoch by epoch (`publish_epochs`): for servers
    that hold a large share of all samples.
    """
    samples = read_samples(spark, samples_path)
    if epoch_rows is None:
        write_topics(keyed_records(samples, partitions, stamp), servers)
    else:
        publish_epochs(samples, lambda records, _: write_topics(records, servers), epoch_rows, partitions, stamp)


def consume(
    spark: SparkSession,
    role: str,
    base_path: str,
    checkpoint: str,
    servers=None,
    record_files: str | None = None,
    fmt: str = "csv",
    min_partitions: int | None = None,
    max_offsets: int | None = MAX_OFFSETS,
    max_files: int | None = MAX_FILES,
) -> StreamingQuery:
    """Consumer: subscribe to a role's two topics and land them.

    Reads Kafka when `servers` is given, else a folder of record files.
    Runs `availableNow`: drains what is there and stops; a rerun resumes
    from the checkpoint. `max_offsets` or `max_files` bounds a micro-batch.
    """
    if servers is not None:
        records = read_topics(spark, servers, CONSUMER_TOPICS[role], streaming=True, min_partitions=min_partitions, max_offsets=max_offsets)
    elif record_files is not None:
        records = read_record_files(spark, record_files, max_files=max_files)
    else:
        raise ValueError("give Kafka servers or a record folder")
    return land_stream(records, base_path, CONSUMER_METRICS[role], checkpoint, fmt=fmt)
