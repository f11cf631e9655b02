"""Streaming ingest and landing.

A stream of (topic, key, value) records comes from Kafka
(`sources.kafka.read_topics`) or, here and in tests, from a folder of
record files. Decoding and routing are the batch operators unchanged:
they are stateless column expressions.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import constants as K
from ..functions import event_seconds, parse_time_of_day
from ..operators.records import decode, full_event_time, quarantine, records_long, route
from ..operators.windows import merged_states, second_states
from ..schemas import METRIC_BY_TOPIC, METRICS, PAIRS, RECORD_SCHEMA, TIMED_RECORD_SCHEMA, Metric, MetricPair
from ..sources.csv_tables import CSV_WRITE_OPTIONS, one_line, read_table
from .commits import Landing, commit, folder, is_committed, landed_topics, landing

QUARANTINE = "quarantine"
QUARANTINE_SCHEMA = "topic string, key binary, text string"

#: Files per micro-batch unless told otherwise: bounds what a batch holds.
MAX_FILES = 1000


def read_record_files(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = MAX_FILES, timed: bool = False
) -> DataFrame:
    """Stream of records from files of (topic, key, value) rows.

    `timed=True` also reads the column `timestamp`, the time a broker
    received the record. `max_files=None` reads all files there are in
    one micro-batch.
    """
    r = spark.readStream.schema(TIMED_RECORD_SCHEMA if timed else RECORD_SCHEMA).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint; it stays the same over restarts."""
    text = "".join(r.value for r in spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect())
    return json.loads(text)["id"]


def metric_stream(records: DataFrame, metric: str) -> DataFrame:
    """Landed-table rows of one metric from a record stream."""
    return route(decode(records), METRICS[metric])


def decode_batch(records: DataFrame, metrics: tuple[str, ...], full_time: bool = False) -> DataFrame:
    """A micro-batch's records as its tables need them: topic, valid, the event second `sec` of
    valid ones, `ts`, `server_id` and the metrics' measures on their topics, and key and text of
    those that did not decode. All else is left out, as a cache pays for each value."""
    landed = [METRICS[n] for n in metrics]
    measures = tuple(dict.fromkeys(m for metric in landed for m in metric.measures))
    valid, ours = F.col("valid"), F.col("topic").isin(*[m.topic for m in landed])
    sec = F.unix_seconds(full_event_time(parse_time_of_day("ts"), F.col("timestamp"))) if full_time else event_seconds("ts")
    return decode(records, measures).select(
        "topic",
        "valid",
        F.when(valid, sec).alias("sec"),
        *[F.when(valid & ours, F.col(c)).alias(c) for c in ("ts", "server_id", *measures)],
        *[F.when(~valid, F.col(c)).alias(c) for c in ("key", "text")],
    )


def topic_summary(decoded: DataFrame) -> DataFrame:
    """Per topic what a commit record holds, from `decode_batch`: the counts of `topic_counts` (A9),
    and of the valid records those with a readable time and the earliest event second (A1, A2)."""
    return decoded.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("topic").isin(*K.TOPICS) & F.col("valid")).alias("stored"),
        F.count_if(~F.col("valid")).alias("quarantined"),
        F.count("sec").alias("timed"),
        F.min("sec").alias("min_sec"),
    )


def states_table(pair: MetricPair) -> str:
    """Name of the table of a pair's landed states."""
    return f"states/{pair.name}"


def states_schema(pair: MetricPair) -> T.StructType:
    fields = [T.StructField("server_id", T.StringType()), T.StructField("sec", T.LongType())]
    for m, side in ((pair.left, "l"), (pair.right, "r")):
        own = [("sum", T.DoubleType()), ("n", T.LongType())] if m.agg == "avg" else [("max", T.DoubleType())]
        fields += [T.StructField(f"{side}_{n}", t) for n, t in own]
    return T.StructType([*fields, T.StructField("hour", T.LongType())])


def landed_pairs(metrics: tuple[str, ...]) -> list[MetricPair]:
    """Pairs of which a landing has both metrics."""
    return [p for p in PAIRS.values() if {p.left.name, p.right.name} <= set(metrics)]


def _write_table(rows: DataFrame, path: str, fmt: str) -> None:
    w = (one_line(rows) if fmt == "csv" else rows).write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV_WRITE_OPTIONS).csv(path)
    else:
        w.format(fmt).save(path)


def _write_states(states: DataFrame, path: str) -> None:
    """States by the hour of their second: a later reader opens the hours it needs."""
    hour = F.floor(F.col("sec") / 3600).cast("long")
    states.withColumn("hour", hour).hint("rebalance", "hour").write.mode("overwrite").partitionBy("hour").parquet(path)


def land_stream(
    records: DataFrame,
    base_path: str,
    metrics: tuple[str, ...],
    checkpoint: str,
    available_now: bool = True,
    fmt: str = "csv",
    publish: dict[str, str] | None = None,
    full_time: bool = False,
) -> StreamingQuery:
    """Land each metric of a record stream as its own table.

    One query reads the source once per micro-batch; the batch is decoded
    once and routed to every metric table. A micro-batch writes into its
    own folders `<table>/batch=<checkpoint's id>-<batch id>`:

    - every metric's rows, empty or not, so a metric without records is
      still a readable, typed table (S11);
    - `states/<pair>` for each pair with both metrics: mergeable states
      of each server's seconds (A4-A7), from which a job computes its
      windows at any offset without reading the rows again;
    - `quarantine`, if a payload did not decode (`read_quarantine`).

    The commit record comes last and makes them count together. It also
    holds the batch's counts and earliest times (`landing_counts`,
    `read_landed_times`). A batch replayed after a failure overwrites
    folders that no record names, or finds its own record and is done:
    exactly-once output on top of the checkpointed source offsets. A new
    checkpoint has a new id and adds to what is there.

    `publish` maps a pair's name to a folder of published alerts, which is
    brought up to date after every commit (`published.refresh`).
    `full_time=True` takes dates from the records' `timestamp` (D8) for
    states and times.

    The batch is cached while its tables are written (`decode_batch`); the
    source's limit per trigger bounds it. `fmt="csv"` (with header) is the reference's
    landing format; use `"parquet"` at scale. Read a landed table back
    with `read_landed`.
    """
    base = base_path.rstrip("/")
    ids: list[str] = []

    def _land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = not ids
        if first:
            ids.append(checkpoint_id(spark, checkpoint))
        name = f"{ids[0]}-{batch_id:012d}"
        # Only the first batch of a run can be one that was cut off.
        if not (first and is_committed(spark, base, name)):
            _land_batch(batch, base, name, metrics, fmt, full_time)
        if publish:
            from .published import refresh

            for pair, out in publish.items():
                refresh(spark, base, PAIRS[pair], out, full_time=full_time)

    w = records.writeStream.foreachBatch(_land).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _land_batch(batch: DataFrame, base: str, name: str, metrics: tuple[str, ...], fmt: str, full_time: bool) -> None:
    decoded = decode_batch(batch, metrics, full_time).persist()
    try:
        tables = list(metrics)
        for metric in metrics:
            _write_table(route(decoded, METRICS[metric]), folder(base, metric, name), fmt)
        for pair in landed_pairs(metrics):
            _write_states(second_states(records_long(decoded, pair, sec=F.col("sec")), pair), folder(base, states_table(pair), name))
            tables.append(states_table(pair))
        topics = topic_summary(decoded).persist()
        try:
            if not topics.filter("quarantined > 0").isEmpty():
                quarantine(decoded).write.mode("overwrite").parquet(folder(base, QUARANTINE, name))
                tables.append(QUARANTINE)
            commit(topics, base, name, tables)
        finally:
            topics.unpersist()
    finally:
        decoded.unpersist()


def _read_folders(spark: SparkSession, schema, root: str, paths: list[str]) -> DataFrame:
    """Rows of commits' folders of the table at `root`, in the columns of the schema."""
    empty = spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(empty.columns) if paths else empty


def _read_metric_folders(spark: SparkSession, metric: Metric, paths: list[str], fmt: str) -> DataFrame:
    return read_table(spark, metric, paths, fmt) if paths else spark.createDataFrame([], metric.schema)


def read_landed(spark: SparkSession, metric: Metric | str, path: str, fmt: str = "csv") -> DataFrame:
    """A metric table landed by `land_stream`: the folders that its landing's commit records name.

    `path` is the table's folder, `<base>/<metric>`.
    """
    base, _, table = path.rstrip("/").rpartition("/")
    return _read_metric_folders(spark, METRICS[metric] if isinstance(metric, str) else metric, landing(spark, base).paths(table), fmt)


def read_states(spark: SparkSession, landed: Landing, pair: MetricPair, names: list[str] | None = None) -> DataFrame:
    """Landed states of a pair: server_id, sec, the states, hour; of all commits or of those named.

    A server's second has a row for each commit that saw it.
    """
    table = states_table(pair)
    return _read_folders(spark, states_schema(pair), f"{landed.base}/{table}", landed.paths(table, names))


def landing_counts(spark: SparkSession, base_path: str) -> DataFrame:
    """Messages received, records stored and quarantined per topic over all
    landed micro-batches (A9 for a stream), restarts included."""
    return landed_topics(spark, base_path).groupBy("topic").agg(
        F.sum("messages").alias("messages"),
        F.sum("stored").alias("stored"),
        F.sum("quarantined").alias("quarantined"),
    )


def read_quarantine(spark: SparkSession, base_path: str) -> DataFrame:
    """Records that did not decode in any landed micro-batch: topic, key, text."""
    base = base_path.rstrip("/")
    return _read_folders(spark, QUARANTINE_SCHEMA, f"{base}/{QUARANTINE}", landing(spark, base).paths(QUARANTINE))


def read_landed_times(spark: SparkSession, base_path: str) -> DataFrame:
    """Rows, timed rows and earliest event second of each metric and commit of a landing."""
    metric = F.create_map(*[F.lit(x) for t, m in METRIC_BY_TOPIC.items() for x in (t, m.name)])[F.col("topic")]
    rows = landed_topics(spark, base_path).withColumn("metric", metric).filter(F.array_contains("tables", F.col("metric")))
    return rows.select("metric", F.col("stored").alias("rows"), "timed", "min_sec")


def compact(spark: SparkSession, base_path: str, fmt: str = "csv") -> str | None:
    """Turn all commits of a landing into one (S9, S10). Returns its name, or None if there are fewer than two.

    Tables are rewritten in files of the size that adaptive execution
    aims at, states of one second become one row, counts are summed. The
    new commit record takes the place of the old ones in one step; a
    reader sees the old folders or the new ones. The old folders stay for
    readers that are under way; nothing names them any more.
    """
    base = base_path.rstrip("/")
    now = landing(spark, base)
    if len(now.tables) < 2:
        return None
    name = f"compact-{uuid.uuid4().hex}"
    held = sorted(set().union(*now.tables.values()))
    for table in held:
        to = folder(base, table, name)
        if table in METRICS:
            _write_table(_read_metric_folders(spark, METRICS[table], now.paths(table), fmt).hint("rebalance"), to, fmt)
        elif table == QUARANTINE:
            _read_folders(spark, QUARANTINE_SCHEMA, f"{base}/{table}", now.paths(table)).hint("rebalance").write.parquet(to)
        else:
            pair = next(p for p in PAIRS.values() if states_table(p) == table)
            _write_states(read_states(spark, now, pair).groupBy("server_id", "sec").agg(*merged_states(pair)), to)
    summed = landed_topics(spark, base).filter(F.col("name").isin(list(now.tables))).groupBy("topic").agg(
        *[F.sum(c).alias(c) for c in ("messages", "stored", "quarantined", "timed")], F.min("min_sec").alias("min_sec")
    )
    commit(summed, base, name, held, tuple(now.tables))
    return name
