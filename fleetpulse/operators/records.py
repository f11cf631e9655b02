"""Kafka-shaped records: fan-out, encode, decode, route, counts.

A record is (topic string, key binary, value binary), the column set the
Kafka source produces and the Kafka sink takes, so the same operators
serve a Kafka stream, a file stream of records and a batch table.
Everything is built-in column expressions: JSON goes through
`to_json`/`from_json`, never through Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import event_seconds, nan_to_null, once, parse_time_of_day
from ..schemas import METRICS, Metric, MetricPair

CORRUPT = "_corrupt_record"
ALL_MEASURES = ("cpu_pct", "mem_pct", "net_in", "net_out", "disk_io")


def replay_order(samples: DataFrame) -> DataFrame:
    """Samples in ascending `ts` text order, null `ts` dropped (P5).

    The producer sends one `ts` group after another in this order. The
    server id is a second sort key: it orders samples inside a group and
    lets the range partitioner split a `ts` value that holds a large
    share of all rows over several tasks.
    """
    return samples.filter(F.col("ts").isNotNull()).orderBy("ts", "server_id")


def message_key(server_id: Column) -> Column:
    """Key bytes = server id as UTF-8 text; null or empty id -> null key."""
    text = server_id.cast("string")
    return F.when(text == F.lit(""), F.lit(None)).otherwise(text).cast("binary")


def encode_value(metric: Metric, stamp: Column) -> Column:
    """JSON object of one metric's message.

    Null fields are written as `null` (not dropped) and NaN measures as
    `null` (decision D5), so every message has the full field set.
    """
    fields = [
        stamp.alias("timestamp"),
        F.col("ts").alias("original_ts"),
        F.col("server_id").cast("string").alias("server_id"),
        *[nan_to_null(F.col(m).cast("double")).alias(m) for m in metric.measures],
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def send_stamp() -> Column:
    """Send time as `HH:mm:ss`; the default stamp of `fan_out`."""
    return F.date_format(F.current_timestamp(), K.LABEL_FORMAT)


def record(topic: str, value: Column) -> Column:
    """One record of a sample: struct of topic and value text."""
    return F.struct(F.lit(topic).alias("topic"), value.alias("value"))


def metric_records(stamp: Column | str | None = None) -> list[Column]:
    """The `record` of each metric of a sample."""
    st = send_stamp() if stamp is None else (F.lit(stamp) if isinstance(stamp, str) else stamp)
    return [record(m.topic, encode_value(m, st)) for m in METRICS.values()]


def fan_out(samples: DataFrame, stamp: Column | str | None = None, records: list[Column] | None = None) -> DataFrame:
    """One wide sample -> four (topic, key, value) records.

    `stamp` is the send-time text; pass a literal for deterministic
    output. A column `timestamp` (the broker's time) is carried along.
    Narrow (no shuffle): a Generate over each input partition. `records`
    are sent in place of `metric_records`; those that are null are not.
    """
    return fan_out_of(samples.columns, stamp, records)(samples)


def fan_out_of(
    columns: list[str], stamp: Column | str | None = None, records: list[Column] | None = None
) -> Callable[[DataFrame], DataFrame]:
    """`fan_out` for samples with these columns, built once for many inputs: on a small one the building takes longer than the job."""
    carried = [c for c in ("timestamp",) if c in columns]
    recs = F.array(*(metric_records(stamp) if records is None else records))
    fanned = (message_key(F.col("server_id")).alias("key"), *carried, F.explode(recs).alias("r"))
    out = (F.col("r.topic").alias("topic"), F.col("key"), F.col("r.value").cast("binary").alias("value"), *carried)
    return lambda samples: samples.select(*fanned).filter(F.col("r").isNotNull()).select(*out)


def _value_schema(measures: tuple[str, ...] = ALL_MEASURES) -> T.StructType:
    names = ["original_ts", "server_id", *measures, CORRUPT]
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def decode(records: DataFrame, measures: tuple[str, ...] = ALL_MEASURES) -> DataFrame:
    """Parse every record's UTF-8 JSON value once.

    Output: `topic`, `key`, `valid`, `ts` (from `original_ts`),
    `server_id` and all measures as double. Fields are read as text and
    then `try_cast`, so `12.5` and `"12.5"` both give 12.5 (D12), a
    number id gives its text, missing fields give null, and `NaN` or
    non-numeric text gives null (D5). `valid` is false for text that is
    not a JSON object (bad JSON, arrays, scalars, empty): such rows are
    excluded from metric tables and kept for `quarantine` (D1).

    `measures` names the measures to parse; none of them is enough for
    counts, times and validity. A column `timestamp` of the records (the
    broker's time) is carried along.
    """
    text = F.col("value").cast("string")
    j = F.from_json(text, _value_schema(measures), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    carried = [c for c in ("timestamp",) if c in records.columns]
    # Parse once: as a plain projection, every later filter on a parsed
    # field (validity, topic routing, time) would be pushed below it with
    # the parse copied in, one parse per predicate (see `once`).
    parsed = records.select("topic", "key", *carried, text.alias("text"), once(j).alias("j"))
    valid = F.col("j").isNotNull() & F.col(f"j.{CORRUPT}").isNull()
    return parsed.select(
        "topic",
        "key",
        "text",
        *carried,
        valid.alias("valid"),
        F.col("j.original_ts").alias("ts"),
        F.col("j.server_id").alias("server_id"),
        *[nan_to_null(F.col(f"j.{m}").try_cast("double")).alias(m) for m in measures],
    )


def record_offset(records: DataFrame, topics: tuple[str, ...]) -> Column:
    """Window offset of records as a scalar subquery (A2, A3): a pass that parses `original_ts` and validity only."""
    from .status import offset_from_min

    d = decode(records.filter(F.col("topic").isin(*topics)), measures=())
    return d.filter("valid").select(once(event_seconds("ts")).alias("sec")).agg(offset_from_min(F.min("sec"))).scalar()


def full_event_time(time_of_day: Column, received: Column) -> Column:
    """A time of day on 1970-01-01 with the date it was received on.

    A record sent shortly before midnight and received after it (or by a
    clock ahead, the other way round) is moved a day, so that the two
    times are never more than half a day apart.
    """
    day = F.date_trunc("day", received)
    at = F.unix_seconds(day) + F.unix_seconds(time_of_day) - F.unix_seconds(F.date_trunc("day", time_of_day))
    apart = at - F.unix_seconds(received)
    half, whole = F.lit(43_200), F.lit(86_400)
    return F.timestamp_seconds(F.when(apart > half, at - whole).when(apart < -half, at + whole).otherwise(at))


def route(decoded: DataFrame, metric: Metric) -> DataFrame:
    """Landed-table rows of one metric: its topic, valid records only.

    Records on other topics are ignored. The topic equality is a plain
    filter, so on a file or table source it reaches the scan.
    """
    cols = [F.col("ts"), F.col("server_id")]
    for m in metric.measures:
        dtype = metric.dtype if m == metric.measure else "double"
        cols.append(F.col(m).cast(dtype).alias(m))
    return decoded.filter((F.col("topic") == F.lit(metric.topic)) & F.col("valid")).select(*cols)


def route_all(decoded: DataFrame, metrics: tuple[str, ...] = ("cpu", "mem", "net", "disk")) -> DataFrame:
    """Every metric's landed rows in one pass over the decoded records.

    Output: `metric`, `ts`, `server_id`, `measure` (the aggregated
    measure, cast to its metric's type, as double) and `extra`
    (`net_out` for network, else null). Equal to the union of `route`
    per metric, without reading the records once per metric.
    """
    topic = F.col("topic")
    ms = [METRICS[n] for n in metrics]
    name = measure = extra = None
    for m in ms:
        hit = topic == F.lit(m.topic)
        value = F.col(m.measure).cast(m.dtype).cast("double")
        name = F.when(hit, F.lit(m.name)) if name is None else name.when(hit, F.lit(m.name))
        measure = F.when(hit, value) if measure is None else measure.when(hit, value)
        if "net_out" in m.measures:
            extra = F.when(hit, F.col("net_out"))
    return decoded.filter(F.col("valid") & topic.isin(*[m.topic for m in ms])).select(
        name.alias("metric"),
        "ts",
        "server_id",
        measure.alias("measure"),
        (extra if extra is not None else F.lit(None)).cast("double").alias("extra"),
    )


def records_long(decoded: DataFrame, pair: MetricPair, full_time: bool = False, sec: Column | None = None) -> DataFrame:
    """Long form (server_id, sec, l, r) of a pair straight from decoded
    records of both topics: the one-subscription consumer, one scan.

    `full_time=True` takes the date from the records' `timestamp` (D8);
    records without one are dropped, as those without a time of day are.
    `sec` gives the event seconds where they are known already.
    """
    from .windows import tagged_long_form

    topic, valid = F.col("topic"), F.col("valid")
    event_time = full_event_time(parse_time_of_day("ts"), F.col("timestamp")) if full_time else None
    return tagged_long_form(
        decoded, pair, valid & (topic == F.lit(pair.left.topic)), valid & (topic == F.lit(pair.right.topic)), event_time=event_time, sec=sec
    )


def quarantine(decoded: DataFrame) -> DataFrame:
    """Records whose value is not a JSON object (D1): topic, key, raw text."""
    return decoded.filter(~F.col("valid")).select("topic", "key", "text")


def topic_counts(decoded: DataFrame, topics: tuple[str, ...] = K.TOPICS) -> DataFrame:
    """Messages received, records stored and records quarantined per topic.

    `stored` counts valid records on the subscribed `topics`; other
    topics are received and counted but never stored. One aggregate,
    partial on every task.
    """
    subscribed = F.col("topic").isin(*topics)
    return decoded.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(subscribed & F.col("valid")).alias("stored"),
        F.count_if(~F.col("valid")).alias("quarantined"),
    )
