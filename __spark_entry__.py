"""


Every query reads the provided `events` table through the adapter in
`fleetpulse.sources.events` (server = user_id % 5, time of day, event
type -> metric) and runs over all of it. Queries that exercise sinks
write under the session's shared checkpoint folder and read back.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable

# Importable however this file is loaded (by module name or by path).
_ROOT = os.path.dirname(os.path.abspath(__file__))
if _ROOT not in sys.path:
    sys.path.insert(0, _ROOT)

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

try:  # the training-data operators are an optional part, and so are the libraries they need
    import fleetpulse.llm.registry as llm_registry
except ImportError as e:
    if e.name not in ("fleetpulse.llm", "fleetpulse.llm.registry", "corpus_pipeline"):
        warnings.warn(f"queries of the training-data operators are left out: {e}", stacklevel=1)
    llm_registry = None

from fleetpulse.functions import constants as K
from fleetpulse.functions import event_seconds, time_of_day_text
from fleetpulse.operators.combine import combine_windows
from fleetpulse.operators.event_time import with_event_time
from fleetpulse.operators.records import (
    decode,
    fan_out,
    quarantine,
    record_offset,
    records_long,
    replay_order,
    route,
    route_all,
    topic_counts,
)
from fleetpulse.operators.status import input_status, offset_column, offset_from_min, window_offset
from fleetpulse.operators.warmup import rank_windows
from fleetpulse.operators.windows import window_aggregate
from fleetpulse.plans.flows import consume, producer_records, publish_epochs
from fleetpulse.plans.jobs import alerts_from_long, combined_windows, cpu_mem_alerts, full_time_alerts, net_disk_alerts
from fleetpulse.plans.run import run_alert_job
from fleetpulse.schemas import (
    CPU,
    CPU_MEM,
    CPU_MEM_ALERT_SCHEMA,
    DISK,
    MEM,
    METRICS,
    NET,
    NET_DISK,
    NET_DISK_ALERT_SCHEMA,
    with_window_times,
)
from fleetpulse.session import shared_dir
from fleetpulse.sources.csv_tables import read_alerts, read_samples, sort_alerts, write_table
from fleetpulse.sources.events import (
    EVENTS_SCHEMA,
    event_records,
    metric_tables,
    pair_long_table,
    read_events,
    read_events_at,
    server_of,
    wide_samples,
)
from fleetpulse.streaming import published
from fleetpulse.streaming.ingest import compact, land_stream, landing_counts, read_landed, read_quarantine, read_record_files
from fleetpulse.streaming.windows import (
    ClosedStream,
    LateRowsError,
    bootstrap_offset,
    close_stream,
    dropped_rows,
    stream_alert_rows,
    stream_alerts,
    stream_session,
)

SMOKE_DIR = "/root/testdata/sf0.001"
STAMP = "00:00:00"
STREAM_WATERMARK_SECONDS = 60


#: Arrivals that a stream query's input is split into, and files of each at least: one arrival is one micro-batch.
ARRIVALS, FILES = 3, 4

#: Records that a file holds, about, and events that make as many: a larger arrival has more files, so no task's share grows.
FILE_RECORDS = 400_000
FILE_EVENTS = FILE_RECORDS // 4

#: Rows of an arrival for each of its files at least: none is left empty.
LEAST_ROWS = 1000

#: Files that a micro-batch takes at most where it may be any part of the input: bounds what is cached.
BATCH_FILES = 48


def _file_count(largest: int, smallest: int, rows: int) -> int:
    """Files of each arrival, a multiple of FILES, for about `rows` rows each.

    All arrivals have as many, as a micro-batch is one arrival by its
    number of files; so the smallest has rows for all of them.
    """
    return FILES * max(1, min(-(-largest // (rows * FILES)), smallest // (LEAST_ROWS * FILES)))


def _share(files: int, parts: int, least: int = 1) -> int:
    """Files of a micro-batch that takes one of `parts` parts of the files, BATCH_FILES at most."""
    return max(least, min(BATCH_FILES, -(-files // parts)))


def _written_files(spark: SparkSession, path: str) -> int:
    return len(spark.read.parquet(path).inputFiles())


def _write_records(records: DataFrame, path: str) -> None:
    """Files of at most FILE_RECORDS rows, in the order of the rows: a micro-batch has tasks for its rows, however few tasks wrote them."""
    records.write.option("maxRecordsPerFile", FILE_RECORDS).parquet(path)


def _write_drop(events: DataFrame, files: int, path: str) -> None:
    """Records of events in so many files of like size.

    A large drop deals its events, not their records; where there may be
    too few events for all files, as FILES of them allow, the records.
    """
    records = event_records(events, tasks=files) if files > FILES else event_records(events).repartition(files)
    records.write.parquet(path)


def _drops(events: DataFrame, parts: int) -> tuple[list[DataFrame], int]:
    """Events dealt by a hash into so many drops, each with all records of its events, and the files of each drop."""
    drop = F.pmod(F.xxhash64("event_id", "ts", "user_id"), F.lit(parts))
    n = events.count() // parts
    return [events.filter(drop == i) for i in range(parts)], _file_count(n, n, FILE_EVENTS)


def _state_partitions(spark: SparkSession) -> int:
    """State partitions for the stream queries: one per core; their state is
    a few thousand windows (see `stream_alerts`)."""
    return spark.sparkContext.defaultParallelism


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return metric_tables(read_events(spark, sf_dir))


def _labels(df: DataFrame, *measures: str) -> DataFrame:
    return df.select(
        "server_id",
        F.date_format("window.start", K.LABEL_FORMAT).alias("window_start"),
        F.date_format("window.end", K.LABEL_FORMAT).alias("window_end"),
        *measures,
    )


# --- whole jobs ----------------------------------------------------------------


def q_cpu_mem_alerts(spark, sf_dir):
    """Flagship: the CPU/MEM job over one scan of both metrics."""
    return alerts_from_long(pair_long_table(read_events(spark, sf_dir), CPU_MEM), CPU_MEM)


def q_net_disk_alerts(spark, sf_dir):
    return alerts_from_long(pair_long_table(read_events(spark, sf_dir), NET_DISK), NET_DISK)


def q_cpu_mem_alerts_full_time(spark, sf_dir):
    """The CPU/MEM job on full event times (D8): days are not folded together."""
    return full_time_alerts(pair_long_table(read_events(spark, sf_dir), CPU_MEM, full_time=True), CPU_MEM)


def q_cpu_mem_alerts_two_tables(spark, sf_dir):
    """The same job over two landed metric tables, as the reference job reads them."""
    t = _tables(spark, sf_dir)
    return cpu_mem_alerts(t["cpu"], t["mem"])


def q_net_disk_alerts_two_tables(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return net_disk_alerts(t["net"], t["disk"])


def q_records_cpu_mem_alerts(spark, sf_dir):
    """Alerts straight from a batch of records of both topics (one full decode; the offset parses times only)."""
    return _record_alerts(event_records(read_events(spark, sf_dir)), CPU_MEM)


def q_records_net_disk_alerts(spark, sf_dir):
    return _record_alerts(event_records(read_events(spark, sf_dir)), NET_DISK)


def _record_alerts(records: DataFrame, pair) -> DataFrame:
    topics = (pair.left.topic, pair.right.topic)
    d = decode(records.filter(F.col("topic").isin(*topics)), measures=(pair.left.measure, pair.right.measure))
    return alerts_from_long(records_long(d, pair), pair, offset=record_offset(records, topics))


def q_cpu_mem_alerts_join_form(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return cpu_mem_alerts(t["cpu"], t["mem"], form="join")


def q_net_disk_alerts_join_form(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return net_disk_alerts(t["net"], t["disk"], form="join")


def q_custom_thresholds(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return cpu_mem_alerts(t["cpu"], t["mem"], K.README_CPU_THRESHOLD, K.README_MEM_THRESHOLD)


def q_custom_thresholds_net_disk(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return net_disk_alerts(t["net"], t["disk"], K.README_NET_THRESHOLD, K.README_DISK_THRESHOLD)


# --- window pieces ----------------------------------------------------------------


def _window_metric(spark, sf_dir, metric, partner):
    t = _tables(spark, sf_dir)
    off = offset_column(t[metric.name], t[partner.name])
    agg = window_aggregate(with_event_time(t[metric.name], metric), metric, off)
    return _labels(agg, metric.output)


def q_cpu_window_avg(spark, sf_dir):
    return _window_metric(spark, sf_dir, CPU, MEM)


def q_mem_window_avg(spark, sf_dir):
    return _window_metric(spark, sf_dir, MEM, CPU)


def q_net_window_max(spark, sf_dir):
    return _window_metric(spark, sf_dir, NET, DISK)


def q_disk_window_max(spark, sf_dir):
    return _window_metric(spark, sf_dir, DISK, NET)


def q_window_offset(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return window_offset(t["cpu"], t["mem"])


def q_combined_windows(spark, sf_dir):
    t = _tables(spark, sf_dir)
    off = offset_column(t["cpu"], t["mem"])
    a = window_aggregate(with_event_time(t["cpu"], CPU), CPU, off, keyed=True)
    b = window_aggregate(with_event_time(t["mem"], MEM), MEM, off, keyed=True)
    return _labels(combine_windows(a, b), "avg_cpu", "avg_mem")


def q_warmup_dropped(spark, sf_dir):
    """The warm-up windows W1/W2 remove: rank 1 and 2 of every server."""
    t = _tables(spark, sf_dir)
    ranked = rank_windows(combined_windows(t["net"], t["disk"], NET_DISK))
    return _labels(ranked.filter(F.col("rn") <= K.WARMUP_WINDOWS), "rn", "max_net_in", "max_disk_io")


def q_input_status(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return input_status(t["cpu"], t["mem"])


def q_event_time_parsed(spark, sf_dir):
    """P9/P10 over every event, its time written in a form chosen by event type."""
    ev = read_events(spark, sf_dir)
    hms = time_of_day_text("ts")
    et = F.col("event_type")
    text = (
        F.when(et == "click", hms)
        .when(et == "view", F.regexp_replace(hms, "^0", ""))
        .when(et == "purchase", F.concat(hms, F.lit(".5")))
        .when(et == "error", F.concat(F.lit(" "), hms))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    landed = ev.select(text.alias("ts"), server_of(F.col("user_id")).alias("server_id"), F.col("value").alias("cpu_pct"))
    typed = with_event_time(landed, CPU, keep=("ts",))
    return typed.select("ts", "server_id", F.date_format("ts_dt", "yyyy-MM-dd HH:mm:ss").alias("event_time"), "cpu_val")


# --- records --------------------------------------------------------------------


def q_replay_order(spark, sf_dir):
    return replay_order(wide_samples(read_events(spark, sf_dir)))


def _fields_schema():
    return "timestamp string, original_ts string, server_id string, " + ", ".join(
        f"{m} double" for m in ("cpu_pct", "mem_pct", "net_in", "net_out", "disk_io")
    )


def q_fan_out(spark, sf_dir):
    recs = fan_out(wide_samples(read_events(spark, sf_dir)), STAMP)
    j = F.from_json(F.col("value").cast("string"), _fields_schema())
    return recs.select("topic", F.col("key").cast("string").alias("key"), j.alias("j")).select(
        "topic", "key", F.col("j.timestamp").alias("stamp"), "j.original_ts", "j.server_id",
        "j.cpu_pct", "j.mem_pct", "j.net_in", "j.net_out", "j.disk_io",
    )


def _routed_union(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        m = METRICS[name]
        extra = F.col("net_out") if "net_out" in m.measures else F.lit(None).cast("double")
        part = df.select(
            F.lit(name).alias("metric"), "ts", "server_id",
            F.col(m.measure).cast("double").alias("measure"), extra.cast("double").alias("extra"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def q_encode_decode_route(spark, sf_dir):
    """Encode every event's records, decode once, route all four topics."""
    return route_all(decode(event_records(read_events(spark, sf_dir))))


def q_topic_counts(spark, sf_dir):
    return topic_counts(decode(event_records(read_events(spark, sf_dir)), measures=()))


def q_quarantined_records(spark, sf_dir):
    q = quarantine(decode(event_records(read_events(spark, sf_dir))))
    return q.select("topic", F.col("key").cast("string").alias("key"), "text")


# --- tables in and out ------------------------------------------------------------


def q_csv_round_trip(spark, sf_dir):
    """Landed CSV tables -> guarded NET/DISK job -> sorted alerts CSV -> read back."""
    t = _tables(spark, sf_dir)
    base = shared_dir(spark, "csv_round_trip")
    write_table(t["net"], f"{base}/net")
    write_table(t["disk"], f"{base}/disk")
    run_alert_job(spark, NET_DISK, f"{base}/net", f"{base}/disk", f"{base}/out")
    return read_alerts(spark, NET_DISK_ALERT_SCHEMA, f"{base}/out")


def q_csv_round_trip_cpu_mem(spark, sf_dir):
    """The same for CPU/MEM, with the job's counts (A1) as columns."""
    t = _tables(spark, sf_dir)
    base = shared_dir(spark, "csv_round_trip_cpu_mem")
    write_table(t["cpu"], f"{base}/cpu")
    write_table(t["mem"], f"{base}/mem")
    done = run_alert_job(spark, CPU_MEM, f"{base}/cpu", f"{base}/mem", f"{base}/out")
    counts = {"left_rows": done.left_rows, "right_rows": done.right_rows, "result_rows": done.rows}
    return read_alerts(spark, CPU_MEM_ALERT_SCHEMA, f"{base}/out").withColumns({k: F.lit(v).cast("long") for k, v in counts.items()})


def q_produced_landed_alerts(spark, sf_dir):
    """All three roles: samples -> records in replay order -> landed stream -> job on the landed tables."""
    base = shared_dir(spark, "roles")
    write_table(wide_samples(read_events(spark, sf_dir)), f"{base}/dataset")
    _write_records(producer_records(read_samples(spark, f"{base}/dataset"), STAMP), f"{base}/records")
    most = _share(_written_files(spark, f"{base}/records"), ARRIVALS, 2)
    consume(spark, "cpu_mem", f"{base}/landed", f"{base}/ck", record_files=f"{base}/records", max_files=most).awaitTermination()
    landed = f"{base}/landed"
    run_alert_job(spark, CPU_MEM, f"{landed}/cpu", f"{landed}/mem", f"{base}/out", landed_base=landed)
    return read_alerts(spark, CPU_MEM_ALERT_SCHEMA, f"{base}/out")


def q_job_guards(spark, sf_dir):
    """The status of a job without rows, without any readable time, and with both."""
    t = _tables(spark, sf_dir)
    cases = {
        "all": (t["cpu"], t["mem"]),
        "none": (t["cpu"].filter("server_id IS NULL"), t["mem"].filter("server_id IS NULL")),
        "no time": tuple(t[n].withColumn("ts", F.concat("ts", F.lit("x"))) for n in ("cpu", "mem")),
        "one side": (t["cpu"].withColumn("ts", F.lit(None).cast("string")), t["mem"]),
    }
    out = None
    for name, (left, right) in cases.items():
        row = input_status(left, right).select(F.lit(name).alias("inputs"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def _positions(spark, ordered: DataFrame, name: str) -> DataFrame:
    """Rows with their place in the order of `ordered`'s partitions, counted from 0."""
    path = f"{shared_dir(spark, name)}/rows"
    ordered.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_id", 33))
    sizes = {r["_part"]: r["n"] for r in rows.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # one row per task
    starts, at = [], 0
    for part in sorted(sizes):
        starts.append((part, at))
        at += sizes[part]
    first = spark.createDataFrame(starts, "_part long, _first long")
    place = F.col("_first") + F.col("_id") - F.shiftleft(F.col("_part"), 33)
    return rows.join(first, "_part").withColumn("position", place).drop("_id", "_part", "_first")


def q_replay_positions(spark, sf_dir):
    """P5 with its order: where each (ts, server) group of samples lies in the replay."""
    rows = _positions(spark, replay_order(wide_samples(read_events(spark, sf_dir))), "replay")
    return rows.groupBy("ts", "server_id").agg(
        F.min("position").alias("first_position"), F.max("position").alias("last_position"), F.count("*").alias("samples")
    )


#: Rows of a server that an epoch of the replay holds, before its last second.
EPOCH_ROWS = 2000


def q_replay_epochs(spark, sf_dir):
    """P5 and S8 in epochs: what each epoch sent, the most of one server in it, and whether every server's records are one task's, in order."""
    base = shared_dir(spark, "replay_epochs")
    on_cpu = F.col("topic") == CPU.topic
    place = F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id")

    def send(records: DataFrame, epoch: int) -> None:
        records.filter(on_cpu).select("*", *place).write.parquet(f"{base}/sent/epoch={epoch}")

    publish_epochs(wide_samples(read_events(spark, sf_dir)), send, EPOCH_ROWS, FILES, STAMP)
    ts = F.get_json_object(F.col("value").cast("string"), "$.original_ts")
    rows = spark.read.parquet(f"{base}/sent").select("epoch", "_part", "_id", F.col("key").cast("string").alias("server_id"), ts.alias("ts"))
    server = rows.withColumn("_before", F.lag("ts").over(Window.partitionBy("epoch", "server_id").orderBy("_id"))).groupBy("epoch", "server_id").agg(
        F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"),
        (F.countDistinct("_part") == 1).alias("_one_task"), F.coalesce(F.bool_and(F.col("ts") >= F.col("_before")), F.lit(True)).alias("_sorted"),
    )
    return server.groupBy(F.col("epoch").cast("long").alias("epoch")).agg(
        F.min("first").alias("first_ts"), F.max("last").alias("last_ts"), F.sum("n").alias("samples"), F.max("n").alias("most_of_a_server"),
        F.bool_and(F.col("_one_task") & F.col("_sorted")).alias("in_order"),
    )


def q_sorted_alerts(spark, sf_dir):
    """O1 with its order: the place of every alert row in the sorted output."""
    return _positions(spark, sort_alerts(q_cpu_mem_alerts(spark, sf_dir)), "sorted")


def q_wide_csv_round_trip(spark, sf_dir):
    base = shared_dir(spark, "wide_csv")
    write_table(wide_samples(read_events(spark, sf_dir)), f"{base}/dataset")
    return read_samples(spark, f"{base}/dataset")


# --- streams -------------------------------------------------------------------------


def _record_files(spark, sf_dir, name, records=None):
    base = shared_dir(spark, name)
    _write_records(records if records is not None else event_records(read_events(spark, sf_dir)), f"{base}/records")
    return base


def q_landed_metrics(spark, sf_dir):
    base = _record_files(spark, sf_dir, "landed")
    names = ("cpu", "mem", "net", "disk")
    land_stream(read_record_files(spark, f"{base}/records"), f"{base}/landed", names, f"{base}/ck").awaitTermination()
    return _routed_union({n: read_landed(spark, n, f"{base}/landed/{n}") for n in names})


def q_landed_topic_counts(spark, sf_dir):
    """A9 on a stream: per-topic counts of a landing run, several micro-batches."""
    base = _record_files(spark, sf_dir, "landed_counts")
    src = read_record_files(spark, f"{base}/records", max_files=_share(_written_files(spark, f"{base}/records"), ARRIVALS, 2))
    land_stream(src, f"{base}/landed", ("cpu", "mem", "net", "disk"), f"{base}/ck", fmt="parquet").awaitTermination()
    return landing_counts(spark, f"{base}/landed")


def q_landed_quarantine(spark, sf_dir):
    """D1 on a stream: payloads that do not decode are kept, over several micro-batches and two checkpoints on one base."""
    base = shared_dir(spark, "landed_quarantine")
    drops, files = _drops(read_events(spark, sf_dir), 2)
    for i, ev in enumerate(drops):
        _write_drop(ev, files, f"{base}/records{i}")
        src = read_record_files(spark, f"{base}/records{i}", max_files=_share(files, 2))
        land_stream(src, f"{base}/landed", ("net", "disk"), f"{base}/ck{i}", fmt="parquet").awaitTermination()
    return read_quarantine(spark, f"{base}/landed").select("topic", F.col("key").cast("string").alias("key"), "text")


def q_empty_metric_landed(spark, sf_dir):
    """A producer that sends only CPU: the memory table lands empty but typed."""
    recs = event_records(read_events(spark, sf_dir)).filter(F.col("topic") == CPU.topic)
    base = _record_files(spark, sf_dir, "empty_landed", recs)
    land_stream(read_record_files(spark, f"{base}/records"), f"{base}/landed", ("cpu", "mem"), f"{base}/ck").awaitTermination()
    out = None
    for n in ("cpu", "mem"):
        df = read_landed(spark, n, f"{base}/landed/{n}")
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("metric"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        out = row if out is None else out.unionByName(row)
    return out


def _arrivals(rows: DataFrame, at, path: str) -> int:
    """Write rows as ARRIVALS drops, split where `at` is a third and two thirds of its range; returns the number of files of each.

    The drops are written one after another, so a stream that takes so
    many files per micro-batch reads them in that order, one a time.
    """
    rows.withColumn("_at", at).write.parquet(f"{path}-all")
    rows, at = rows.sparkSession.read.parquet(f"{path}-all"), F.col("_at")
    lo, hi = rows.agg(F.min(at), F.max(at)).first()
    step = ((hi or 0) - (lo or 0)) / ARRIVALS
    n = F.coalesce(F.least(F.floor((at - F.lit(lo)) / F.lit(step or 1)), F.lit(ARRIVALS - 1)), F.lit(0))
    sizes = rows.agg(*[F.count_if(n == i) for i in range(ARRIVALS)]).first()
    files = _file_count(max(sizes), min(sizes), FILE_RECORDS)
    for i in range(ARRIVALS):
        rows.filter(n == i).drop("_at").repartition(files).write.parquet(f"{path}/{i}")
    return files


def _event_seconds_of(records: DataFrame):
    """Time of day of records, from their text (only to split them into arrivals)."""
    return event_seconds(F.get_json_object(F.col("value").cast("string"), "$.original_ts"))


def _days(spark, sf_dir, name) -> tuple[str, int]:
    """A folder with a month's records that carry the time of day only, as ARRIVALS drops in the order of their days, and the files of each."""
    base = shared_dir(spark, name)
    ev = read_events(spark, sf_dir)
    day = F.unix_seconds(F.date_trunc("second", F.col("ts").cast("timestamp")))
    lo, hi = ev.agg(F.min(day), F.max(day)).first()
    step = ((hi or 0) - (lo or 0)) // ARRIVALS + 1
    drop = F.floor((day - F.lit(lo or 0)) / F.lit(step))
    sizes = ev.agg(*[F.count_if(drop == i) for i in range(ARRIVALS)]).first()
    files = _file_count(max(sizes), min(sizes), FILE_EVENTS)
    for i in range(ARRIVALS):
        _write_drop(ev.filter(drop == i), files, f"{base}/records/{i}")
    return base, files


def _published(spark, sf_dir, pair, name) -> str:
    """Folder of alerts published after each of ARRIVALS micro-batches, each of which repairs what the ones before published."""
    base, files = _days(spark, sf_dir, name)
    src = read_record_files(spark, f"{base}/records/*", max_files=files)
    out = f"{base}/alerts"
    metrics = (pair.left.name, pair.right.name)
    land_stream(src, f"{base}/landed", metrics, f"{base}/ck", fmt="parquet", publish={pair.name: out}).awaitTermination()
    return out


def _closed_record_stream(spark, sf_dir, pair, schema, name) -> ClosedStream:
    """A stream of a month's records that carry the time of day only, in the order of their days, run to the end and completed.

    On the second and third arrival the time of day lies behind the
    watermark, so rows come too late and `close_stream` replaces what was
    written.
    """
    base, files = _days(spark, sf_dir, name)
    own = stream_session(spark, _state_partitions(spark))
    batch = spark.read.parquet(f"{base}/records/*")
    long_batch = _written_long(records_long(decode(batch), pair), f"{base}/long")
    offset = int(long_batch.agg(offset_from_min(F.min("sec")).alias("o")).first().o)
    src = read_record_files(own, f"{base}/records/*", max_files=files)
    q = stream_alerts(
        stream_alert_rows(long=records_long(decode(src), pair), pair=pair, offset=offset, watermark=f"{STREAM_WATERMARK_SECONDS} seconds"),
        f"{base}/alerts", f"{base}/ck",
    )
    q.awaitTermination()
    return close_stream(q, read_alerts(spark, schema, f"{base}/alerts"), long_batch, pair, offset)


def q_published_cpu_mem_alerts(spark, sf_dir):
    """A stream that starts without an offset; late rows repair the windows they touch; the newest version is read."""
    return published.read_published(spark, _published(spark, sf_dir, CPU_MEM, "published_cm"), CPU_MEM)


def q_published_net_disk_alerts(spark, sf_dir):
    return published.read_published(spark, _published(spark, sf_dir, NET_DISK, "published_nd"), NET_DISK)


def q_published_ledger(spark, sf_dir):
    """How many windows each version computed, and how many of them late rows made it compute again."""
    out = _published(spark, sf_dir, CPU_MEM, "published_ledger")
    rows = None
    for v in range(1, published.current(spark, out).number + 1):
        row = published.read_ledger(spark, out, v).agg(F.count(F.lit(1)).alias("touched"), F.count_if("late").alias("late"))
        row = row.select(F.lit(v).cast("long").alias("version"), "*")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def q_landed_states_alerts(spark, sf_dir):
    """A4-A7 from landed states: the job of `produced_landed_alerts` that reads no landed table."""
    base = shared_dir(spark, "states")
    _write_records(producer_records(wide_samples(read_events(spark, sf_dir)), STAMP), f"{base}/records")
    landed = f"{base}/landed"
    most = _share(_written_files(spark, f"{base}/records"), ARRIVALS, 2)
    consume(spark, "cpu_mem", landed, f"{base}/ck", record_files=f"{base}/records", max_files=most, fmt="parquet").awaitTermination()
    run_alert_job(spark, CPU_MEM, f"{landed}/cpu", f"{landed}/mem", f"{base}/out", fmt="parquet", landed_base=landed, from_states=True)
    return read_alerts(spark, CPU_MEM_ALERT_SCHEMA, f"{base}/out")


def q_restarted_topic_counts(spark, sf_dir):
    """A9 over restarts: a landing stopped and started again twice, counts from its commit records."""
    base = shared_dir(spark, "restarts")
    drops, files = _drops(read_events(spark, sf_dir), ARRIVALS)
    for i, ev in enumerate(drops):
        _write_drop(ev, files, f"{base}/records/{i}")
        src = read_record_files(spark, f"{base}/records/*", max_files=_share(files, 2))
        land_stream(src, f"{base}/landed", ("cpu", "mem"), f"{base}/ck", fmt="parquet").awaitTermination()
    return landing_counts(spark, f"{base}/landed")


def q_compacted_landing(spark, sf_dir):
    """Micro-batches landed and compacted into one commit, then more, compacted again; every row stays."""
    base = shared_dir(spark, "compacted")
    names = ("cpu", "mem", "net", "disk")
    drops, files = _drops(read_events(spark, sf_dir), 2)
    for i, ev in enumerate(drops):
        _write_drop(ev, files, f"{base}/records/{i}")
        src = read_record_files(spark, f"{base}/records/*", max_files=_share(files, FILES))
        land_stream(src, f"{base}/landed", names, f"{base}/ck").awaitTermination()
        compact(spark, f"{base}/landed")
    return _routed_union({n: read_landed(spark, n, f"{base}/landed/{n}") for n in names})


def _ordered_stream(spark, sf_dir, pair, name) -> DataFrame:
    """Alert rows of records in replay order, streamed as ARRIVALS micro-batches; nothing is late."""
    base = shared_dir(spark, name)
    recs = event_records(read_events(spark, sf_dir))
    files = _arrivals(recs, _event_seconds_of(recs), f"{base}/records")
    batch = spark.read.parquet(f"{base}/records/*")
    offset = bootstrap_offset(*[route(decode(batch), m) for m in (pair.left, pair.right)])
    s = read_record_files(stream_session(spark, _state_partitions(spark)), f"{base}/records/*", max_files=files)
    rows = stream_alert_rows(
        long=records_long(decode(s), pair), pair=pair, offset=offset,
        watermark=f"{STREAM_WATERMARK_SECONDS} seconds",
    )
    q = stream_alerts(rows, f"{base}/alerts", f"{base}/ck")
    q.awaitTermination()
    if dropped_rows(q):
        raise LateRowsError("records in replay order are never late")
    return read_alerts(spark, pair.output_schema, f"{base}/alerts")


def q_stream_cpu_mem_alerts(spark, sf_dir):
    """Record files in replay order -> stream of three micro-batches -> windows -> warm-up state -> CSV sink."""
    return _ordered_stream(spark, sf_dir, CPU_MEM, "stream_alerts")


def q_stream_net_disk_alerts(spark, sf_dir):
    """The same for NET/DISK: its rows come from the stream."""
    return _ordered_stream(spark, sf_dir, NET_DISK, "stream_alerts_nd")


def q_stream_cpu_mem_alerts_closed(spark, sf_dir):
    """A bounded stream run to the end and completed: every alert row, though rows came too late on the way."""
    return _closed_record_stream(spark, sf_dir, CPU_MEM, CPU_MEM_ALERT_SCHEMA, "stream_closed").rows


def q_stream_net_disk_alerts_closed(spark, sf_dir):
    return _closed_record_stream(spark, sf_dir, NET_DISK, NET_DISK_ALERT_SCHEMA, "stream_closed_nd").rows


def _written_long(long: DataFrame, path: str) -> DataFrame:
    """Long-form rows of records, written: the offset and the end of a stream read them, and no record is decoded again."""
    long.write.parquet(path)
    return long.sparkSession.read.schema(long.schema).parquet(path)


def _full_time_stream(spark, src: DataFrame, long_of, long_batch: DataFrame, base: str) -> ClosedStream:
    """CPU/MEM alerts of a stream on full event times, completed from the same rows as a batch."""
    offset = int(long_batch.agg(F.coalesce(F.pmod(F.min("sec"), F.lit(10)), F.lit(0)).alias("o")).first().o)
    q = stream_alerts(
        stream_alert_rows(long=long_of(src), offset=offset, watermark=f"{STREAM_WATERMARK_SECONDS} seconds", full_time=True),
        f"{base}/alerts", f"{base}/ck",
    )
    q.awaitTermination()
    streamed = read_alerts(spark, with_window_times(CPU_MEM_ALERT_SCHEMA), f"{base}/alerts")
    return close_stream(q, streamed, long_batch, CPU_MEM, offset, full_time=True)


def q_stream_cpu_mem_alerts_full_time(spark, sf_dir):
    """A stream of the events themselves, windowed on their full timestamps (D8),
    in event order, run to the end and closed: a month of data, no midnight wrap."""
    base = shared_dir(spark, "stream_full")
    ev = read_events(spark, sf_dir)
    files = _arrivals(ev, F.unix_seconds(F.col("ts").cast("timestamp")), f"{base}/events")
    own = stream_session(spark, _state_partitions(spark))
    src = own.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", files).parquet(f"{base}/events/*")
    long_of = lambda df: pair_long_table(df, CPU_MEM, full_time=True)
    return _full_time_stream(spark, src, long_of, long_of(read_events_at(spark, f"{base}/events/*")), base).rows


def q_stream_records_full_time(spark, sf_dir):
    """A stream of a month's records, whose date comes from the broker's time of receipt."""
    base = shared_dir(spark, "stream_records_full")
    recs = event_records(read_events(spark, sf_dir), timed=True)
    files = _arrivals(recs, F.unix_seconds("timestamp"), f"{base}/records")
    src = read_record_files(stream_session(spark, _state_partitions(spark)), f"{base}/records/*", max_files=files, timed=True)
    long_of = lambda df: records_long(decode(df), CPU_MEM, full_time=True)
    long_batch = _written_long(long_of(spark.read.parquet(f"{base}/records/*")), f"{base}/long")
    return _full_time_stream(spark, src, long_of, long_batch, base).rows


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query (CPU/MEM alerts) on /root/testdata/sf0.001."""
    return q_cpu_mem_alerts(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "cpu_mem_alerts": q_cpu_mem_alerts,
        "net_disk_alerts": q_net_disk_alerts,
        "cpu_mem_alerts_full_time": q_cpu_mem_alerts_full_time,
        "cpu_mem_alerts_two_tables": q_cpu_mem_alerts_two_tables,
        "net_disk_alerts_two_tables": q_net_disk_alerts_two_tables,
        "cpu_mem_alerts_join_form": q_cpu_mem_alerts_join_form,
        "net_disk_alerts_join_form": q_net_disk_alerts_join_form,
        "records_cpu_mem_alerts": q_records_cpu_mem_alerts,
        "records_net_disk_alerts": q_records_net_disk_alerts,
        "custom_thresholds": q_custom_thresholds,
        "custom_thresholds_net_disk": q_custom_thresholds_net_disk,
        "cpu_window_avg": q_cpu_window_avg,
        "mem_window_avg": q_mem_window_avg,
        "net_window_max": q_net_window_max,
        "disk_window_max": q_disk_window_max,
        "window_offset": q_window_offset,
        "combined_windows": q_combined_windows,
        "warmup_dropped": q_warmup_dropped,
        "input_status": q_input_status,
        "event_time_parsed": q_event_time_parsed,
        "replay_order": q_replay_order,
        "fan_out": q_fan_out,
        "encode_decode_route": q_encode_decode_route,
        "topic_counts": q_topic_counts,
        "quarantined_records": q_quarantined_records,
        "csv_round_trip": q_csv_round_trip,
        "wide_csv_round_trip": q_wide_csv_round_trip,
        "landed_metrics": q_landed_metrics,
        "landed_topic_counts": q_landed_topic_counts,
        "empty_metric_landed": q_empty_metric_landed,
        "csv_round_trip_cpu_mem": q_csv_round_trip_cpu_mem,
        "produced_landed_alerts": q_produced_landed_alerts,
        "job_guards": q_job_guards,
        "replay_positions": q_replay_positions,
        "replay_epochs": q_replay_epochs,
        "sorted_alerts": q_sorted_alerts,
        "landed_quarantine": q_landed_quarantine,
        "stream_cpu_mem_alerts": q_stream_cpu_mem_alerts,
        "stream_cpu_mem_alerts_closed": q_stream_cpu_mem_alerts_closed,
        "stream_cpu_mem_alerts_full_time": q_stream_cpu_mem_alerts_full_time,
        "stream_net_disk_alerts_closed": q_stream_net_disk_alerts_closed,
        "stream_records_full_time": q_stream_records_full_time,
        "stream_net_disk_alerts": q_stream_net_disk_alerts,
        "published_cpu_mem_alerts": q_published_cpu_mem_alerts,
        "published_net_disk_alerts": q_published_net_disk_alerts,
        "published_ledger": q_published_ledger,
        "landed_states_alerts": q_landed_states_alerts,
        "restarted_topic_counts": q_restarted_topic_counts,
        "compacted_landing": q_compacted_landing,
        **(llm_registry.queries() if llm_registry else {}),
    }


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------

# The adapter of fleetpulse.sources.events, in SQL.
_SERVER = "'server_' || CAST(user_id % 5 AS VARCHAR)"
_TOD = "strftime(ts, '%H:%M:%S')"
_METRIC_EVENTS = "event_type IN ('click', 'view', 'purchase', 'error')"
_ADAPTER = f"""
cpu AS (SELECT {_TOD} AS ts, {_SERVER} AS server_id, CAST(value AS FLOAT) AS cpu_pct
        FROM events WHERE event_type = 'click'),
mem AS (SELECT {_TOD} AS ts, {_SERVER} AS server_id, CAST(value AS FLOAT) AS mem_pct
        FROM events WHERE event_type = 'view'),
net AS (SELECT {_TOD} AS ts, {_SERVER} AS server_id, value * 50.0 AS net_in, value * 10.0 AS net_out
        FROM events WHERE event_type = 'purchase'),
disk AS (SELECT {_TOD} AS ts, {_SERVER} AS server_id, value * 15.0 AS disk_io
         FROM events WHERE event_type = 'error')"""

# Wide samples: one per event, only its own metric filled.
_WIDE = f"""
wide AS (SELECT {_TOD} AS ts, {_SERVER} AS server_id,
                CASE WHEN event_type = 'click' THEN value END AS cpu_pct,
                CASE WHEN event_type = 'view' THEN value END AS mem_pct,
                CASE WHEN event_type = 'purchase' THEN value * 50.0 END AS net_in,
                CASE WHEN event_type = 'purchase' THEN value * 10.0 END AS net_out,
                CASE WHEN event_type = 'error' THEN value * 15.0 END AS disk_io,
                event_type, event_id
         FROM events)"""

# Metric tables as landed from the records of every metric event.
_ROUTED = f"""{_WIDE},
rcpu AS (SELECT ts, server_id, CAST(cpu_pct AS FLOAT) AS cpu_pct FROM wide WHERE {_METRIC_EVENTS}),
rmem AS (SELECT ts, server_id, CAST(mem_pct AS FLOAT) AS mem_pct FROM wide WHERE {_METRIC_EVENTS}),
rnet AS (SELECT ts, server_id, net_in, net_out FROM wide WHERE {_METRIC_EVENTS}),
rdisk AS (SELECT ts, server_id, disk_io FROM wide WHERE {_METRIC_EVENTS})"""


def _sec(col: str = "ts") -> str:
    """Strict HH:mm:ss text -> seconds of day, else NULL (Spark's try_to_timestamp)."""
    return (
        f"CASE WHEN regexp_full_match({col}, '([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') "
        f"THEN CAST(substr({col},1,2) AS BIGINT)*3600 + CAST(substr({col},4,2) AS BIGINT)*60 "
        f"+ CAST(substr({col},7,2) AS BIGINT) END"
    )


def _round2(x: str) -> str:
    """Spark's round(double, 2): HALF_UP on the shortest decimal text of the double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def _hms(sec: str) -> str:
    return f"strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST({sec} AS BIGINT)), '%H:%M:%S')"


def _pmod(a: str, n: int) -> str:
    return f"((({a}) % {n} + {n}) % {n})"


def _windows_sql(left: str, lcol: str, right: str, rcol: str, agg: str, sec: str | None = None) -> str:
    """CTEs u (long form), o (offset), s (slots), w (rows per window), g (aggregates), k (ranked).

    `sec` overrides the event-seconds expression (default: time of day of `ts`)."""
    sec = sec or _sec()
    return f"""
u AS (SELECT server_id, {sec} AS sec, CAST({lcol} AS DOUBLE) AS l, CAST(NULL AS DOUBLE) AS r FROM {left}
      UNION ALL
      SELECT server_id, {sec} AS sec, CAST(NULL AS DOUBLE) AS l, CAST({rcol} AS DOUBLE) AS r FROM {right}),
o AS (SELECT coalesce({_pmod('min(sec)', 10)}, 0) AS off, max(sec) AS max_sec FROM u),
s AS (SELECT server_id, sec - {_pmod('sec - (SELECT off FROM o)', 10)} AS slot, l, r
      FROM u WHERE sec IS NOT NULL),
w AS (SELECT server_id, unnest([slot - 20, slot - 10, slot]) AS ws, l, r FROM s),
g AS (SELECT server_id, ws, {_round2(f'{agg}(l)')} AS a, {_round2(f'{agg}(r)')} AS b,
             count(l) AS nl, count(r) AS nr, count(*) AS n
      FROM w GROUP BY server_id, ws),
k AS (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY ws) AS rn FROM g)"""


def _at(sec: str) -> str:
    return f"TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST({sec} AS BIGINT))"


def _cpu_mem_select(cpu_t: float, mem_t: float, full_time: bool = False) -> str:
    c, m = f"{cpu_t!r}::DOUBLE", f"{mem_t!r}::DOUBLE"
    times = f"{_at('ws')} AS window_start_time, {_at('ws + 30')} AS window_end_time," if full_time else ""
    return f"""SELECT server_id, {_hms('ws')} AS window_start, {_hms('ws + 30')} AS window_end, {times}
       CAST(a AS FLOAT) AS avg_cpu, CAST(b AS FLOAT) AS avg_mem,
       CASE WHEN a >= {c} AND b >= {m} THEN '{K.ALERT_CPU_AND_MEM}'
            WHEN b >= {m} THEN '{K.ALERT_MEM}'
            WHEN a >= {c} THEN '{K.ALERT_CPU}' END AS alert
FROM k WHERE rn > 2"""


def _cpu_mem_sql(cpu_t: float = K.CPU_THRESHOLD, mem_t: float = K.MEM_THRESHOLD) -> str:
    return f"WITH {_ADAPTER},{_windows_sql('cpu', 'cpu_pct', 'mem', 'mem_pct', 'avg')}\n{_cpu_mem_select(cpu_t, mem_t)}"


def _cpu_mem_full_time_sql() -> str:
    full = f"""
fcpu AS (SELECT CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS fsec, {_SERVER} AS server_id,
                CAST(value AS FLOAT) AS cpu_pct FROM events WHERE event_type = 'click'),
fmem AS (SELECT CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS fsec, {_SERVER} AS server_id,
                CAST(value AS FLOAT) AS mem_pct FROM events WHERE event_type = 'view')"""
    return (f"WITH {full},{_windows_sql('fcpu', 'cpu_pct', 'fmem', 'mem_pct', 'avg', sec='fsec')}\n"
            f"{_cpu_mem_select(K.CPU_THRESHOLD, K.MEM_THRESHOLD, full_time=True)}")


def _records_full_time_sql() -> str:
    """Every metric event is a sample of both metrics, with its full time."""
    fsec = "CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS fsec"
    both = f"""
fcpu AS (SELECT {fsec}, {_SERVER} AS server_id, CASE WHEN event_type = 'click' THEN CAST(value AS FLOAT) END AS cpu_pct
         FROM events WHERE {_METRIC_EVENTS}),
fmem AS (SELECT {fsec}, {_SERVER} AS server_id, CASE WHEN event_type = 'view' THEN CAST(value AS FLOAT) END AS mem_pct
         FROM events WHERE {_METRIC_EVENTS})"""
    return (f"WITH {both},{_windows_sql('fcpu', 'cpu_pct', 'fmem', 'mem_pct', 'avg', sec='fsec')}\n"
            f"{_cpu_mem_select(K.CPU_THRESHOLD, K.MEM_THRESHOLD, full_time=True)}")


def _produced_sql() -> str:
    """Every event is a sample of both metrics."""
    return f"""WITH {_WIDE},
pcpu AS (SELECT ts, server_id, CAST(cpu_pct AS FLOAT) AS cpu_pct FROM wide),
pmem AS (SELECT ts, server_id, CAST(mem_pct AS FLOAT) AS mem_pct FROM wide),{_windows_sql('pcpu', 'cpu_pct', 'pmem', 'mem_pct', 'avg')}
{_cpu_mem_select(K.CPU_THRESHOLD, K.MEM_THRESHOLD)}"""


def _counted_cpu_mem_sql() -> str:
    n = "(SELECT count(*) FROM events WHERE event_type = '{}')"
    return f"""WITH alerts AS ({_cpu_mem_sql()})
SELECT *, {n.format('click')} AS left_rows, {n.format('view')} AS right_rows, (SELECT count(*) FROM alerts) AS result_rows FROM alerts"""


def _job_guards_sql() -> str:
    def case(name, cpu, mem, cpu_ts="ts", mem_ts="ts"):
        return f"""SELECT '{name}' AS inputs, left_rows, right_rows, left_timed, right_timed,
       CASE WHEN min_sec IS NOT NULL THEN {_hms('min_sec')} END AS earliest,
       CAST(coalesce({_pmod('min_sec', 10)}, 0) AS INTEGER) AS window_offset,
       CASE WHEN left_rows + right_rows = 0 THEN 'no data' WHEN left_timed + right_timed = 0 THEN 'no event time' ELSE 'ok' END AS status
FROM (SELECT count(*) FILTER (WHERE l) AS left_rows, count(*) FILTER (WHERE NOT l) AS right_rows,
             count(sec) FILTER (WHERE l) AS left_timed, count(sec) FILTER (WHERE NOT l) AS right_timed, min(sec) AS min_sec
      FROM (SELECT TRUE AS l, {_sec()} AS sec FROM (SELECT {cpu_ts} AS ts FROM cpu WHERE {cpu})
            UNION ALL SELECT FALSE, {_sec()} FROM (SELECT {mem_ts} AS ts FROM mem WHERE {mem})))"""

    parts = [
        case("all", "TRUE", "TRUE"),
        case("none", "server_id IS NULL", "server_id IS NULL"),
        case("no time", "TRUE", "TRUE", "ts || 'x'", "ts || 'x'"),
        case("one side", "TRUE", "TRUE", "CAST(NULL AS VARCHAR)"),
    ]
    return f"WITH {_ADAPTER}\n" + "\nUNION ALL\n".join(parts)


def _replay_positions_sql() -> str:
    return f"""WITH {_WIDE},
g AS (SELECT ts, server_id, count(*) AS samples FROM wide WHERE ts IS NOT NULL GROUP BY ts, server_id),
p AS (SELECT *, CAST(sum(samples) OVER (ORDER BY ts, server_id) AS BIGINT) AS upto FROM g)
SELECT ts, server_id, upto - samples AS first_position, upto - 1 AS last_position, samples FROM p"""


def _replay_epochs_sql() -> str:
    """No second of the test tables weighs more than an epoch, so epochs are parts of the summed weights."""
    return f"""WITH {_WIDE},
c AS (SELECT ts, server_id, count(*) AS n FROM wide WHERE ts IS NOT NULL GROUP BY ts, server_id),
t AS (SELECT ts, max(n) AS weight FROM c GROUP BY ts),
b AS (SELECT ts, coalesce(sum(weight) OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {EPOCH_ROWS} AS part FROM t),
e AS (SELECT ts, dense_rank() OVER (ORDER BY part) - 1 AS epoch FROM b),
s AS (SELECT epoch, server_id, sum(n) AS n, min(ts) AS first, max(ts) AS last FROM c JOIN e USING (ts) GROUP BY epoch, server_id)
SELECT epoch, min(first) AS first_ts, max(last) AS last_ts, CAST(sum(n) AS BIGINT) AS samples, CAST(max(n) AS BIGINT) AS most_of_a_server, TRUE AS in_order
FROM s GROUP BY epoch"""


def _net_disk_sql(net_t: float = K.NET_THRESHOLD, disk_t: float = K.DISK_THRESHOLD) -> str:
    return f"WITH {_ADAPTER},{_windows_sql('net', 'net_in', 'disk', 'disk_io', 'max')}\n{_net_disk_select(net_t, disk_t)}"


def _net_disk_select(net_t: float, disk_t: float) -> str:
    n, d = f"{net_t!r}::DOUBLE", f"{disk_t!r}::DOUBLE"
    return f"""SELECT server_id, {_hms('ws')} AS window_start, {_hms('ws + 30')} AS window_end,
       CAST(a AS DOUBLE) AS max_net_in, CAST(b AS DOUBLE) AS max_disk_io,
       CASE WHEN a >= {n} AND b >= {d} THEN '{K.ALERT_NET_AND_DISK}'
            WHEN a >= {n} AND b < {d} THEN '{K.ALERT_NET}'
            WHEN b >= {d} AND a < {n} THEN '{K.ALERT_DISK}' END AS alert
FROM k WHERE rn > 2"""


def _metric_windows_sql(side: str) -> str:
    """Windows of one metric alone: rows of that metric only, offset from both."""
    left, lcol, right, rcol, agg, out = {
        "cpu": ("cpu", "cpu_pct", "mem", "mem_pct", "avg", "avg_cpu"),
        "mem": ("mem", "mem_pct", "cpu", "cpu_pct", "avg", "avg_mem"),
        "net": ("net", "net_in", "disk", "disk_io", "max", "max_net_in"),
        "disk": ("disk", "disk_io", "net", "net_in", "max", "max_disk_io"),
    }[side]
    return f"""WITH {_ADAPTER},
u AS (SELECT server_id, {_sec()} AS sec, CAST({lcol} AS DOUBLE) AS l, TRUE AS mine FROM {left}
      UNION ALL
      SELECT server_id, {_sec()} AS sec, NULL, FALSE FROM {right}),
o AS (SELECT coalesce({_pmod('min(sec)', 10)}, 0) AS off FROM u),
s AS (SELECT server_id, sec - {_pmod('sec - (SELECT off FROM o)', 10)} AS slot, l
      FROM u WHERE sec IS NOT NULL AND mine),
w AS (SELECT server_id, unnest([slot - 20, slot - 10, slot]) AS ws, l FROM s)
SELECT server_id, {_hms('ws')} AS window_start, {_hms('ws + 30')} AS window_end,
       {_round2(f'{agg}(l)')} AS {out}
FROM w GROUP BY server_id, ws"""


def _window_offset_sql() -> str:
    return f"""WITH {_ADAPTER},
u AS (SELECT {_sec()} AS sec FROM cpu UNION ALL SELECT {_sec()} AS sec FROM mem)
SELECT CASE WHEN min(sec) IS NOT NULL THEN {_hms('min(sec)')} END AS earliest,
       CAST(coalesce({_pmod('min(sec)', 10)}, 0) AS INTEGER) AS window_offset FROM u"""


def _combined_windows_sql() -> str:
    return f"""WITH {_ADAPTER},{_windows_sql('cpu', 'cpu_pct', 'mem', 'mem_pct', 'avg')}
SELECT server_id, {_hms('ws')} AS window_start, {_hms('ws + 30')} AS window_end,
       a AS avg_cpu, b AS avg_mem
FROM g"""


def _warmup_dropped_sql() -> str:
    return f"""WITH {_ADAPTER},{_windows_sql('net', 'net_in', 'disk', 'disk_io', 'max')}
SELECT server_id, {_hms('ws')} AS window_start, {_hms('ws + 30')} AS window_end,
       CAST(rn AS INTEGER) AS rn, a AS max_net_in, b AS max_disk_io
FROM k WHERE rn <= 2"""


def _input_status_sql() -> str:
    return f"""WITH {_ADAPTER},
u AS (SELECT 0 AS side, {_sec()} AS sec FROM cpu UNION ALL SELECT 1 AS side, {_sec()} AS sec FROM mem),
a AS (SELECT count(*) FILTER (WHERE side = 0) AS left_rows,
             count(*) FILTER (WHERE side = 1) AS right_rows,
             count(*) FILTER (WHERE side = 0 AND sec IS NOT NULL) AS left_timed,
             count(*) FILTER (WHERE side = 1 AND sec IS NOT NULL) AS right_timed,
             min(sec) AS min_sec FROM u)
SELECT left_rows, right_rows, left_timed, right_timed,
       CASE WHEN min_sec IS NOT NULL THEN {_hms('min_sec')} END AS earliest,
       CAST(coalesce({_pmod('min_sec', 10)}, 0) AS INTEGER) AS window_offset,
       CASE WHEN left_rows + right_rows = 0 THEN 'no data'
            WHEN left_timed + right_timed = 0 THEN 'no event time' ELSE 'ok' END AS status
FROM a"""


def _event_time_sql() -> str:
    return f"""WITH t AS (
  SELECT CASE event_type
           WHEN 'click' THEN {_TOD}
           WHEN 'view' THEN regexp_replace({_TOD}, '^0', '')
           WHEN 'purchase' THEN {_TOD} || '.5'
           WHEN 'error' THEN ' ' || {_TOD}
           ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
         {_SERVER} AS server_id, CAST(value AS FLOAT) AS cpu_val
  FROM events)
SELECT ts, server_id, CASE WHEN {_sec()} IS NOT NULL THEN '1970-01-01 ' || ts END AS event_time, cpu_val FROM t"""


def _replay_order_sql() -> str:
    return f"""WITH {_WIDE}
SELECT ts, server_id, cpu_pct, mem_pct, net_in, net_out, disk_io FROM wide WHERE ts IS NOT NULL"""


def _fan_out_sql() -> str:
    base = "'00:00:00' AS stamp, ts AS original_ts, server_id"
    n = "CAST(NULL AS DOUBLE)"
    return f"""WITH {_WIDE}
SELECT 'topic-cpu' AS topic, server_id AS key, {base}, cpu_pct, {n} AS mem_pct, {n} AS net_in, {n} AS net_out, {n} AS disk_io FROM wide
UNION ALL
SELECT 'topic-mem', server_id, {base}, {n}, mem_pct, {n}, {n}, {n} FROM wide
UNION ALL
SELECT 'topic-net', server_id, {base}, {n}, {n}, net_in, net_out, {n} FROM wide
UNION ALL
SELECT 'topic-disk', server_id, {base}, {n}, {n}, {n}, {n}, disk_io FROM wide"""


def _routed_sql() -> str:
    n = "CAST(NULL AS DOUBLE)"
    return f"""WITH {_ROUTED}
SELECT 'cpu' AS metric, ts, server_id, CAST(cpu_pct AS DOUBLE) AS measure, {n} AS extra FROM rcpu
UNION ALL SELECT 'mem', ts, server_id, CAST(mem_pct AS DOUBLE), {n} FROM rmem
UNION ALL SELECT 'net', ts, server_id, net_in, net_out FROM rnet
UNION ALL SELECT 'disk', ts, server_id, disk_io, {n} FROM rdisk"""


def _topic_counts_sql() -> str:
    return f"""WITH c AS (SELECT count(*) FILTER (WHERE {_METRIC_EVENTS}) AS m,
                  count(*) FILTER (WHERE event_type = 'signup') AS s,
                  count(*) FILTER (WHERE event_type = 'error') AS e FROM events)
SELECT 'topic-cpu' AS topic, m AS messages, m AS stored, CAST(0 AS BIGINT) AS quarantined FROM c
UNION ALL SELECT 'topic-mem', m, m, 0 FROM c
UNION ALL SELECT 'topic-net', m, m, 0 FROM c
UNION ALL SELECT 'topic-disk', m + e, m, e FROM c
UNION ALL SELECT 'topic-other', s, 0, 0 FROM c WHERE s > 0"""


def _quarantined_sql() -> str:
    return f"""SELECT 'topic-disk' AS topic, {_SERVER} AS key, 'error:' || CAST(event_id AS VARCHAR) AS text
FROM events WHERE event_type = 'error'"""


def _wide_round_trip_sql() -> str:
    return f"""WITH {_WIDE}
SELECT ts, server_id, cpu_pct, mem_pct, net_in, net_out, disk_io FROM wide"""


def _empty_landed_sql() -> str:
    return f"""SELECT 'cpu' AS metric, count(*) AS rows, 3 AS columns FROM events WHERE {_METRIC_EVENTS}
UNION ALL SELECT 'mem', CAST(0 AS BIGINT), 3"""


def _records_alerts_sql(pair: str) -> str:
    """Alerts over the tables landed from every metric event's records."""
    if pair == "cpu_mem":
        return f"""WITH {_ROUTED},{_windows_sql('rcpu', 'cpu_pct', 'rmem', 'mem_pct', 'avg')}
{_cpu_mem_select(K.CPU_THRESHOLD, K.MEM_THRESHOLD)}"""
    return f"""WITH {_ROUTED},{_windows_sql('rnet', 'net_in', 'rdisk', 'disk_io', 'max')}
{_net_disk_select(K.NET_THRESHOLD, K.DISK_THRESHOLD)}"""


def _stream_alerts_sql(pair: str) -> str:
    """Batch alerts over the record-landed tables, windows closed by the final watermark only."""
    return f"""{_records_alerts_sql(pair)}
  AND ws + 30 <= (SELECT max_sec FROM o) - {STREAM_WATERMARK_SECONDS}"""


def _published_ledger_sql() -> str:
    """Versions after each third of the month, on times of day: v has the rows of all thirds up to its own."""
    return f"""WITH {_WIDE},
e AS (SELECT CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS arrived, event_id FROM events),
step AS (SELECT min(arrived) AS lo, (max(arrived) - min(arrived)) // {ARRIVALS} + 1 AS n FROM e),
r AS (SELECT (arrived - lo) // n + 1 AS b, server_id, {_sec()} AS sec FROM wide JOIN e USING (event_id), step WHERE {_METRIC_EVENTS}),
v AS (SELECT unnest(range(1, {ARRIVALS} + 1)) AS v),
o AS (SELECT v, coalesce({_pmod('min(sec)', 10)}, 0) AS off FROM v JOIN r ON b <= v GROUP BY v),
whole AS (SELECT o.v, p.off IS DISTINCT FROM o.off AS whole FROM o LEFT JOIN o p ON p.v = o.v - 1),
s AS (SELECT DISTINCT v, b, server_id, sec - {_pmod('sec - off', 10)} AS slot FROM o JOIN r ON b <= v),
f AS (SELECT v, server_id, min(slot) AS first_slot FROM s GROUP BY v, server_id),
w AS (SELECT v, b, server_id, unnest([slot - 20, slot - 10, slot]) AS ws FROM s),
k AS (SELECT DISTINCT v, b, server_id, ws FROM w JOIN f USING (v, server_id) WHERE ws >= first_slot),
t AS (SELECT DISTINCT v, server_id, ws FROM k JOIN whole USING (v) WHERE whole OR b = v
      UNION
      SELECT v, server_id, ws FROM (SELECT n.v, n.server_id, n.first_slot, unnest([p.first_slot - 20, p.first_slot - 10]) AS ws
            FROM f n JOIN f p ON p.v = n.v - 1 AND p.server_id = n.server_id JOIN whole ON whole.v = n.v AND NOT whole)
      WHERE ws >= first_slot)
SELECT v AS version, count(*) AS touched,
       count(*) FILTER (WHERE NOT whole AND EXISTS (SELECT 1 FROM k WHERE k.v = t.v - 1 AND k.server_id = t.server_id AND k.ws = t.ws)) AS late
FROM t JOIN whole USING (v) GROUP BY v"""


def oracle_sql() -> dict[str, str]:
    return {
        "cpu_mem_alerts": _cpu_mem_sql(),
        "net_disk_alerts": _net_disk_sql(),
        "cpu_mem_alerts_full_time": _cpu_mem_full_time_sql(),
        "cpu_mem_alerts_two_tables": _cpu_mem_sql(),
        "net_disk_alerts_two_tables": _net_disk_sql(),
        "cpu_mem_alerts_join_form": _cpu_mem_sql(),
        "net_disk_alerts_join_form": _net_disk_sql(),
        "records_cpu_mem_alerts": _records_alerts_sql("cpu_mem"),
        "records_net_disk_alerts": _records_alerts_sql("net_disk"),
        "custom_thresholds": _cpu_mem_sql(K.README_CPU_THRESHOLD, K.README_MEM_THRESHOLD),
        "custom_thresholds_net_disk": _net_disk_sql(K.README_NET_THRESHOLD, K.README_DISK_THRESHOLD),
        "cpu_window_avg": _metric_windows_sql("cpu"),
        "mem_window_avg": _metric_windows_sql("mem"),
        "net_window_max": _metric_windows_sql("net"),
        "disk_window_max": _metric_windows_sql("disk"),
        "window_offset": _window_offset_sql(),
        "combined_windows": _combined_windows_sql(),
        "warmup_dropped": _warmup_dropped_sql(),
        "input_status": _input_status_sql(),
        "event_time_parsed": _event_time_sql(),
        "replay_order": _replay_order_sql(),
        "fan_out": _fan_out_sql(),
        "encode_decode_route": _routed_sql(),
        "topic_counts": _topic_counts_sql(),
        "quarantined_records": _quarantined_sql(),
        "csv_round_trip": _net_disk_sql(),
        "wide_csv_round_trip": _wide_round_trip_sql(),
        "landed_metrics": _routed_sql(),
        "landed_topic_counts": _topic_counts_sql(),
        "empty_metric_landed": _empty_landed_sql(),
        "csv_round_trip_cpu_mem": _counted_cpu_mem_sql(),
        "produced_landed_alerts": _produced_sql(),
        "job_guards": _job_guards_sql(),
        "replay_positions": _replay_positions_sql(),
        "replay_epochs": _replay_epochs_sql(),
        "sorted_alerts": f"SELECT *, row_number() OVER (ORDER BY server_id, window_start, window_end) - 1 AS position FROM ({_cpu_mem_sql()})",
        "landed_quarantine": _quarantined_sql(),
        "stream_cpu_mem_alerts": _stream_alerts_sql("cpu_mem"),
        "stream_cpu_mem_alerts_closed": _records_alerts_sql("cpu_mem"),
        "stream_cpu_mem_alerts_full_time": _cpu_mem_full_time_sql(),
        "stream_net_disk_alerts_closed": _records_alerts_sql("net_disk"),
        "stream_records_full_time": _records_full_time_sql(),
        "stream_net_disk_alerts": _stream_alerts_sql("net_disk"),
        "published_cpu_mem_alerts": _records_alerts_sql("cpu_mem"),
        "published_net_disk_alerts": _records_alerts_sql("net_disk"),
        "published_ledger": _published_ledger_sql(),
        "landed_states_alerts": _produced_sql(),
        "restarted_topic_counts": _topic_counts_sql(),
        "compacted_landing": _routed_sql(),
        **(llm_registry.oracle_sql() if llm_registry else {}),
    }
