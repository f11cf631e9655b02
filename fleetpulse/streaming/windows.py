"""Streaming windows, warm-up and alert sink.

Streams run the batch slot plan as two chained time-window
aggregations in append mode behind a watermark: raw rows into 10 s slot
states, slots into 30 s windows (`stream_windows_long`). Then comes the
per-server warm-up state (`stream_drop_warmup`) and the labels. A join
of two streamed aggregates would hold unmatched windows back for
another watermark step, so the join form is not used on streams.

A stream cannot know the global earliest event in advance, so the
window offset is a parameter (decision D7); `bootstrap_offset` derives it
from the data already there. `close_stream` completes a bounded stream:
the windows left open behind its final watermark, or all windows if rows
came too late. A stream runs on a session of its own (`stream_session`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import constants as K
from ..functions import session_instant, wall_clock_as_utc
from ..operators.alerts import label
from ..operators.event_time import with_event_time
from ..operators.status import window_offset
from ..operators.warmup import drop_warmup
from ..operators.windows import final_measures, long_form, merged_states, partial_states, sliding_window
from ..plans.jobs import kept_windows, long_windows
from ..schemas import CPU_MEM, MetricPair
from ..sources.csv_tables import CSV_WRITE_OPTIONS, one_line

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def bootstrap_offset(*landed: DataFrame) -> int:
    """Offset from a bounded (batch) read of what has landed so far."""
    row = window_offset(*landed).first()
    return int(row.window_offset)


def stream_windows_long(
    long: DataFrame,
    pair: MetricPair,
    offset: int = 0,
    watermark: str = "60 seconds",
) -> DataFrame:
    """Windowed aggregates of both metrics from a long-form stream.

    `long` is (server_id, sec, l, r): `long_form` of two streams, or
    `records.records_long` of one stream of both topics (one read per
    micro-batch). Output (append mode): `server_id`, `wstart`, `wend`
    (timestamps) and the pair's two rounded aggregates. A window is
    emitted once the watermark passes its end; rows later than the
    watermark are dropped.

    Two chained time-window aggregations, the slot plan on a stream:
    raw rows -> 10 s slots of mergeable partial states (the one shuffle
    of stream volume, one partial row per (server, slot) per task), then
    slots -> 30 s windows by the slot's event time (`window_time`, the
    slot's last instant, lies in exactly the three windows that hold the
    slot). A slot is final once the watermark passes its end, and so is
    a window, so both emit in the same micro-batch.
    """
    slot = F.window("et", f"{K.SLIDE_SECONDS} seconds", f"{K.SLIDE_SECONDS} seconds", f"{int(offset)} seconds")
    # Watermark and windows run on the wall-clock time as a UTC instant
    # (`et`), never before the epoch; bounds go back to session time after.
    slots = (
        long.withColumn("et", wall_clock_as_utc(F.timestamp_seconds("sec")))
        .withWatermark("et", watermark)
        .groupBy("server_id", slot.alias("slot"))
        .agg(*partial_states(pair))
    )
    return (
        slots.groupBy("server_id", sliding_window(F.window_time("slot"), offset).alias("window"))
        .agg(*merged_states(pair))
        .select(
            "server_id",
            session_instant("window.start").alias("wstart"),
            session_instant("window.end").alias("wend"),
            *final_measures(pair),
        )
    )


def stream_drop_warmup(windows: DataFrame, n: int = K.WARMUP_WINDOWS) -> DataFrame:
    """Apply `warmup_state.WarmupDrop` to the windows of `stream_windows_long` (T4).

    Needs the RocksDB state store, which `stream_session` sets.
    """
    from pyspark import cloudpickle

    from . import warmup_state

    cloudpickle.register_pickle_by_value(warmup_state)
    schema = windows.schema
    return windows.groupBy("server_id").transformWithStateInPandas(
        statefulProcessor=warmup_state.WarmupDrop(n),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None",
    )


def enable_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


#: Progress updates that a stream keeps, to count what it dropped.
PROGRESS = 10_000


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for a stream, with the settings it needs.

    `state_partitions` sets how many partitions each stateful operator
    (slot states, window states, warm-up counters) has. Spark takes it
    from `spark.sql.shuffle.partitions` when a checkpoint is first
    created and keeps it for the checkpoint's life. Size it to the state,
    not to the input: a few thousand windows need a few partitions, each
    open partition costs a state store per micro-batch. None keeps the
    session's value. The caller's session keeps its settings; build the
    stream's source and plan on the one returned.
    """
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    enable_state_store(own)
    own.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(PROGRESS))
    if state_partitions is not None:
        own.conf.set("spark.sql.shuffle.partitions", str(int(state_partitions)))
    return own


def stream_alert_rows(
    left: DataFrame | None = None,
    right: DataFrame | None = None,
    pair: MetricPair = CPU_MEM,
    offset: int = 0,
    watermark: str = "60 seconds",
    thresholds: tuple[float, float] | None = None,
    long: DataFrame | None = None,
    full_time: bool = False,
) -> DataFrame:
    """Labelled alert rows of a pair, as a stream.

    Give two landed-row streams (`left`, `right`) or one long-form
    stream (`long`, e.g. `records_long` of a stream of both topics).
    `full_time=True` adds the windows' times (D8).
    """
    if long is None:
        lt, rt = with_event_time(left, pair.left), with_event_time(right, pair.right)
        long = long_form(lt, rt, pair)
    kept = stream_drop_warmup(stream_windows_long(long, pair, offset, watermark))
    framed = kept.withColumn(
        "window", F.struct(F.col("wstart").alias("start"), F.col("wend").alias("end"))
    )
    return label(framed, pair, thresholds, full_time)


def stream_alerts(rows: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append alert rows to a CSV folder, checkpointed (T5).

    The stream runs with the settings of the session that its source was
    built on (`stream_session`).
    """
    w = (
        one_line(rows).writeStream.format("csv")
        .options(**CSV_WRITE_OPTIONS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def final_watermark(query: StreamingQuery) -> str | None:
    """The event-time watermark a finished stream ended with (ISO text, UTC),
    or None when it never set one."""
    for progress in reversed(query.recentProgress or []):
        wm = (progress.get("eventTime") or {}).get("watermark")
        if wm:
            return wm
    return None


def input_batches(query: StreamingQuery) -> int:
    """Micro-batches of a run that had input."""
    return sum(p["numInputRows"] > 0 for p in query.recentProgress or [])


def dropped_rows(query: StreamingQuery) -> int | None:
    """State rows that a run dropped as later than its watermark; None if its first progress updates are gone.

    A dropped state row stands for one or more input rows (the slot states
    are combined before they reach the state store).
    """
    progress = query.recentProgress or []
    if len(progress) >= PROGRESS:
        return None
    return sum(int(op.get("numRowsDroppedByWatermark") or 0) for p in progress for op in p.get("stateOperators", []))


@dataclass
class ClosedStream:
    """All alert rows of a bounded stream, what it dropped as late and how many micro-batches had input."""

    rows: DataFrame
    dropped: int | None
    batches: int


def close_stream(
    query: StreamingQuery,
    streamed: DataFrame,
    long: DataFrame,
    pair: MetricPair,
    offset: int,
    thresholds: tuple[float, float] | None = None,
    full_time: bool = False,
    on_late: str = "recompute",
) -> ClosedStream:
    """Complete the output of a drained stream from a batch read of the same data (`long`).

    Without late rows the streamed rows are right and only the windows
    behind the final watermark are missing: `closing_windows` adds them.
    A row dropped as late makes windows that were already written wrong,
    and may move a server's warm-up, and a stream does not say which rows
    they were. So if any was dropped (or the count is not known), the
    result is computed anew from all data and replaces the streamed rows;
    `on_late="fail"` raises instead. Counts are those of this run of the
    query; after restarts add up the runs, or recompute.
    """
    dropped = dropped_rows(query)
    if dropped == 0:
        rows = streamed.unionByName(closing_windows(long, pair, offset, final_watermark(query), thresholds, full_time))
    elif on_late == "fail":
        raise LateRowsError(f"the stream dropped {dropped} late state rows")
    else:
        kept = kept_windows(long, pair, offset) if full_time else drop_warmup(long_windows(long, pair, offset))
        rows = label(kept, pair, thresholds, full_time)
    return ClosedStream(rows, dropped, input_batches(query))


class LateRowsError(RuntimeError):
    """A stream dropped rows that came later than its watermark."""


#: Read so much before the open windows, whatever the session's time zone does meanwhile.
_MARGIN = 3 * 3600


def closing_windows(
    long: DataFrame,
    pair: MetricPair,
    offset: int,
    watermark: str | None,
    thresholds: tuple[float, float] | None = None,
    full_time: bool = False,
) -> DataFrame:
    """Alert rows a bounded stream left open: windows ending after `watermark`.

    A drained stream (`availableNow`) emits a window only once the
    watermark passes its end, so the last windows never come out. Run
    this batch plan over the same data (`long` as a batch, e.g. the
    landed tables) with the stream's offset and `final_watermark`. Only
    rows near the watermark and later are aggregated; of the older ones
    just each server's first event is looked up. If the stream dropped
    late rows this is not enough: use `close_stream`.
    """
    if watermark is None:
        windows = kept_windows(long, pair, offset)
    else:
        wm = F.to_timestamp(F.lit(watermark))
        since = long.sparkSession.range(1).select(F.unix_seconds(session_instant(wm)).alias("s")).first().s
        windows = kept_windows(long, pair, offset, since=int(since) - K.WINDOW_SECONDS - _MARGIN)
        windows = windows.filter(wall_clock_as_utc(F.col("window.end")) > wm)
    return label(windows, pair, thresholds, full_time)
