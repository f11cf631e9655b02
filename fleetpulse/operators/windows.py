"""Sliding windows and their aggregates.

Two ways to get the same rows:

* **Per-metric form** (what the reference writes): give every row each
  30 s window that holds it (`F.window`, planned as Expand x3), then
  `groupBy(server_id, window)` per metric. `window_aggregate` below.

* **Slot form** (what the jobs use): a 30 s window sliding by 10 s is
  the union of three 10 s slots. Aggregate the raw rows once per
  (server, slot) with mergeable partial states (sum + count for an
  average, max for a maximum), then merge three slots per window. The
  big shuffle carries one partial row per (server, slot) instead of
  three per (server, window), and both metrics share it. See
  `slot_window_aggregates`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import event_seconds, once, round2, safe_ratio, slot_start
from ..schemas import Metric, MetricPair
from .event_time import has_event_time

WINDOW = f"{K.WINDOW_SECONDS} seconds"
SLIDE = f"{K.SLIDE_SECONDS} seconds"
# Slots per window: every row lies in this many windows.
OVERLAP = -(-K.WINDOW_SECONDS // K.SLIDE_SECONDS)


def sliding_window(ts: Column | str, offset: int) -> Column:
    """30 s window, 10 s slide, starts aligned to `offset` seconds."""
    return F.window(ts, WINDOW, SLIDE, f"{int(offset)} seconds")


def window_struct(start_sec: Column) -> Column:
    """`struct<start,end>` of the window starting at `start_sec` epoch seconds."""
    return F.struct(
        F.timestamp_seconds(start_sec).alias("start"),
        F.timestamp_seconds(start_sec + F.lit(K.WINDOW_SECONDS)).alias("end"),
    )


def window_starts(slot: Column) -> Column:
    """Array of the starts of every window holding `slot`, oldest first."""
    return F.array(*[slot - F.lit(k * K.SLIDE_SECONDS) for k in reversed(range(OVERLAP))])


def assign_windows(df: DataFrame, offset: int | Column, ts_col: str = "ts_dt") -> DataFrame:
    """Each row once per sliding window that holds its time, as `window`.

    Rows with a null time get no window. An `int` offset uses Spark's
    own `window`; a Column offset (a scalar subquery) is expanded with
    the same arithmetic, since `window` only takes literal durations.
    """
    if not isinstance(offset, Column):
        return df.withColumn("window", sliding_window(ts_col, offset))
    slot = slot_start(F.unix_seconds(F.col(ts_col)), offset)
    return (
        df.filter(F.col(ts_col).isNotNull())
        .withColumn("_ws", F.explode(window_starts(slot)))
        .withColumn("window", window_struct(F.col("_ws")))
        .drop("_ws")
    )


# Non-null stand-ins for the server key, used by `window_aggregate(keyed=True)`.
SERVER_KEY = "_server_key"
SERVER_IS_NULL = "_server_is_null"


def window_aggregate(typed: DataFrame, metric: Metric, offset: int | Column, keyed: bool = False) -> DataFrame:
    """Per-metric rounded aggregate per (server, window).

    `typed` is the output of `with_event_time`. Average for CPU/memory,
    maximum for network/disk, rounded half-up to two decimals; null
    values are ignored but still make the window exist.

    `keyed=True` groups on (`_server_key`, `_server_is_null`, `window`)
    instead: a non-null form of the server id (null server = one group).
    Two such aggregates then join on plain equality, co-partitioned with
    their own shuffles (see `combine_windows`).
    """
    v = F.col(metric.value_alias)
    agg = F.avg(v) if metric.agg == "avg" else F.max(v)
    timed = has_event_time(typed.select("server_id", "ts_dt", metric.value_alias))
    windowed = assign_windows(timed, offset)
    if keyed:
        sid = F.col("server_id")
        keys = [F.coalesce(sid, F.lit("")).alias(SERVER_KEY), sid.isNull().alias(SERVER_IS_NULL), F.col("window")]
        return windowed.groupBy(*keys).agg(round2(agg).alias(metric.output))
    return windowed.groupBy("server_id", "window").agg(round2(agg).alias(metric.output))


# ---------------------------------------------------------------------------
# Slot form
# ---------------------------------------------------------------------------


def partial_states(pair: MetricPair) -> list[Column]:
    """Mergeable per-slot states of both metrics of a pair (`l`, `r` inputs)."""
    return [*_partial_specs(pair.left, "l"), *_partial_specs(pair.right, "r")]


def merged_states(pair: MetricPair) -> list[Column]:
    """Merge of `partial_states` over the slots of a window."""
    return [*_merge_specs(pair.left, "l"), *_merge_specs(pair.right, "r")]


def final_measures(pair: MetricPair) -> list[Column]:
    """Rounded window aggregates from merged states, named as the outputs."""
    return [_final(pair.left, "l"), _final(pair.right, "r")]


def _partial_specs(metric: Metric, col: str) -> list[Column]:
    v = F.col(col)
    if metric.agg == "avg":
        return [F.sum(v).alias(f"{col}_sum"), F.count(v).alias(f"{col}_n")]
    return [F.max(v).alias(f"{col}_max")]


def _merge_specs(metric: Metric, col: str) -> list[Column]:
    if metric.agg == "avg":
        return [F.sum(f"{col}_sum").alias(f"{col}_sum"), F.sum(f"{col}_n").alias(f"{col}_n")]
    return [F.max(f"{col}_max").alias(f"{col}_max")]


def _final(metric: Metric, col: str) -> Column:
    if metric.agg == "avg":
        value = safe_ratio(F.col(f"{col}_sum"), F.col(f"{col}_n"))
    else:
        value = F.col(f"{col}_max")
    return round2(value).alias(metric.output)


def long_form(left_typed: DataFrame, right_typed: DataFrame, pair: MetricPair) -> DataFrame:
    """Union of both typed inputs as (server_id, sec, l, r); the other side null.

    Rows without a parseable time are dropped here: they join no window.
    """
    lt, rt = pair.left.dtype, pair.right.dtype
    left = left_typed.select(
        "server_id",
        F.unix_seconds("ts_dt").alias("sec"),
        F.col(pair.left.value_alias).cast(lt).alias("l"),
        F.lit(None).cast(rt).alias("r"),
    )
    right = right_typed.select(
        "server_id",
        F.unix_seconds("ts_dt").alias("sec"),
        F.lit(None).cast(lt).alias("l"),
        F.col(pair.right.value_alias).cast(rt).alias("r"),
    )
    return left.unionByName(right).filter(F.col("sec").isNotNull())


def tagged_long_form(
    df: DataFrame,
    pair: MetricPair,
    is_left: Column,
    is_right: Column,
    event_time: Column | None = None,
    sec: Column | None = None,
) -> DataFrame:
    """Long form from ONE input holding both metrics, tagged per row.

    `df` has `ts` (text), `server_id` and the pair's measure columns;
    `is_left`/`is_right` say which metric a row carries (a topic or an
    event type; at most one holds per row). One scan feeds both metrics,
    as when one consumer subscribes to both topics.

    By default the event time is the `HH:mm:ss` text on 1970-01-01, as in
    the reference. `event_time` (a full timestamp) replaces it (decision
    D8): days then stay apart and a stream can run past midnight. Window
    labels stay `HH:mm:ss`. `sec` (epoch seconds, a plain column) is taken
    as it is.
    """
    if sec is None:
        sec = once(event_seconds(F.col("ts")) if event_time is None else F.unix_seconds(event_time))  # the time parse runs once per row
    return (
        df.filter(is_left | is_right)
        .select(
            "server_id",
            sec.alias("sec"),
            F.when(is_left, F.col(pair.left.measure).cast(pair.left.dtype)).alias("l"),
            F.when(is_right, F.col(pair.right.measure).cast(pair.right.dtype)).alias("r"),
        )
        .filter(F.col("sec").isNotNull())
    )


def slot_aggregates(long: DataFrame, pair: MetricPair, offset: int | Column) -> DataFrame:
    """Partial states per (server, 10 s slot), both metrics in one pass.

    This is the only shuffle of raw-input volume; Spark combines map-side
    first, so it carries at most one row per (server, slot) per task.
    The shuffle key includes the slot, so a server holding a third of all
    rows still spreads over every reducer.
    """
    # The slot is projected first, not computed inside the grouping: an
    # offset subquery over an input with non-deterministic lineage is
    # itself non-deterministic, which Spark allows in a projection only.
    return (
        long.withColumn("slot", slot_start(F.col("sec"), offset))
        .groupBy("server_id", "slot")
        .agg(*partial_states(pair))
    )


def second_states(long: DataFrame, pair: MetricPair) -> DataFrame:
    """Partial states per (server, second), both metrics in one pass.

    Seconds do not depend on the window offset, so these states can be
    kept before the earliest event is known, merged with later ones, and
    turned into slots at any offset. On times of day a server has at most
    86,400 of them, however many rows it has.
    """
    return long.groupBy("server_id", "sec").agg(*partial_states(pair))


def slots_from_seconds(states: DataFrame, pair: MetricPair, offset: int | Column) -> DataFrame:
    """`slot_aggregates` from (any number of rows of) `second_states`."""
    return states.withColumn("slot", slot_start(F.col("sec"), offset)).groupBy("server_id", "slot").agg(*merged_states(pair))


def slot_window_aggregates(slots: DataFrame, pair: MetricPair, by_server: bool = True) -> DataFrame:
    """Merge slot states into 30 s windows: (server_id, ws, window, aggregates).

    Slots are hash-partitioned on `server_id` once; the explode keeps that
    partitioning, so the window merge here and the per-server warm-up rank
    after it run without another shuffle. One server has at most one slot
    per 10 s of the day (8,640), so a partition holds a bounded number of
    rows per server however large the input is.

    On full event times a server has as many slots as the data has 10 s,
    so `by_server=False` merges on (server_id, ws): one more shuffle, and
    no task that holds all of a server.
    """
    merged = (
        (slots.repartition("server_id") if by_server else slots)
        .withColumn("ws", F.explode(window_starts(F.col("slot"))))
        .groupBy("server_id", "ws")
        .agg(*merged_states(pair))
    )
    return merged.select("server_id", "ws", window_struct(F.col("ws")).alias("window"), *final_measures(pair))
