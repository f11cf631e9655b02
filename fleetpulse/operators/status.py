"""Input guards and counts (P12, P13, A1, O2) plus the window offset (A2, A3).

The reference runs six separate actions for these (two counts, two
existence probes, two minima). Here they are one aggregate over the
union of both inputs: one pass, partial aggregation on every task, one
row back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import parse_time_of_day
from ..schemas import MetricPair

STATUS_OK = "ok"
STATUS_NO_DATA = "no data"
STATUS_NO_TIME = "no event time"


def _tagged_times(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, t) rows of both landed tables; `t` null when unparseable."""
    return left.select(F.lit(0).alias("side"), parse_time_of_day("ts").alias("t")).unionByName(
        right.select(F.lit(1).alias("side"), parse_time_of_day("ts").alias("t"))
    )


def _earliest_columns(t_min: Column) -> list[Column]:
    """Earliest event as `HH:mm:ss` text, and the window offset from it."""
    return [
        F.date_format(t_min, K.LABEL_FORMAT).alias("earliest"),
        offset_from_min(F.unix_seconds(t_min)).alias("window_offset"),
    ]


def input_status(left: DataFrame, right: DataFrame) -> DataFrame:
    """One-row summary of two landed metric tables.

    Columns: `left_rows`, `right_rows`, `left_timed`, `right_timed`
    (rows with a parseable time), `earliest` (earliest event time as
    `HH:mm:ss`, null if none), `window_offset` (A3) and `status`:
    `no data` when both tables are empty (P12: success, nothing to
    write), `no event time` when no row has a parseable time (P13:
    error), else `ok`.
    """
    t = _tagged_times(left, right)
    is_left, is_right = F.col("side") == 0, F.col("side") == 1
    agg = t.agg(
        F.count_if(is_left).alias("left_rows"),
        F.count_if(is_right).alias("right_rows"),
        F.count_if(is_left & F.col("t").isNotNull()).alias("left_timed"),
        F.count_if(is_right & F.col("t").isNotNull()).alias("right_timed"),
        F.min("t").alias("t_min"),
    )
    return _status(agg)


def _status(agg: DataFrame) -> DataFrame:
    return agg.select(
        "left_rows",
        "right_rows",
        "left_timed",
        "right_timed",
        *_earliest_columns(F.col("t_min")),
        F.when((F.col("left_rows") + F.col("right_rows")) == 0, F.lit(STATUS_NO_DATA))
        .when((F.col("left_timed") + F.col("right_timed")) == 0, F.lit(STATUS_NO_TIME))
        .otherwise(F.lit(STATUS_OK))
        .alias("status"),
    )


def landed_status(times: DataFrame, pair: MetricPair) -> DataFrame:
    """`input_status` of a pair from what its tables were landed with: a few rows instead of both tables.

    `times` has rows of metric, `rows`, `timed` (rows with a parseable
    time) and `min_sec` (earliest event second).
    """
    of = lambda m, c: F.coalesce(F.sum(F.when(F.col("metric") == m.name, F.col(c))), F.lit(0)).cast("long")
    rows = times.filter(F.col("metric").isin(pair.left.name, pair.right.name)).agg(
        of(pair.left, "rows").alias("left_rows"),
        of(pair.right, "rows").alias("right_rows"),
        of(pair.left, "timed").alias("left_timed"),
        of(pair.right, "timed").alias("right_timed"),
        F.min("min_sec").alias("min_sec"),
    )
    return _status(rows.withColumn("t_min", F.timestamp_seconds("min_sec")))


def offset_from_min(min_sec: Column) -> Column:
    """Alignment offset = earliest event (epoch seconds) mod slide, never
    negative; 0 if none (A3)."""
    return F.coalesce(F.pmod(min_sec, F.lit(K.SLIDE_SECONDS)), F.lit(0)).cast("int")


def window_offset(*landed: DataFrame) -> DataFrame:
    """One row: `earliest` event time over all given landed tables and the
    `window_offset` derived from it (A2, A3).

    `min` ignores nulls, so a table without any parseable time does not
    take part, as in the reference.
    """
    times = None
    for df in landed:
        s = df.select(parse_time_of_day("ts").alias("t"))
        times = s if times is None else times.unionByName(s)
    return times.agg(F.min("t").alias("t_min")).select(*_earliest_columns(F.col("t_min")))


def offset_column(*landed: DataFrame) -> Column:
    """The offset as a scalar-subquery Column, so a plan can use it lazily.

    Catalyst runs the subquery once, before the stage that needs it; it
    reads only the `ts` column of each input.
    """
    return window_offset(*landed).select("window_offset").scalar()
