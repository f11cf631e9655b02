"""Warm-up drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K


def rank_windows(df: DataFrame, order_col: str = "window.start") -> DataFrame:
    """Number each server's windows by start time, 1 = earliest."""
    w = Window.partitionBy("server_id").orderBy(F.col(order_col))
    return df.withColumn("rn", F.row_number().over(w))


def drop_warmup(df: DataFrame, n: int = K.WARMUP_WINDOWS, order_col: str = "window.start") -> DataFrame:
    """Drop each server's first `n` windows.

    The window function partitions by server only. That is safe at any
    input size because it runs after aggregation: a server has at most
    one window per 10 s of the day (8,642 counting the two that start
    before midnight), so even a server holding a third of all samples
    gives one task a few thousand rows. On full event times that bound is
    false; use `drop_warmup_by_first` there.
    """
    return rank_windows(df, order_col).filter(F.col("rn") > n).drop("rn")


#: Parts that a server's windows are spread over where they meet its first slot.
PARTS = 64


def drop_warmup_by_first(windows: DataFrame, slots: DataFrame) -> DataFrame:
    """Drop each server's first two windows without ranking them.

    The slot of a server's first event is held by its first three windows,
    which start 20 s and 10 s before the slot and at the slot. So the
    windows after the first two are those that start at that slot or later.

    `windows` has `ws`, `slots` has `slot` (both epoch seconds) and both
    have `server_id`, where null is a server of its own. One row per server
    is joined, under a key of (server, part of its windows): a server with
    a large share of all windows is spread over PARTS tasks.
    """
    firsts = slots.groupBy("server_id").agg(F.min("slot").alias("_first"))
    firsts = firsts.select(
        F.coalesce("server_id", F.lit("")).alias("_server"), F.col("server_id").isNull().alias("_null"), "_first",
        F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("_part"),
    )
    keyed = windows.withColumns({
        "_server": F.coalesce("server_id", F.lit("")),
        "_null": F.col("server_id").isNull(),
        "_part": F.pmod(F.floor(F.col("ws") / K.SLIDE_SECONDS), F.lit(PARTS)).cast("int"),
    })
    return keyed.join(firsts, ["_server", "_null", "_part"]).filter("ws >= _first").select(windows.columns)
