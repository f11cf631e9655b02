"""Combining the two metrics' windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_windows(a: DataFrame, b: DataFrame, keys: tuple[str, str] = ("server_id", "window")) -> DataFrame:
    """Full outer equi-join of two windowed aggregates, keys merged.

    The server key is compared null-safe, so windows of a null server
    from both sides meet in one row (decision D3) and the result equals
    the single-pass form. Spark plans this as a sort-merge full outer
    join; a full outer join cannot broadcast either side.

    Inputs from `window_aggregate(keyed=True)` join on their non-null key
    columns with plain equality: both sides are already hash-partitioned
    on exactly those keys, so the join adds no shuffle. (A null-safe
    comparison rewrites the join keys, which makes Spark shuffle both
    aggregates once more.)
    """
    from .windows import SERVER_IS_NULL, SERVER_KEY

    server, window = keys
    if SERVER_KEY in a.columns and SERVER_KEY in b.columns:
        j = a.join(b, [SERVER_KEY, SERVER_IS_NULL, window], "full_outer")
        rest = [c for c in j.columns if c not in (SERVER_KEY, SERVER_IS_NULL, window)]
        sid = F.when(F.col(SERVER_IS_NULL), F.lit(None).cast("string")).otherwise(F.col(SERVER_KEY))
        return j.select(sid.alias(server), window, *rest)
    la, lb = a.alias("_a"), b.alias("_b")
    cond = F.col(f"_a.{server}").eqNullSafe(F.col(f"_b.{server}")) & (
        F.col(f"_a.{window}") == F.col(f"_b.{window}")
    )
    rest_a = [c for c in a.columns if c not in keys]
    rest_b = [c for c in b.columns if c not in keys]
    return la.join(lb, cond, "full_outer").select(
        F.coalesce(F.col(f"_a.{server}"), F.col(f"_b.{server}")).alias(server),
        F.coalesce(F.col(f"_a.{window}"), F.col(f"_b.{window}")).alias(window),
        *[F.col(f"_a.{c}").alias(c) for c in rest_a],
        *[F.col(f"_b.{c}").alias(c) for c in rest_b],
    )
