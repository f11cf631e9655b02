"""Connected components of a table of links, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import dealt_join, written


def _sum(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(h, F.lit(1 << 31))), F.bit_xor(h)).first())


def components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """(id, root) of every id that occurs in a link with another id; root is the smallest id reachable.

    Every round first links each id's larger neighbours to its smallest
    neighbour, then each id and its smaller neighbours to the smallest of
    them, until only stars around the roots remain. Links stay distributed;
    each round is a few joins on ids, in which a star's centre is dealt over
    tasks, and is written to the shared folder.
    Null ids and links from an id to itself are ignored. `rows` bounds the
    number of links, for the number of files.
    """
    e = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = written(e, "links", rows)
    before = _sum(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "links-low", 2 * before[0])
        ends = dealt_join(both.filter("v > u"), low.select("u", F.least("u", "m").alias("m")), low, "u", "v")
        large = written(ends.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links", before[0])
        low = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "links-low", before[0])
        small = dealt_join(large, low.select("u", "m"), low, "u", "v").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links", before[0])
        now = _sum(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )
