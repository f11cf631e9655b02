"""Commit records of a landing: what a reader may see.

A micro-batch lands as several folders: metric tables, states, quarantine.
They are written first and one commit record last, a single file that is
there or not. Readers go by the records, so a batch's tables, counts and
earliest times appear together, and a batch that was cut off on the way
is never seen. A compaction is a commit too: it names what it replaces,
so many small batches turn into one in the same single step.

A record also holds the batch's messages, stored, quarantined and timed
records and earliest event per topic. Their sums over the records that
count are the landing's totals, however often a stream was restarted.

One writer at a time: the stream that lands, or a compaction between two
runs of it or beside it, but not two compactions at once. The driver
reads one row of names for each commit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "commits"

TOPIC_FIELDS = T.StructType(
    [T.StructField("topic", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("messages", "stored", "quarantined", "timed", "min_sec")]
)
COMMIT_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("tables", T.ArrayType(T.StringType())),
    T.StructField("replaces", T.ArrayType(T.StringType())),
    T.StructField("topics", T.ArrayType(TOPIC_FIELDS)),
])


def folder(base: str, table: str, name: str) -> str:
    """Folder of one commit's part of a table."""
    return f"{base.rstrip('/')}/{table}/batch={name}"


def if_there(read, otherwise):
    """`read()`, or `otherwise()` if its path does not exist (yet)."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return otherwise()


def read_commits(spark: SparkSession, base: str) -> DataFrame:
    """All commit records, replaced ones too; none before the first commit."""
    path = f"{base.rstrip('/')}/{COMMITS}"
    return if_there(
        lambda: spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", True).json(path),
        lambda: spark.createDataFrame([], COMMIT_SCHEMA),
    )


def is_committed(spark: SparkSession, base: str, name: str) -> bool:
    return not read_commits(spark, base).filter(F.col("name") == name).isEmpty()


def commit(topics: DataFrame, base: str, name: str, tables: list[str], replaces: tuple[str, ...] = ()) -> None:
    """Write the record that makes the folders `name` of `tables` count, in place of those of `replaces`.

    `topics` has the fields of TOPIC_FIELDS, a row for each topic.
    """
    fields = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TOPIC_FIELDS])
    record = topics.agg(F.collect_list(fields).alias("topics")).select(
        F.lit(name).alias("name"),
        F.lit(list(tables)).cast("array<string>").alias("tables"),
        F.lit(list(replaces)).cast("array<string>").alias("replaces"),
        "topics",
    )
    record.coalesce(1).write.mode("overwrite").json(folder(base, COMMITS, name))


@dataclass(frozen=True)
class Landing:
    """The commits of a landing that count, each with its tables, and what compactions stand for."""

    base: str
    tables: dict[str, frozenset[str]]
    replaced: dict[str, tuple[str, ...]]

    def names(self, table: str) -> list[str]:
        return [n for n, has in self.tables.items() if table in has]

    def paths(self, table: str, names: list[str] | None = None) -> list[str]:
        return [folder(self.base, table, n) for n in (self.names(table) if names is None else names)]

    def within(self, name: str, known: frozenset[str]) -> bool:
        """Whether a commit's rows are all of commits in `known`: itself, or all that it replaced."""
        parts = self.replaced.get(name, ())
        return name in known or bool(parts) and all(self.within(p, known) for p in parts)


def landing(spark: SparkSession, base: str) -> Landing:
    """What counts of a landing now."""
    rows = sorted(read_commits(spark, base).select("name", "tables", "replaces").collect(), key=lambda r: r.name)
    replaced = {r.name: tuple(r.replaces or ()) for r in rows if r.replaces}
    gone = {n for parts in replaced.values() for n in parts}
    return Landing(base.rstrip("/"), {r.name: frozenset(r.tables or ()) for r in rows if r.name not in gone}, replaced)


def landed_topics(spark: SparkSession, base: str) -> DataFrame:
    """name, tables and the fields of TOPIC_FIELDS of each topic of each commit that counts."""
    records = read_commits(spark, base)
    gone = records.select(F.explode("replaces").alias("name")).distinct()
    live = records.join(gone, "name", "left_anti")
    return live.select("name", "tables", F.explode("topics").alias("t")).select("name", "tables", "t.*")
