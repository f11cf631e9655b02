"""Helpers shared by the operators: table access, lineage cuts, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.session import shared_dir

#: Byte classes of the two word rules, after lower-casing A-Z. Everything
#: at or above 0x80 is a word byte, so a rule on characters is one on bytes.
WORD_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, rows: int | None = None, per_file: int = 100_000) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back.

    Cuts lineage so that a lost executor costs no recomputation upstream,
    and gives the planner the true size of the table. With `rows`, a bound
    on the rows there may be, they go to files of about `per_file` rows:
    a small table is then not scattered over as many files as there are
    shuffle partitions.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.repartition(max(1, -(-rows // per_file)))
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key that holds more than one in PARTS of all rows, and more than SHARE rows, is dealt over several tasks.
PARTS = 256
SHARE = 1000


def dealt_join(rows: DataFrame, groups: DataFrame, counts: DataFrame, key: str, by: str) -> DataFrame:
    """Inner join of `rows` and `groups` on `key`, in which no key brings a large share of the rows to one task.

    `counts` (key, n), a written table, says how many of the rows have a
    key. The rows of a hot key are dealt out by a hash of column `by`, and
    its groups are repeated for each part. The hot keys are broadcast: as
    each has more than one in PARTS of the rows, there are fewer than PARTS.
    """
    total, largest = counts.agg(F.sum("n"), F.max("n")).first()
    share = max(SHARE, (total or 0) // PARTS)
    if (largest or 0) <= share:
        return rows.join(groups, key)
    hot = F.broadcast(counts.filter(F.col("n") > share).select(key, F.ceil(F.col("n") / share).alias("parts")))
    rows = rows.join(hot, key, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64(by), F.col("parts")), F.lit(0).cast("long")))
    last = F.coalesce(F.col("parts"), F.lit(1).cast("long")) - 1
    groups = groups.join(hot, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return rows.drop("parts").join(groups.drop("parts"), [key, "part"]).drop("part")


def text_column(name: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of an Arrow batch as tuples of Python values, one row at a time."""
    columns = batch.columns
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


def letter_words(text: str) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def space_words(text: str) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class Batches:
    """Collects output rows and turns them into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, max_rows: int = 20_000, max_cost: int = 8 << 20):
        self.schema, self.max_rows, self.max_cost = schema, max_rows, max_cost
        self.rows: list[tuple] = []
        self.cost = 0

    def add(self, row: tuple, cost: int = 0) -> pa.RecordBatch | None:
        self.rows.append(row)
        self.cost += cost
        return self.flush() if len(self.rows) >= self.max_rows or self.cost >= self.max_cost else None

    def flush(self) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        columns = list(zip(*self.rows, strict=True))
        self.rows, self.cost = [], 0
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, self.schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)
