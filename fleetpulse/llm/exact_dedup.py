"""Exact dedup by composable polynomial fingerprints.

A text's fingerprint is its UTF-8 length and the polynomial
`sum(byte[i] * x^(n-1-i)) mod p` for two bases. Two neighbouring pieces
combine by length-shifted arithmetic, `h(ab) = h(a) * x^len(b) + h(b)`,
so the chunks of a huge text are hashed by different tasks and summed.
Texts with equal fingerprints are then compared chunk by chunk; a
fingerprint shared by different texts is split by the text's SHA-256.

Defined cases: a null text counts as empty, and all empty texts are
equal. Every row is a member of its group, repeated rows included; rows
that share a doc_id and a text stand or fall together. A null doc_id is
kept only if its group holds no other id. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import table, text_column, written

PRIME = (1 << 31) - 1
BASES = (1_000_003, 805_306_457)
ROW = 4096  # bytes per dot product; 255 * PRIME * ROW stays below 2^63
CHUNK = 32 * 1024  # bytes per chunk of a huge text, and per compared chunk

FP_SCHEMA = "doc_id long, n_bytes long, h1 long, h2 long, sha string"
_KEY = ["n_bytes", "h1", "h2"]


def _powers(prime: int) -> np.ndarray:
    """(ROW, 2) powers of both bases, highest first."""
    out = np.empty((ROW, 2), np.int64)
    for j, base in enumerate(BASES):
        v = 1
        for i in range(ROW - 1, -1, -1):
            out[i, j] = v
            v = v * base % prime
    return out


def _hash(data: bytes, powers: np.ndarray, shift: tuple[int, int], prime: int) -> tuple[int, int]:
    """Fingerprint of a piece; zero bytes in front add nothing to the polynomial."""
    n = len(data)
    rows = max(1, -(-n // ROW))
    padded = np.zeros(rows * ROW, np.int64)
    padded[rows * ROW - n :] = np.frombuffer(data, np.uint8)
    h1 = h2 = 0
    for a, b in (padded.reshape(rows, ROW) @ powers % prime).tolist():
        h1, h2 = (h1 * shift[0] + a) % prime, (h2 * shift[1] + b) % prime
    return h1, h2


def combine(left: tuple[int, int], right: tuple[int, int], right_bytes: int, prime: int = PRIME) -> tuple[int, int]:
    """Fingerprint of two neighbouring pieces."""
    return tuple((a * pow(x, right_bytes, prime) + b) % prime for a, b, x in zip(left, right, BASES, strict=True))


def fingerprint(data: bytes, prime: int = PRIME) -> tuple[int, int]:
    """Fingerprint of one piece of bytes."""
    return _hash(data, _powers(prime), tuple(pow(x, ROW, prime) for x in BASES), prime)


def fingerprints(docs: DataFrame, chunk: int = CHUNK, prime: int = PRIME) -> DataFrame:
    """One row per document: doc_id, n_bytes, h1, h2 and the text's SHA-256."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(text_column(), "UTF-8").alias("data"))
    base = base.select("doc_id", F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("sha"), "data")

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, shift = _powers(prime), tuple(pow(x, ROW, prime) for x in BASES)
        for b in batches:
            hs = [_hash(x.as_buffer(), powers, shift, prime) if x.is_valid else (0, 0) for x in b.column(3)]
            h1, h2 = (pa.array([h[k] for h in hs], pa.int64()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), h1, h2, b.column(2)], ["doc_id", "n_bytes", "h1", "h2", "sha"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                sha, data = b.column(0)[i].as_py(), memoryview(b.column(1)[i].as_buffer())
                for at in range(0, len(data), chunk):
                    part = bytes(data[at : at + chunk])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([sha]), pa.array([len(data) - at - len(part)], pa.int64()), pa.array([part], pa.binary())],
                        ["sha", "after", "part"],
                    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, shift = _powers(prime), tuple(pow(x, ROW, prime) for x in BASES)
        for b in batches:
            after = b.column(1).to_pylist()
            hs = [_hash(x.as_buffer(), powers, shift, prime) for x in b.column(2)]
            h1, h2 = (
                pa.array([h[k] * pow(BASES[k], n, prime) % prime for h, n in zip(hs, after, strict=True)], pa.int64())
                for k in (0, 1)
            )
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), h1, h2], ["sha", "after", "h1", "h2"])

    # One of the copies of a huge text is hashed; each task merges its own copies first.
    huge = base.filter(F.col("n_bytes") > chunk)
    parts = (
        huge.groupBy("sha")
        .agg(F.first("data").alias("data"))
        .mapInArrow(pieces, "sha string, after long, part binary")
        .repartition("sha", "after")
        .mapInArrow(hashed, "sha string, after long, h1 long, h2 long")
    )
    whole = (
        parts.groupBy("sha", "after")
        .agg(F.max("h1").alias("h1"), F.max("h2").alias("h2"))
        .groupBy("sha")
        .agg((F.sum("h1") % prime).alias("h1"), (F.sum("h2") % prime).alias("h2"))
    )
    # Both sides of this join and of the next one are plain shuffles, so a hot text's rows can be split.
    whole = written(whole, "exact-huge")
    long_ones = huge.select("doc_id", "n_bytes", "sha").join(whole.hint("merge"), "sha").select("doc_id", "n_bytes", "h1", "h2", "sha")
    return base.filter(F.col("n_bytes") <= chunk).select("doc_id", "n_bytes", "sha", "data").mapInArrow(small, FP_SCHEMA).unionByName(long_ones)


def clashing(docs: DataFrame, fps: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Fingerprints (n_bytes, h1, h2) that different texts share, found chunk by chunk.

    Only rows whose fingerprint occurs twice or more are read in chunks.
    The comparison is an aggregate, so each task first merges its own
    copies: a group of any size sends one chunk row per task.
    """
    # One row per distinct text from here on; each task merges its copies first.
    texts = fps.groupBy("sha", *_KEY).agg(F.count("*").alias("n"))
    shared = texts.groupBy(*_KEY).agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    members = written(texts.drop("n").join(shared, _KEY, "left_semi"), "exact-members")
    data = docs.select(F.encode(text_column(), "UTF-8").alias("data"))
    data = data.select(F.sha2("data", 256).alias("sha"), "data")
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.octet_length("data") - 1) / chunk).cast("int")),
        lambda i: F.struct(i.alias("i"), F.substring("data", i * chunk + 1, F.lit(chunk)).alias("part")),
    )
    # Candidates grow with the documents: a sort-merge join at any size.
    rows = data.filter(F.octet_length("data") > 0).join(members.hint("merge"), "sha").select(*_KEY, F.explode(cut).alias("c"))
    rows = rows.select(*_KEY, "c.i", "c.part").groupBy(*_KEY, "i").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    return rows.filter("lo <> hi").select(*_KEY).distinct()


def exact_groups(docs: DataFrame, chunk: int = CHUNK, prime: int = PRIME) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    fps = written(fingerprints(docs, chunk, prime), "exact-fp")
    split = written(clashing(docs, fps, chunk), "exact-clash")
    if split.isEmpty():
        keyed = fps.withColumn("sub", F.lit(""))
    else:
        split = split.withColumn("clash", F.lit(True))
        keyed = fps.join(split, _KEY, "left").withColumn("sub", F.when(F.col("clash"), F.col("sha")).otherwise(F.lit("")))
    key = [*_KEY, "sub"]
    groups = keyed.groupBy(*key).agg(F.max("doc_id").alias("keep"), F.count("*").alias("size")).filter("size > 1")
    return keyed.join(groups, key, "left").select(
        "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        F.when(F.col("size").isNull(), F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("keep"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def q_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


SQL = """WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""
