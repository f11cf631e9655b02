"""Benchmark decontamination by winnowing.

A window is WINDOW consecutive words of a benchmark item, or all words of
a shorter item. For windows of m words, texts are fingerprinted by k-grams
with k = (m + 1) // 2: of every m - k + 1 consecutive k-grams the smallest
hash is kept, the last of equal ones. So two texts that share m words
share a kept fingerprint inside them. Fingerprints of documents and items
are joined; around each hit the document's windows are compared with the
items' windows, word by word.

Defined cases: a null text has no words; an item without words has no
window. Items with one item_id are one item; a null item_id is listed as
an empty string. Repeated documents each get their row. Empty tables give
an empty result, or clean documents. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, letter_words, table, text_column, written

WINDOW = 13


def gram_size(m: int) -> int:
    return (m + 1) // 2


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def winnow(hashes: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the kept k-grams of a text of word hashes, for windows of m words."""
    k = gram_size(m)
    n = len(hashes) - k + 1
    span = m - k + 1
    if n < span:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        grams = np.zeros(n, np.uint64)
        for i in range(k):
            grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
        grams = (grams ^ (grams >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        grams ^= grams >> np.uint64(32)
    least = grams[: n - span + 1].copy()
    at = np.zeros(len(least), np.int64)
    for i in range(1, span):
        other = grams[i : n - span + 1 + i]
        new = other <= least
        least[new] = other[new]
        at[new] = i
    kept = np.unique(at + np.arange(len(least)))
    return kept, grams[kept]


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, m, words, window, prints): every window of every item as text, its digest, and the fingerprints kept inside it."""
    kind = pa.schema([("item", pa.string()), ("m", pa.int32()), ("words", pa.binary()), ("prints", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = Batches(kind)
            for item, text in zip(b.column(0), b.column(1), strict=True):
                words = letter_words(text.as_py())
                m = min(window, len(words))
                if not m:
                    continue
                hashes = word_hashes(words)
                for i in range(len(words) - m + 1):
                    prints = winnow(hashes[i : i + m], m)[1].view(np.int64).tolist()
                    full = out.add((item.as_py(), m, b" ".join(words[i : i + m]), prints), 200)
                    if full is not None:
                        yield full
            if (rest := out.flush()) is not None:
                yield rest

    base = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_column().alias("text"))
    return base.mapInArrow(run, "item string, m int, words binary, prints array<long>").distinct().withColumn("window", F.sha2("words", 256))


def _documents(docs: DataFrame) -> DataFrame:
    """Rows with a key of 128 bits (r1, r2) made of id and text."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return base.select("*", F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("r2"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, r1, r2, n_words) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = pa.array([len(letter_words(t.as_py())) for t in b.column(3)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), n], ["doc_id", "r1", "r2", "n_words"])

    return _documents(docs).select("doc_id", "r1", "r2", "text").mapInArrow(run, "doc_id long, r1 long, r2 long, n_words long")


def fingerprints(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(r1, r2, m, at, print): kept fingerprints of documents for windows of each of the sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                r1, r2 = part.column(0).to_numpy(), part.column(1).to_numpy()
                found: list[tuple[np.ndarray, ...]] = []
                for a, b2, text in zip(r1, r2, part.column(2), strict=True):
                    hashes = word_hashes(letter_words(text.as_py()))
                    for m in sizes:
                        at, prints = winnow(hashes, m)
                        found.append((np.full(len(at), a), np.full(len(at), b2), np.full(len(at), m, np.int32), at.astype(np.int32), prints.view(np.int64)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["r1", "r2", "m", "at", "print"])

    return _documents(docs).select("r1", "r2", "text").mapInArrow(run, "r1 long, r2 long, m int, at int, print long")


def extended(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """(r1, r2, start, m, words): the windows of documents that hold a hit."""
    schema = pa.schema([("r1", pa.int64()), ("r2", pa.int64()), ("start", pa.int32()), ("m", pa.int32()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = Batches(schema)
            for r1, r2, text, found in zip(*b.columns, strict=True):
                words = letter_words(text.as_py())
                hit: dict[int, list[int]] = {}
                for x in found.as_py():
                    hit.setdefault(x["m"], []).append(x["at"])
                for m, places in hit.items():
                    reach = m - gram_size(m)
                    starts = {s for at in places for s in range(max(0, at - reach), min(at, len(words) - m) + 1)}
                    for s in sorted(starts):
                        full = out.add((r1.as_py(), r2.as_py(), s, m, b" ".join(words[s : s + m])), 120)
                        if full is not None:
                            yield full
            if (rest := out.flush()) is not None:
                yield rest

    per_row = hits.groupBy("r1", "r2").agg(F.collect_set(F.struct("m", "at")).alias("hits"))  # bounded by the document itself
    # Rows with hits grow with the documents: a sort-merge join at any size, whose sides can both spill.
    joined = _documents(docs).join(per_row.hint("merge"), ["r1", "r2"]).select("r1", "r2", "text", "hits")
    return joined.mapInArrow(run, "r1 long, r2 long, start int, m int, words binary")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = written(item_windows(items, window), "bench-windows")
    sizes = sorted(r["m"] for r in windows.select("m").distinct().collect())  # at most `window` numbers
    prints = written(windows.select("m", F.explode("prints").alias("print")).distinct(), "bench-prints")
    # The planner broadcasts the items' side only if its written size is under Spark's own limit.
    hits = written(fingerprints(docs, sizes).join(prints, ["m", "print"]).select("r1", "r2", "m", "at"), "bench-hits")
    # Documents meet each distinct window once, however many items hold it.
    known = windows.select("m", "words", "window").distinct()
    found = (
        extended(docs, hits)
        .join(known, ["m", "words"])
        .groupBy("r1", "r2")
        .agg(F.array_sort(F.collect_set(F.struct("start", "m"))).alias("spans"), F.array_sort(F.collect_set("window")).alias("set"))
    )
    found = written(found.withColumn("set_key", F.sha2(F.array_join("set", ","), 256)), "bench-found")
    # Items are looked up once for each distinct set of windows.
    of_set = (
        found.select("set_key", "set").dropDuplicates(["set_key"])
        .select("set_key", F.explode("set").alias("window"))
        .join(windows.select("window", "item").distinct(), "window")
        .groupBy("set_key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select("set_key", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    )
    of_set = written(of_set, "bench-sets")
    step = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["start"] + s["m"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), s["start"] + s["m"] - F.greatest(acc["end"], s["start"]))).alias("n"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    hit = found.select("r1", "r2", "set_key", F.aggregate("spans", zero, step)["n"].cast("long").alias("n_hit"))
    hit = written(hit.join(of_set, "set_key").drop("set_key"), "bench-rows")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return (
        word_counts(docs)
        .join(hit, ["r1", "r2"], "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"),
        )
        .select("*", ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
    )


def q_winnowing(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = rf"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w, least(13, len(w)) AS m FROM benchmark),
bw AS (SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS t
       FROM (SELECT item_id, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM b WHERE m > 0)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS t
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, ms)),
hit AS (SELECT doc_id, i, m, item_id FROM dw JOIN bw USING (m, t)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""
