"""Quality classifier by compression with class dictionaries.

A zstandard dictionary is trained from good and one from bad labelled
texts. A whole text is compressed with either; the normalised difference
of the two sizes, with the size per byte and the length, goes through a
logistic calibration fitted on labelled texts that trained no dictionary.

Labels come only from rows whose crc32(doc_id as text) mod 3 is not 1.
Fitting uses a bounded sample of them, picked by a hash of the doc_id:
DICT_DOCS texts per class for the dictionaries, and FIT_DOCS whole texts per class for the calibration.
Dictionaries learn from pieces of EXCERPT bytes from all over their texts,
at most DICT_PIECES per class, picked by a hash. Every text is scored whole.

Defined cases: a null text is scored as an empty one. Of several labels
for one doc_id the larger counts; null labels and null ids teach nothing.
If a class has no usable label, every score is the share of label 1 among
the labels (0.5 without any). Repeated rows score alike; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import table, text_column

DICT_DOCS = 600
EXCERPT = 4096
DICT_PIECES = 2048
DICT_BYTES = 32 * 1024
FIT_DOCS = 1500
LEVEL = 3
RIDGE = 1e-4


def fold(column: str = "doc_id"):
    """crc32 of the id's text, mod 3; rows with 1 are held out."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3


def dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; the raw text itself where the samples are too few to train one."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Sizer:
    """Compression features of a text."""

    def __init__(self, good: bytes, bad: bytes, level: int = LEVEL):
        self.by = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=level)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, write_dict_id=False, write_content_size=False))

    def __call__(self, data: bytes) -> tuple[float, float, float]:
        good, bad = (len(c.compress(data)) for c in self.by)
        return (bad - good) / (bad + good), (bad + good) / 2 / (len(data) + 20), math.log1p(len(data))


@dataclass
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(_terms(z) @ self.weights, -30, 30)))


def _terms(z: np.ndarray) -> np.ndarray:
    d, r, n = z.T
    return np.stack([np.ones(len(z)), d, r, n, d * d, r * r, n * n, d * r, d * n, r * n], axis=1)


def calibrate(features: np.ndarray, labels: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, weights) of a ridge logistic fit in which label 1 has the weight `share`."""
    mean, scale = features.mean(0), np.maximum(features.std(0), 1e-9)
    x = _terms(np.clip((features - mean) / scale, -8, 8))
    w = np.where(labels == 1, share / max(1, (labels == 1).sum()), (1 - share) / max(1, (labels == 0).sum()))
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (labels - p)) - RIDGE * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return mean, scale, beta


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label, rank, text) of at most `per_class` training rows per class, picked by a hash of the id."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = usable.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold() != 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64("doc_id")
    picked = None
    for k in (0, 1):
        some = usable.filter(F.col("label") == k).orderBy(order, "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    # At most 2 * per_class ids: the limit bounds what is broadcast.
    return base.join(F.broadcast(picked.withColumn("rank", F.xxhash64("doc_id"))), "doc_id")


def fit(docs: DataFrame, labels: DataFrame) -> Model | float:
    """The model, or a constant score where a class has no label."""
    rows = labelled_sample(docs, labels, "quality", DICT_DOCS + FIT_DOCS)
    counts = {r["label"]: r["n"] for r in labels.filter(fold() != 1).groupBy(F.col("quality").alias("label")).agg(F.count("*").alias("n")).collect() if r["label"] in (0, 1)}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    # The samples' ids in hash order: the first DICT_DOCS of a class train its dictionary.
    ids = rows.select("doc_id", "label", "rank").distinct().collect()
    first = {0: [], 1: []}
    for r in sorted(ids, key=lambda r: (r["rank"], r["doc_id"])):
        first[r["label"]].append(r["doc_id"])
    if not first[0] or not first[1]:
        return share if counts else 0.5
    n_dict = {k: max(1, min(DICT_DOCS, len(v) // 2)) for k, v in first.items()}
    dict_ids = [d for k, v in first.items() for d in v[: n_dict[k]]]
    spark = docs.sparkSession
    chosen = F.broadcast(spark.createDataFrame([(d,) for d in dict_ids], "doc_id long"))
    data = F.encode("text", "UTF-8")
    last = F.greatest(F.floor((F.octet_length("text") - 1) / EXCERPT), F.lit(0)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(data, k * EXCERPT + 1, F.lit(EXCERPT)))
    cut = rows.join(chosen, "doc_id").select("doc_id", "label", F.posexplode(pieces).alias("k", "data"))
    samples: dict[int, list[bytes]] = {}
    for k in (0, 1):
        some = cut.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id", "k", "data"), "doc_id", "k", "data").limit(DICT_PIECES)
        samples[k] = [bytes(r["data"]) for r in some.orderBy("doc_id", "k", "data").collect()]
    good, bad = dictionary(samples[1]), dictionary(samples[0])
    rest = rows.join(chosen, "doc_id", "left_anti") if len(dict_ids) < len(ids) else rows
    got = _features(rest.select("doc_id", "label", "text"), good, bad).orderBy("doc_id", "d", "r", "n").collect()
    x, y = np.array([(g["d"], g["r"], g["n"]) for g in got]), np.array([g["label"] for g in got])
    return Model(good, bad, *calibrate(x, y, share))


def _features(rows: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = Sizer(good, bad)
        for b in batches:
            x = np.array([size(t.as_py().encode("utf-8", "surrogatepass")) for t in b.column(2)], float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x[:, i].copy()) for i in range(3))], ["doc_id", "label", "d", "r", "n"])

    return rows.mapInArrow(run, "doc_id long, label int, d double, r double, n double")


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """doc_id and score of every row."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    if not isinstance(model, Model):
        return base.select("doc_id", F.lit(float(model)).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = Sizer(model.good, model.bad)
        for b in batches:
            x = np.array([size(t.as_py().encode("utf-8", "surrogatepass")) for t in b.column(1)], float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.probability(x))], ["doc_id", "score"])

    return base.mapInArrow(run, "doc_id long, score double")


def good_rows(docs: DataFrame, model: Model | float, least: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose text scores `least` or more; no row is shuffled."""
    if not isinstance(model, Model):
        return docs.filter(F.lit(float(model) >= least))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = Sizer(model.good, model.bad)
        for b in batches:
            x = np.array([size((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in b.column(at)], float).reshape(-1, 3)
            yield b.filter(pa.array(model.probability(x) >= least))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def q_quality(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
