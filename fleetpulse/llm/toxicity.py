"""Toxicity by cumulative-link ordinal regression.

Grades are 0 (not toxic), 1 (toxic) and 2 (severely toxic), and
`P(grade <= j) = sigmoid(theta_j - w . x)` with ordered thresholds and one
weight vector for all of them. A feature is the log count of a word or of
a word's beginning (4 or 5 bytes, which stand for its inflected forms).
The labels say toxic or not, so the grade of a toxic training text
is set from how many markers it holds: 2 above the median of the toxic
sample, else 1. Markers are features that are rare among the texts
labelled 0.

Labels come only from rows whose crc32(doc_id as text) mod 3 is not 1.
Fitting uses at most FIT_DOCS texts per class, picked by a hash of the
doc_id, and FEATURES features, picked by their log odds between the classes.
Every text is scored whole.

Defined cases: a null text is an empty one. Of several labels for one
doc_id the larger counts; null labels and ids teach nothing. If a class
has no usable label, every score is the share of label 1 (0 without any
label) and the severity equals it. Repeated rows score alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import letter_words, table, text_column, written
from fleetpulse.llm.quality import fold, labelled_sample

FIT_DOCS = 2000
FEATURES = 512
STEMS = (4, 5)  # bytes of a word's beginning that are features beside the word
LEAST_DOCS = 3  # texts of the sample that hold a feature, at least
LEAST_Z = 2.5  # of a feature's log odds
MARKER_SHARE = 0.01  # of the texts labelled 0 that hold a marker word, at most
RIDGE = 1e-5
STEPS = 800


@dataclass
class Model:
    index: dict[bytes, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def __post_init__(self):
        """The index by kind of feature: whole words, and beginnings by their length."""
        self.words = {f: i for f, i in self.index.items() if not f.endswith(b"*")}
        self.stems = [(k, {f[:-1]: i for f, i in self.index.items() if f.endswith(b"*") and len(f) == k + 1}) for k in STEMS]

    def grades(self, words: list[bytes]) -> np.ndarray:
        """Probability of each grade for a text's words."""
        counts = Counter(i for i in map(self.words.get, words) if i is not None)
        for k, stems in self.stems:
            get = stems.get
            counts.update(i for w in words if len(w) > k and (i := get(w[:k])) is not None)
        z = sum(self.weights[i] * math.log1p(c) for i, c in counts.items())
        below = 1 / (1 + np.exp(-np.clip(self.thresholds - z, -40, 40)))
        return np.diff(np.concatenate([[0.0], below, [1.0]]))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, weight: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the ridge cumulative-link fit to a sparse matrix, by Adam on the whole sample."""
    n, top = len(grades), 2
    share = np.cumsum([weight[grades == g].sum() for g in range(top)]) / weight.sum()
    start = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    # The second threshold lies above the first by exp(gap).
    par = np.concatenate([np.zeros(n_features), [start[0], math.log(max(1e-2, start[1] - start[0]))]])
    m, v = np.zeros_like(par), np.zeros_like(par)
    w = weight / weight.sum()
    sig = lambda t: 1 / (1 + np.exp(-np.clip(t, -40, 40)))
    for step in range(1, STEPS + 1):
        theta = np.array([par[-2], par[-2] + math.exp(par[-1])])
        z = np.bincount(rows, values * par[cols], n)
        edges = np.concatenate([np.zeros((n, 1)), sig(theta[None, :] - z[:, None]), np.ones((n, 1))], axis=1)
        slopes = edges * (1 - edges)
        at = np.arange(n)
        p = np.maximum(edges[at, grades + 1] - edges[at, grades], 1e-12)
        up, low = slopes[at, grades + 1] / p, slopes[at, grades] / p
        dz = w * (up - low)  # of the loss -log p
        d_theta = np.array([(w * (low * (grades == j + 1) - up * (grades == j))).sum() for j in range(top)])
        grad = np.concatenate([np.bincount(cols, values * dz[rows], n_features) + RIDGE * par[:-2], [d_theta.sum(), d_theta[1] * math.exp(par[-1])]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        par = par - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return par[:-2], np.array([par[-2], par[-2] + math.exp(par[-1])])


def features(words: list[bytes]) -> Counter:
    """Counts of a text's features; a beginning ends with `*`, which no word holds."""
    out = Counter(words)
    for k in STEMS:
        out.update(w[:k] + b"*" for w in words if len(w) > k)
    return out


def _counts(sample: DataFrame) -> DataFrame:
    """(doc_id, label, word, n) of a labelled sample; `word` is a feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, label, text in zip(*b.columns, strict=True):
                c = features(letter_words(text.as_py()))
                if c:
                    k = len(c)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc.as_py()] * k, pa.int64()), pa.array([label.as_py()] * k, pa.int32()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int32())],
                        ["doc_id", "label", "word", "n"],
                    )

    return sample.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, word binary, n int")


def fit(docs: DataFrame, labels: DataFrame) -> Model | float:
    """The model, or a constant score where a class has no label."""
    usable = labels.filter(fold() != 1).groupBy(F.col("toxic").alias("label")).agg(F.count("*").alias("n")).collect()
    known = {r["label"]: r["n"] for r in usable if r["label"] in (0, 1)}
    share = known.get(1, 0) / max(1, sum(known.values()))
    sample = labelled_sample(docs, labels, "toxic", FIT_DOCS)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.countDistinct("doc_id").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return float(share)
    counts = written(_counts(sample), "toxic-counts")
    held = counts.groupBy("word").agg(F.countDistinct(F.when(F.col("label") == 1, F.col("doc_id"))).alias("n1"), F.countDistinct(F.when(F.col("label") == 0, F.col("doc_id"))).alias("n0"))
    held = held.filter(F.col("n0") + F.col("n1") >= LEAST_DOCS)
    odds = lambda n, k: F.log((F.col(n) + 0.5) / (F.lit(k) - F.col(n) + 0.5))
    spread = F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    held = held.withColumn("z", (odds("n1", sizes[1]) - odds("n0", sizes[0])) / spread).filter(F.abs("z") >= LEAST_Z)
    chosen = held.orderBy(F.abs("z").desc(), "word").limit(FEATURES).collect()
    index = {bytes(r["word"]): i for i, r in enumerate(chosen)}
    if not index:
        return float(share)
    markers = {i for i, r in enumerate(chosen) if r["z"] > 0 and r["n0"] <= MARKER_SHARE * sizes[0]}
    spark = docs.sparkSession
    # At most FEATURES rows.
    words = F.broadcast(spark.createDataFrame([(bytearray(w), i) for w, i in index.items()], "word binary, feature int"))
    got = counts.join(words, "word").groupBy("doc_id", "label", "feature").agg(F.max("n").alias("n")).orderBy("doc_id", "feature").collect()
    # Every sampled text is a row; those without a feature have only thresholds.
    ids = [(r["doc_id"], r["label"]) for r in sample.select("doc_id", "label").distinct().orderBy("doc_id").collect()]
    row = {d: i for i, (d, _) in enumerate(ids)}
    y = np.array([label for _, label in ids])
    rows, cols, n = (np.array(x) for x in zip(*((row[r["doc_id"]], r["feature"], r["n"]) for r in got), strict=True))
    marked = np.bincount(rows, n * np.isin(cols, list(markers)), len(ids))
    grades = np.where(y == 0, 0, np.where(marked > np.median(marked[y == 1]), 2, 1))
    weight = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum())
    return Model(index, *fit_ordinal(rows, cols, np.log1p(n), grades, weight, len(index)))


def grade(docs: DataFrame, model: Model | float) -> DataFrame:
    """doc_id, severity (the expected grade), grade (the likeliest) and score (the chance of a grade above 0) of every row."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    if not isinstance(model, Model):
        s = F.lit(float(model))
        return base.select("doc_id", s.alias("severity"), (s >= 0.5).cast("int").alias("grade"), s.alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.array([model.grades(letter_words(t.as_py())) for t in b.column(1)], float).reshape(-1, 3)
            severity, likeliest = p @ np.arange(3), p.argmax(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(severity), pa.array(likeliest), pa.array(1 - p[:, 0])], ["doc_id", "severity", "grade", "score"])

    return base.mapInArrow(run, "doc_id long, severity double, grade int, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, severity, grade, score, predicted (1: toxic)."""
    return grade(docs, fit(docs, labels)).select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "severity", "grade", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def q_toxicity(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
