"""Embedding whitening by a bidiagonal qd solver.

Vectors are put on the grid x = floor(256 c) and whitened with the
principal components of the distinct grid vectors:

1. Blockwise QR: each task reduces its centred rows to one triangular R,
   a block of rows at a time; the tasks' R are merged in rounds of FAN
   until one is left. Rows are centred before anything is multiplied, and
   R'R is their scatter matrix without its ever being formed.
2. Householder reflections turn R into an upper bidiagonal B.
3. dqds, the shifted differential quotient-difference iteration, finds
   the squared singular values of B.
4. A twisted factorisation of B'B at each of the wanted values gives its
   eigenvector; close values are kept apart by inverse iteration against
   the vectors found before. The reflections lead back to components.

Steps 2 to 4 are on one matrix of dimension x dimension, whatever the
number of rows; sums over rows are exact integers.

Defined cases: a row whose vector is null or holds a null or non-finite
entry goes; its id may be null. Vectors of another length than most
different ones have (the larger length of equally many) go as well, as do
empty ones: no component fits them. A row given twice comes out twice and counts once in
the fit. A component without variance has explained 0 (null if nothing
varies) and whitened null, and is left out of identity_error; a deviation
beyond 63 bits is null. Entries beyond a long are its nearest end. An
empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import table, written

SCALE = 256  # grid steps to 1
COMPONENTS = 4
FAN = 16  # triangular factors merged by one task
BLOCK = 1024  # rows reduced at a time
EPS = float(np.finfo(float).eps)
TINY = 1e-290
CLOSE = 1e-3  # relative distance under which two values share a cluster


# --- rows --------------------------------------------------------------------------


def on_grid(rows: DataFrame) -> DataFrame:
    """vec_id and x, the grid vector as longs, of all rows whose vector is whole."""
    c = F.col("embedding").cast("array<double>")
    whole = F.forall(c, lambda v: F.coalesce(F.abs(v) < F.lit(math.inf), F.lit(False)))
    x = F.transform(c, lambda v: F.floor(v * SCALE).cast("long"))
    return rows.filter(F.size("embedding") > 0).filter(whole).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def most_common_length(fit: DataFrame) -> int:
    """Length that most fit vectors have, the larger of equally many; 0 without any."""
    found = fit.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return found["size"] if found else 0


def _grid(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """(rows, dimension) int64 of a batch's list column."""
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(batch.num_rows, -1)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


@dataclass
class Centre:
    """Number of fit vectors and their exact sum, per dimension."""

    n: int
    total: list[int]

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact: int64 where that holds it, else Python integers."""
        if self.n * _largest(x) + max(map(abs, self.total)) < 1 << 62:
            return x * self.n - np.array(self.total, np.int64)
        return x.astype(object) * self.n - np.array(self.total, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once."""
        return (self.offsets(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of (n*x - S)^2 of each row; None beyond a long."""
        d = self.offsets(x)
        if d.dtype != object and x.shape[1] * _largest(d) ** 2 < 1 << 63:
            return (d * d).sum(1).tolist()
        return [s if s < 1 << 63 else None for s in (sum(int(v) ** 2 for v in row) for row in d)]


def centre(fit: DataFrame) -> Centre | None:
    """Count and sums of the fit vectors, added up within each task first; None if there are none."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b in batches:
            x = _grid(b, 0)
            wide = x.astype(object) if _largest(x) * max(1, len(x)) >= 1 << 62 else x
            s = [int(v) for v in wide.sum(0)] if len(x) else None
            n += len(x)
            total = s if total is None else total if s is None else [a + v for a, v in zip(total, s, strict=True)]
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array([-1, *range(len(total))], pa.int32()), "value": [str(n), *map(str, total)]})

    parts = fit.select("x").mapInArrow(sums, "dim int, value string")
    rows = parts.groupBy("dim").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()  # dimension + 1 rows
    found = {r["dim"]: int(r["value"]) for r in rows}
    return Centre(found[-1], [found[i] for i in range(len(found) - 1)]) if found else None


# --- blockwise QR --------------------------------------------------------------------


def _triangle(r: np.ndarray | None, block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")


def triangular_factor(fit: DataFrame, c: Centre) -> np.ndarray:
    """R of the centred fit vectors; R'R is their scatter matrix."""
    d = len(c.total)
    schema = "node long, r binary"

    def packed(node: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": pa.array([node], pa.int64()), "r": pa.array([r.astype("<f8").tobytes()], pa.binary())})

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = None
        for b in batches:
            x = _grid(b, 0)
            for at in range(0, len(x), BLOCK):
                r = _triangle(r, c.centred(x[at : at + BLOCK]))
        if r is not None:
            yield packed(TaskContext.get().partitionId(), r)

    def merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for b in batches:
            for data in b.column("r"):
                r = _triangle(r, np.frombuffer(data.as_py(), "<f8").reshape(-1, d))
        yield packed(key[0].as_py(), r)

    level = written(fit.select("x").mapInArrow(reduced, schema), "whitening-r")
    while (n := level.count()) > 1:  # nodes that are neighbours merge
        groups = level.withColumn("node", F.floor(F.col("node") / FAN).cast("long")).groupBy("node")
        level = written(groups.applyInArrow(merged, schema), "whitening-r", rows=n, per_file=FAN)
    return np.frombuffer(level.first()["r"], "<f8").reshape(-1, d)


# --- the bidiagonal problem -------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal and right reflections of a Householder bidiagonalisation of a square matrix."""
    a = np.array(r, float)
    n = len(a)
    right = []

    def reflection(v: np.ndarray) -> np.ndarray | None:
        """Unit w so that (I - 2ww') v is a multiple of the first axis; None if it is already."""
        if not np.any(v[1:]):
            return None
        w = v / np.abs(v).max()
        w[0] += math.copysign(np.linalg.norm(w), w[0])
        return w / np.linalg.norm(w)

    for k in range(n):
        w = reflection(a[k:, k])
        if w is not None:
            a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        w = reflection(a[k, k + 1 :]) if k + 1 < n else None
        if w is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
        right.append(w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _qd_pass(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform by `shift`; None if the shift was beyond the smallest value. Also the smallest d met."""
    d = q[0] - shift
    least, new_q, new_e = d, [], []
    for i in range(len(e)):
        if d < 0:
            return None
        top = d + e[i]
        if top == 0.0:
            new_q.append(0.0)
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / top
            new_q.append(top)
            new_e.append(e[i] * ratio)
            d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    return [*new_q, d], new_e, least


def dqds(q: list[float], e: list[float]) -> list[float]:
    """All squared singular values of the bidiagonal with squared entries q and e, falling."""
    open_parts, values = [(list(q), list(e), 0.0)], []
    while open_parts:
        q, e, shifted = open_parts.pop()
        if q[0] < q[-1]:  # large entries first: the smallest value is found at the end
            q, e = q[::-1], e[::-1]
        guess = 0.0
        while e:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (shifted + min(q[i], q[i + 1])) or e[i] < TINY), None)
            if cut is not None:
                open_parts.append((q[cut + 1 :], e[cut + 1 :], shifted))
                q, e, guess = q[: cut + 1], e[:cut], 0.0
                continue
            done = _qd_pass(q, e, guess)
            for smaller in (guess / 4, guess / 64, 0.0):  # without a shift a pass never fails
                if done is None:
                    guess = smaller
                    done = _qd_pass(q, e, guess)
            q, e, least = done
            shifted += guess
            near = q[-1] - math.sqrt(q[-1] * e[-1])
            guess = min(least, near) if near > 0 else least / 4
        values.append(q[0] + shifted)
    return sorted(values, reverse=True)


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Twisted factorisations of B'B - value: multipliers from above and below, and the pivot of each twist."""
    n = len(a)
    q, e, off = a * a, b * b, a[: n - 1] * b
    floor = TINY + EPS * EPS * (q.max() + (e.max() if n > 1 else 0.0))
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(n - 1), np.empty(n - 1)
    s[0], p[n - 1] = -value, q[n - 1] - value
    for i in range(n - 1):
        pivot = s[i] + q[i]
        pivot = pivot if abs(pivot) > floor else math.copysign(floor, pivot)
        down[i] = off[i] / pivot
        s[i + 1] = e[i] / pivot * s[i] - value
    for i in range(n - 2, -1, -1):
        pivot = e[i] + p[i + 1]
        pivot = pivot if abs(pivot) > floor else math.copysign(floor, pivot)
        up[i] = off[i] / pivot
        p[i] = p[i + 1] * (q[i] / pivot) - value
    return down, up, s + p + value


def _null_vector(down: np.ndarray, up: np.ndarray, twist: int) -> np.ndarray:
    z = np.zeros(len(down) + 1)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, len(up)):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def bidiagonal_vectors(a: np.ndarray, b: np.ndarray, most: int) -> list[tuple[float, np.ndarray]]:
    """The `most` largest eigenvalues of B'B with orthonormal eigenvectors.

    B falls into blocks where its superdiagonal vanishes; each block has
    values and vectors of its own.
    """
    n = len(a)
    scale = max(np.abs(a).max(), np.abs(b).max() if n > 1 else 0.0)
    if scale == 0.0:
        return [(0.0, v) for v in np.eye(n)[:most]]
    a, b = a / scale, b / scale
    cuts = [0, *[i + 1 for i in range(n - 1) if abs(b[i]) <= EPS * EPS + EPS / 8 * min(abs(a[i]), abs(a[i + 1]))], n]
    found = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        found += [(v, lo, hi) for v in dqds((a[lo:hi] ** 2).tolist(), (b[lo : hi - 1] ** 2).tolist())]
    found.sort(key=lambda f: -f[0])
    out = []
    for value, lo, hi in found[:most]:
        down, up, pivots = _twisted(a[lo:hi], b[lo : hi - 1], value)
        kin = [z[lo:hi] for v, z, at in out if at == lo and abs(v - value) <= CLOSE * value + EPS]
        best = None
        for twist in np.argsort(np.abs(pivots))[: 1 + 4 * len(kin)]:
            z = _null_vector(down, up, int(twist))
            for _ in range(2):
                for k in kin:
                    z = z - k * (k @ z)
            size = np.linalg.norm(z)
            if best is None or size > best[0]:
                best = size, z / size if size else z
            if size > 0.5:
                break
        z = best[1]
        if kin:
            z = _kept_apart(a[lo:hi], b[lo : hi - 1], value, z, kin)
        whole = np.zeros(n)
        whole[lo:hi] = z
        out.append((value, whole, lo))
    return [(v * scale * scale, z) for v, z, _ in out]


def _kept_apart(a: np.ndarray, b: np.ndarray, value: float, z: np.ndarray, kin: list[np.ndarray]) -> np.ndarray:
    """Inverse iteration on B'B - value, orthogonal to the vectors of its cluster."""
    n = len(a)
    t = np.diag(a * a + np.append(0.0, b * b)) + np.diag(a[: n - 1] * b, 1) + np.diag(a[: n - 1] * b, -1)
    away = EPS
    for _ in range(4):
        try:
            z = np.linalg.solve(t - value * (1 + away) * np.eye(n), z)
        except np.linalg.LinAlgError:  # met the value exactly
            away *= 4
            continue
        for _ in range(2):
            for k in kin:
                z = z - k * (k @ z)
        z /= np.linalg.norm(z)
    return z


@dataclass
class Model:
    """Components (unit rows) with their variances, and all variance there is."""

    centre: Centre
    directions: np.ndarray
    variances: list[float]
    trace: float


def solve(r: np.ndarray, c: Centre, components: int = COMPONENTS) -> Model:
    """Principal components of the fit vectors from their triangular factor."""
    d = len(c.total)
    square = np.zeros((d, d))
    square[: len(r)] = r[:d]
    a, b, right = bidiagonal(square)
    directions, variances = [], []
    for value, z in bidiagonal_vectors(a, b, min(components, d)):
        for k in range(d - 1, -1, -1):
            w = right[k]
            if w is not None:
                z[k + 1 :] -= 2 * w * (w @ z[k + 1 :])
        # Of the two signs the one with a positive largest entry, whatever order the rows were reduced in.
        directions.append(z / math.copysign(np.linalg.norm(z), z[np.argmax(np.abs(z))]))
        variances.append(value / c.n)
    return Model(c, np.array(directions), variances, float((square * square).sum()) / c.n)


def _null_variances(m: Model) -> list[bool]:
    """Components whose variance is no more than rounding."""
    return [v <= m.trace * len(m.centre.total) ** 2 * EPS * EPS or v <= 0 for v in m.variances]


def whitened(m: Model, x: np.ndarray) -> np.ndarray:
    """Whitened coordinates of grid vectors; NaN where a component has no variance."""
    scale = np.array([math.nan if none else math.sqrt(v) for v, none in zip(m.variances, _null_variances(m), strict=True)])
    return m.centre.centred(x) @ m.directions.T / scale


def identity_error(fit: DataFrame, m: Model) -> float:
    """Largest entry of the whitened fit vectors' covariance minus the identity."""
    keep = [i for i, none in enumerate(_null_variances(m)) if not none]
    if not keep:
        return 0.0
    k = len(keep)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = whitened(m, _grid(b, 0))[:, keep]
            first += w.sum(0)
            second += w.T @ w
        values = [*first, *second.ravel()]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(values)), pa.int32()), "value": pa.array(values, pa.float64())})

    sums = {r["i"]: r["value"] for r in fit.select("x").mapInArrow(moments, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()}
    mean = np.array([sums[i] for i in range(k)]) / m.centre.n
    cov = np.array([sums[k + i] for i in range(k * k)]).reshape(k, k) / m.centre.n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(k)).max())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component, the first `components` of them."""
    placed = on_grid(rows)
    fit = written(placed.select("x").distinct(), "whitening-fit")
    one_length = F.size("x") == most_common_length(fit)
    placed, fit = placed.filter(one_length), fit.filter(one_length)
    c = centre(fit)
    if c is None:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    m = solve(triangular_factor(fit, c), c, components)
    error = identity_error(fit, m)
    k = len(m.variances)
    explained = [v / m.trace if m.trace > 0 else None for v in (0.0 if none else v for v, none in zip(m.variances, _null_variances(m), strict=True))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                x = _grid(part, 1)
                w = whitened(m, x).ravel()
                rows = len(x)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    "n": pa.array(np.full(rows * k, m.centre.n, np.int64)),
                    "deviation": pa.array([v for v in m.centre.deviations(x) for _ in range(k)], pa.int64()),
                    "whitened": pa.array(w, mask=np.isnan(w)),
                    "explained": pa.array(explained * rows, pa.float64()),
                    "identity_error": pa.array(np.full(rows * k, error)),
                })

    return placed.mapInArrow(run, SCHEMA)


def q_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
