"""URL filter: host and path rules, and a character model of accepted and rejected URLs.

The rules decide the URLs they fit. For the others, one smoothed
variable-order Markov model is fitted to URLs that the rules allow and one
to URLs that they block: a character's chance under the longest context
seen is mixed with that of each shorter one by how many different
characters followed it (Witten-Bell). The difference of the two
log-likelihoods per character goes through a logistic calibration, fitted
on URLs kept apart from the counts.

The models count all distinct URLs that rules decide, whole, and the
calibration is fitted on all of those kept apart: of each class every
APART-th in the order of a hash. Counts are grouped by context; a block of
URLs meets only the contexts that its URLs have, so no task and no driver
holds a model of everything. The calibration sums its Newton steps over
the table of differences.

Defined cases: a null URL or one without `://` has an empty host and path
and fits no rule; like any other it is judged by the method, a null URL as
an empty one. Without URLs of both classes to learn from, and where both
classes are equally likely, the method allows. Repeated rows are judged
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import table, written

ORDER = 4  # characters of the longest context
APART = 5  # one URL of a class in APART is for the calibration
BLOCK_CHARS = 1 << 20  # of URLs per block, about
COUNT_CHARS = 1 << 20  # of URLs whose counts are summed before they are shuffled
STEPS = 60  # of the calibration at most

#: Fixed values: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column, empty without `://`."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    part = lambda i: F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", i)
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(size, rule, verdict) of the longest rule that fits a host or its subdomains and a path's start; else null."""
    found = []
    for verdict, rule_host, rule_path in rules:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = rule_host + rule_path
        found.append(F.when(fits, F.struct(F.lit(len(name)).alias("size"), F.lit(name).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*found))


@dataclass
class Model:
    """Context -> (followers of the allowed class, of the blocked class); followers are (total, counts)."""

    contexts: dict[str, tuple[tuple[int, dict[str, int]], tuple[int, dict[str, int]]]]
    slope: float
    offset: float
    found: dict[str, float] = field(default_factory=dict)

    def ratio(self, gram: str) -> float:
        """Log of the chances' ratio of a gram's last character after the ones before it."""
        c, last, p = gram[-1], len(gram) - 1, [1 / 256, 1 / 256]
        for k in range(last + 1):
            entry = self.contexts.get(gram[last - k : last])
            if entry is None:
                break
            for j, (n, counts) in enumerate(entry):
                if n:
                    kinds = len(counts)
                    p[j] = (counts.get(c, 0) + kinds * p[j]) / (n + kinds)
        return math.log(p[0] / p[1])

    def difference(self, url: str) -> float:
        """Log-likelihood of the allowed less that of the blocked class, per character; the end counts as one."""
        text, total = url + "\n", 0.0
        for i in range(len(text)):
            gram = text[max(0, i - ORDER) : i + 1]
            x = self.found.get(gram)
            if x is None:
                x = self.found[gram] = self.ratio(gram)
            total += x
        return total / len(text)

    def allowed(self, url: str) -> float:
        """Calibrated chance that a URL is of the allowed class."""
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.slope * self.difference(url) + self.offset))))


def count_contexts(allowed: list[str], blocked: list[str]) -> dict:
    found: dict[str, tuple[dict[str, int], dict[str, int]]] = {}
    for j, urls in enumerate((allowed, blocked)):
        for url in urls:
            text = url + "\n"
            for i, c in enumerate(text):
                for k in range(min(i, ORDER) + 1):
                    counts = found.setdefault(text[i - k : i], ({}, {}))[j]
                    counts[c] = counts.get(c, 0) + 1
    return {s: tuple((sum(c.values()), c) for c in pair) for s, pair in found.items()}


def newton(sums: Callable[[float, float], tuple[float, ...]]) -> tuple[float, float]:
    """(slope, offset) of a ridge logistic fit; `sums` gives, at a slope and offset, the weighted sums of
    p(1-p)xx, p(1-p)x, p(1-p), (y-p)x and y-p."""
    beta = np.zeros(2)
    for _ in range(STEPS):
        xx, x1, one, gx, g1 = sums(*beta)
        step = np.linalg.solve(np.array([[xx, x1], [x1, one]]) + 1e-3 * np.eye(2), np.array([gx, g1]) - 1e-3 * beta)
        beta += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-11:
            break
    return float(beta[0]), float(beta[1])


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of a ridge logistic fit with classes of equal weight."""
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))

    def sums(slope: float, offset: float) -> tuple[float, ...]:
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        h, g = w * p * (1 - p), w * (y - p)
        return (h * x * x).sum(), (h * x).sum(), h.sum(), (g * x).sum(), g.sum()

    return newton(sums)


def logistic_of(rows: DataFrame) -> tuple[float, float]:
    """As `logistic`, over a table's columns difference and allow (1 or 0)."""
    x, y = F.col("difference"), F.col("allow")
    n, ones = rows.agg(F.count("*"), F.sum("allow")).first()
    w = F.when(y == 1, F.lit(0.5 / max(1, ones))).otherwise(F.lit(0.5 / max(1, n - ones)))

    def sums(slope: float, offset: float) -> tuple[float, ...]:
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(float(slope)) * x + F.lit(float(offset))))))
        each = rows.select(x.alias("x"), (w * p * (1 - p)).alias("h"), (w * (y - p)).alias("g"))
        return tuple(each.agg(F.sum(F.expr("h * x * x")), F.sum(F.expr("h * x")), F.sum("h"), F.sum(F.expr("g * x")), F.sum("g")).first())

    return newton(sums)


def learning_urls(urls: DataFrame, rules=RULES) -> DataFrame | None:
    """url, allow (1 or 0), counted and apart of all distinct URLs that rules decide, or None without both classes.

    Each class's URLs have their place in the order of a hash. Files hold
    one stretch of that order each; the driver reads one number for each.
    """
    host, path = host_and_path()
    ruled = urls.select("url", (fitting_rule(host, path, rules)["verdict"] == "allow").cast("int").alias("allow"))
    ruled = ruled.filter(F.col("allow").isNotNull()).distinct().orderBy(F.desc("allow"), F.xxhash64("url"), "url")
    rows = written(ruled.withColumn("id", F.monotonically_increasing_id()), "url-places").withColumn("part", F.shiftright("id", 33))
    sizes = {r["part"]: r for r in rows.groupBy("part").agg(F.count("*").alias("n"), F.sum("allow").alias("allowed")).collect()}
    n, allowed = (sum(r[k] for r in sizes.values()) for k in ("n", "allowed"))
    if not 0 < allowed < n:
        return None
    starts, at = [], 0
    for part in sorted(sizes):
        starts.append((part, at))
        at += sizes[part]["n"]
    first = urls.sparkSession.createDataFrame(starts, "part long, first long")
    place = F.col("first") + F.col("id") - F.shiftleft("part", 33) - F.when(F.col("allow") == 1, 0).otherwise(allowed)
    apart = place % APART == 0
    few = F.when(F.col("allow") == 1, F.lit(allowed < APART)).otherwise(F.lit(n - allowed < APART))
    return rows.join(F.broadcast(first), "part").select("url", "allow", (~apart | few).alias("counted"), apart.alias("apart"))


def context_table(urls: DataFrame) -> DataFrame:
    """context, followers (character, times in allowed and in blocked URLs) of all counted URLs (url, allow)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(own: tuple[list[str], list[str]]) -> pa.RecordBatch:
            rows = []
            for context, ((_, blocked), (_, allowed)) in count_contexts(*own).items():
                rows += [(context, c, allowed.get(c, 0), blocked.get(c, 0)) for c in allowed.keys() | blocked.keys()]
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["context", "c", "allowed", "blocked"])

        own, size = ([], []), 0
        for b in batches:
            for url, allow in zip(b.column(0), b.column(1), strict=True):
                own[allow.as_py()].append(url.as_py())
                size += len(own[allow.as_py()][-1]) + 1
                if size >= COUNT_CHARS:
                    yield counted(own)
                    own, size = ([], []), 0
        if size:
            yield counted(own)

    pairs = urls.select("url", "allow").mapInArrow(run, "context string, c string, allowed long, blocked long")
    pairs = pairs.groupBy("context", "c").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
    return pairs.groupBy("context").agg(F.collect_list(F.struct("c", "allowed", "blocked")).alias("followers"))


def differences(urls: DataFrame, contexts: DataFrame, n_chars: int) -> DataFrame:
    """The rows of `urls` (page_id, allow, url) with the difference of their log-likelihoods per character."""
    blocks = max(1, -(-n_chars // BLOCK_CHARS))
    dealt = urls.withColumn("block", F.pmod(F.xxhash64("page_id", "url"), F.lit(blocks)).cast("int")).repartition(blocks, "block")

    def distinct_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, context): the contexts of each block's URLs, once for each Arrow batch."""
        for b in batches:
            found: dict[int, set[str]] = {}
            for url, block in zip(b.column(0), b.column(1), strict=True):
                text, own = (url.as_py() or "") + "\n", found.setdefault(block.as_py(), set())
                for k in range(ORDER + 1):
                    own.update(text[i : i + k] for i in range(len(text) - k))
            for block, own in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(own), pa.int32()), pa.array([*own], pa.string())], ["block", "context"])

    def judged(rows: pa.Table, found: pa.Table) -> pa.Table:
        entries = {}
        for context, followers in zip(found.column("context"), found.column("followers"), strict=True):
            pairs = followers.as_py()
            sides = [{f["c"]: f[k] for f in pairs if f[k]} for k in ("allowed", "blocked")]
            entries[context.as_py()] = tuple((sum(s.values()), s) for s in sides)
        model = Model(entries, 1.0, 0.0)
        return rows.drop_columns(["block"]).append_column("difference", pa.array([model.difference(u.as_py() or "") for u in rows.column("url")], pa.float64()))

    own = dealt.select("url", "block").mapInArrow(distinct_contexts, "block int, context string").distinct()
    met = own.join(contexts, "context").select("block", "context", "followers")
    return dealt.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(judged, "page_id long, allow int, url string, difference double")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (the method's chance that the URL is of the allowed kind)."""
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = host_and_path()
    learned = learning_urls(urls, rules)
    if learned is None:
        scored = urls.select("page_id", host.alias("host"), path.alias("path"), F.lit(0.5).alias("score"))
    else:
        n_chars = urls.agg(F.sum(F.coalesce(F.length("url"), F.lit(0)).cast("long") + 1)).first()[0]
        # The URLs of the calibration go with the pages, so that contexts meet their blocks once.
        both = urls.withColumn("allow", F.lit(None).cast("int")).select("page_id", "allow", "url")
        both = both.unionByName(learned.filter("apart").select(F.lit(None).cast("long").alias("page_id"), "allow", "url"))
        contexts = written(context_table(learned.filter("counted")), "url-contexts")
        found = differences(both, contexts, n_chars).select("page_id", "allow", host.alias("host"), path.alias("path"), "difference")
        found = written(found, "url-differences")
        slope, offset = logistic_of(found.filter(F.col("allow").isNotNull()))
        x = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.lit(slope) * F.col("difference") + F.lit(offset)))
        scored = found.filter(F.col("allow").isNull()).select("page_id", "host", "path", (1 / (1 + F.exp(-x))).alias("score"))
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") >= 0.5, "allow").otherwise("block")
    return scored.withColumn("fit", rule).select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"), "score")


def q_url_markov(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"))
