import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import urls as U


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
    return re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def corpus(n=400, seed=13):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        kind = rnd.choice(["example.net", "example.com", "example.org", "Example.ORG", "net", "notexample.net"])
        host = rnd.choice(["", "www.", "BLOG."]) + rnd.choice(["", "spam-pills.", "news."]) + kind
        out.append((i, f"http{rnd.choice(['', 's'])}://{host}/{rnd.choice(['en', 'de', 'fr', 'es'])}/{rnd.randrange(900)}{rnd.choice(['', '?a=/de/', '#x', '/'])}"))
    return out


ODD = [(900, None), (901, ""), (902, "no scheme"), (903, "http://net"), (904, "http://net/"), (905, "a://B.NET/x?y://z"), (906, "x://"), (907, "://example.org/fr/é\nÉ"),
       (908, "http://É.net/a"), (None, "http://a.net/b"), (909, "http://h.org/" + "p" * 50_000), (1, "http://a.net/b"), (1, "http://a.net/b")]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], "page_id long, url string, host string, score int")
    return U.judge(df).collect()


def test_parts_and_rules_match_brute_force(spark):
    rows = corpus() + ODD
    got = run(spark, rows)
    assert len(got) == len(rows)
    want = sorted(((d, *split(u), *rule(*split(u))) for d, u in rows), key=str)
    have = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got), key=str)
    assert have == want
    assert all(r.verdict in ("allow", "block") and 0 <= r.score <= 1 for r in got)
    assert all(r.verdict == ("allow" if r.score >= 0.5 else "block") for r in got if not r.rule)
    assert any(not r.host for r in got)


def test_scores_match_a_plain_model(spark):
    """Counts, mixture, calibration and scores by plain code over the same URLs."""
    rows = corpus(260, 17) + ODD
    order = spark.createDataFrame([(u,) for _, u in rows if u is not None], "url string").distinct().orderBy(F.xxhash64("url"), "url")
    urls = [r.url for r in order.collect()]
    classes = {v: [u for u in urls if rule(*split(u))[1] == v] for v in ("allow", "block")}
    seen = {v: Counter() for v in classes}  # (context, next character) -> times
    for v, own in classes.items():
        for u in (u for i, u in enumerate(own) if i % U.APART):
            for i in range(len(u) + 1):
                for k in range(min(i, U.ORDER) + 1):
                    seen[v][(u + "\n")[i - k : i], (u + "\n")[i]] += 1
    followers = {v: {} for v in classes}
    for v in classes:
        for (context, c), n in seen[v].items():
            followers[v].setdefault(context, {})[c] = n

    def likelihood(v, url):
        total = 0.0
        for i, c in enumerate(url + "\n"):
            p = 1 / 256
            for k in range(min(i, U.ORDER) + 1):
                after = followers[v].get(url[i - k : i])
                if after:
                    p = (after.get(c, 0) + len(after) * p) / (sum(after.values()) + len(after))
            total += math.log(p)
        return total / (len(url) + 1)

    def difference(url):
        return likelihood("allow", url) - likelihood("block", url)

    apart = {v: own[:: U.APART] for v, own in classes.items()}
    x = np.array([difference(u) for v in ("allow", "block") for u in apart[v]])
    slope, offset = U.logistic(x, np.array([1] * len(apart["allow"]) + [0] * len(apart["block"])))
    for r, (d, u) in zip(sorted(run(spark, rows), key=lambda r: str(r.page_id)), sorted(rows, key=lambda r: str(r[0])), strict=True):
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, slope * difference(u or "") + offset)))), rel=1e-6), (d, u)


def test_logistic_finds_the_slope():
    rnd = np.random.default_rng(18)
    x = rnd.normal(size=4000)
    y = (rnd.random(4000) < 1 / (1 + np.exp(-(2 * x)))).astype(int)
    slope, offset = U.logistic(x, y)
    assert abs(slope - 2) < 0.25 and abs(offset) < 0.15


def test_the_method_tells_the_classes_apart(spark):
    got = run(spark, corpus(1500, 14))
    allow = [r.score for r in got if r.verdict == "allow" and r.rule]
    block = [r.score for r in got if r.verdict == "block" and r.rule]
    assert sum(s >= 0.5 for s in allow) / len(allow) > 0.9 and sum(s < 0.5 for s in block) / len(block) > 0.9


def test_chances_sum_to_one_over_the_alphabet():
    """The mixed estimate over all characters and contexts is a distribution (over 256 values)."""
    model = U.Model(U.count_contexts(["abcab", "abd"], ["zzz"]), 1, 0)
    for context in ("", "a", "ab", "cab", "q"):
        total = 0.0
        for c in map(chr, range(256)):
            p = 1 / 256
            for k in range(len(context) + 1):
                entry = model.contexts.get(context[len(context) - k :])
                if entry is None:
                    break
                n, counts = entry[0]
                if n:
                    p = (counts.get(c, 0) + len(counts) * p) / (n + len(counts))
            total += p
        assert abs(total - 1) < 1e-9


def test_without_classes_and_empty(spark):
    assert [r.verdict for r in run(spark, [(1, "http://a.com/x"), (2, None)])] == ["allow", "allow"]
    assert run(spark, []) == []


def test_every_decided_url_teaches(spark):
    """More than 5,000 URLs of a class are all counted or kept for the calibration."""
    rows = [(i, f"http://a{i}.net/x") for i in range(6000)] + [(10_000 + i, f"http://b{i}.org/fr/y") for i in range(6000)]
    urls = spark.createDataFrame(rows, "page_id long, url string")
    learned = U.learning_urls(urls)
    by = {(r.allow, r.counted, r.apart): r.n for r in learned.groupBy("allow", "counted", "apart").agg(F.count("*").alias("n")).collect()}
    assert by == {(k, c, not c): n for k in (0, 1) for c, n in ((True, 4800), (False, 1200))}
    first = U.context_table(learned.filter("counted")).filter("context = '/'").first()
    assert {f.c: (f.allowed, f.blocked) for f in first.followers if f.c in "xy"} == {"x": (0, 4800), "y": (4800, 0)}


def test_the_distributed_fit_is_the_plain_one(spark):
    rnd = np.random.default_rng(19)
    x = rnd.normal(size=500)
    y = (rnd.random(500) < 1 / (1 + np.exp(-x))).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y, strict=True)], "difference double, allow int")
    assert U.logistic_of(df) == pytest.approx(U.logistic(x, y), rel=1e-9)
