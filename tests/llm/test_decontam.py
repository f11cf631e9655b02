import hashlib
import random
import re

import numpy as np

from fleetpulse.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window=13):
    wins = {}
    for i, t in items:
        w = words(t)
        m = min(window, len(w))
        for a in range(len(w) - m + 1) if m else ():
            wins.setdefault(tuple(w[a : a + m]), set()).add("" if i is None else str(i))
    sizes = {len(k) for k in wins}
    out = []
    for d, t in docs:
        w = words(t)
        hit, ids = set(), set()
        for m in sizes:
            for a in range(len(w) - m + 1):
                if tuple(w[a : a + m]) in wins:
                    hit |= set(range(a, a + m))
                    ids |= wins[tuple(w[a : a + m])]
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, row string, n_words int")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, words string")
    return sorted((tuple(r) for r in D.contamination(d, b, **kw).collect()), key=str)


def test_matches_brute_force(spark):
    rnd = random.Random(5)
    vocab = ["a", "b", "C", "Éa", "x9", "the"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 3, 5, 12, 13, 14, 30])))) for i in range(12)] + [(3, "a b"), (None, "the the x9 b"), (50, None)]
    docs = [(i, ", ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 2, 12, 40])))) for i in range(30)]
    long_items = [t for _, t in items if t and len(t.split()) >= 13]
    docs += [(100 + i, " ".join(rnd.choice(vocab) + "q" for _ in range(rnd.choice([0, 5, 300]))) + " " + t.upper() + " zz") for i, t in enumerate(long_items)]
    docs += [(None, None), (100, docs[-1][1]), (100, docs[-1][1]), (7, "")]
    assert run(spark, docs, items) == brute(docs, items)


def test_long_items_only(spark):
    rnd = random.Random(6)
    items = [(i, " ".join(f"w{rnd.randrange(500)}" for _ in range(40))) for i in range(10)]
    docs = []
    for i in range(40):
        w = [f"w{rnd.randrange(500)}" for _ in range(rnd.randrange(200))]
        src = rnd.choice(items)[1].split()
        a, n = rnd.randrange(20), rnd.randrange(10, 20)
        w[5:5] = src[a : a + n]
        docs.append((i, " ".join(w)))
    assert run(spark, docs, items) == brute(docs, items)


def test_a_passage_of_many_items_in_many_documents(spark):
    """Documents with the same windows look their items up as one set."""
    shared = " ".join(f"s{i}" for i in range(20))
    items = [(i, f"{shared} own{i}") for i in range(40)] + [(99, "short one")]
    docs = [(i, f"lead {shared} own{i % 3} tail") for i in range(60)] + [(100 + i, shared + " short one" * (i % 2)) for i in range(6)]
    got = run(spark, docs, items)
    assert got == brute(docs, items) and max(r[3] for r in got) == 41


def test_every_shared_span_shares_a_kept_print():
    rnd = np.random.default_rng(7)
    for m in range(1, 16):
        for _ in range(30):
            span = rnd.integers(0, 4, m).astype(np.uint64)
            a = np.concatenate([rnd.integers(0, 4, 20).astype(np.uint64), span, rnd.integers(0, 4, 9).astype(np.uint64)])
            inside = set(D.winnow(span, m)[1].tolist())
            at, prints = D.winnow(a, m)
            k = D.gram_size(m)
            assert any(20 <= p <= 20 + m - k and h in inside for p, h in zip(at.tolist(), prints.tolist(), strict=True))


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == brute([(1, "a b")], [])
