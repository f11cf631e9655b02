import random
import zlib

import numpy as np
import pytest

from fleetpulse.llm import toxicity as T

SCHEMA = "doc_id long, text string, score string, label int"


def corpus(n=500, seed=11):
    rnd = random.Random(seed)
    plain = [f"w{i}" for i in range(400)]
    rude = ["oaf", "knave", "cad"]
    docs, labels = [], []
    for i in range(n):
        bad = rnd.random() < 0.2
        w = [rnd.choice(plain) for _ in range(rnd.randrange(5, 150))]
        for _ in range(rnd.randrange(1, 6) if bad else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(rude).title() + ",")
        docs.append((i, " ".join(w), "x", 3))
        if rnd.random() < 0.8:
            labels.append((i, int(bad), "z"))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_held_out_accuracy_and_order(spark):
    docs, labels = corpus()
    got = {r.doc_id: r for r in T.classify(*frames(spark, docs, labels)).collect()}
    held = [(got[d], q) for d, q, _ in labels if zlib.crc32(str(d).encode()) % 3 == 1]
    assert len(got) == len(docs) and len(held) > 50 and all(r.held_out for r, _ in held)
    assert sum(r.predicted == q for r, q in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and 0 <= r.severity <= 2 and r.severity >= r.score - 1e-9 for r in got.values())
    rude = lambda t: sum(t.lower().count(x) for x in ("oaf", "knave", "cad"))
    by = {}
    for d, t, *_ in docs:
        by.setdefault(min(rude(t), 5), []).append(got[d].severity)
    means = [np.mean(by[k]) for k in sorted(by)]
    assert means == sorted(means)


def test_thresholds_are_ordered_and_the_fit_recovers_a_direction():
    rng = np.random.default_rng(12)
    n = 3000
    x = rng.normal(size=(n, 2))
    z = 2 * x[:, 0] - x[:, 1] + rng.logistic(size=n)
    y = np.digitize(z, [0.5, 2.0])
    rows, cols = np.repeat(np.arange(n), 2), np.tile([0, 1], n)
    w, theta = T.fit_ordinal(rows, cols, x.ravel(), y, np.ones(n), 2)
    assert w == pytest.approx([2, -1], abs=0.3) and theta == pytest.approx([0.5, 2.0], abs=0.3)


def test_inflected_forms_are_caught(spark):
    """Markers that never occur in the same form twice share their beginning."""
    rnd = random.Random(13)
    plain = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        w = [rnd.choice(plain) for _ in range(30)]
        for k in range(2 if bad else 0):
            w.insert(rnd.randrange(30), f"knave{i}x{k}")
        docs.append((i, " ".join(w), "x", 1))
        labels.append((i, int(bad), "z"))
    got = {r.doc_id: r for r in T.classify(*frames(spark, docs, labels)).collect()}
    held = [(got[d], q) for d, q, _ in labels if got[d].held_out]
    assert sum(r.predicted == q for r, q in held) / len(held) > 0.97


def test_model_counts_as_the_fit_does():
    words = [b"knavery", b"knave", b"oaf", b"knavish", b"oaf", b"abcdef"]
    index = {b"knave": 0, b"oaf": 1, b"knav*": 2, b"knave*": 3}
    model = T.Model(index, np.array([0.5, 1.0, 2.0, 4.0]), np.array([0.0, 1.0]))
    c = T.features(words)
    z = sum(w * np.log1p(c[f]) for f, w in zip(index, [0.5, 1.0, 2.0, 4.0], strict=True))
    assert model.grades(words)[0] == pytest.approx(1 / (1 + np.exp(z)))


def test_odd_rows(spark):
    docs, labels = corpus(200)
    docs += [(None, None, None, None), (500, "", "x", 1), (501, None, "x", 1), (1, docs[1][1], "x", 1), (502, "oaf " * 60_000, "x", 1)]
    labels += [(None, 1, "x"), (3, None, "x"), (9999, 1, "x"), labels[0]]
    got = T.classify(*frames(spark, docs, labels)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(docs) and by[500].score == by[501].score == by[None].score < 0.5 and by[502].predicted == 1


@pytest.mark.parametrize("labels,want", [([], 0.0), ([(d, 1, "x") for d in range(6)], 1.0)])
def test_without_a_class(spark, labels, want):
    d, lab = frames(spark, [(1, "a", "x", 1), (2, None, "x", 1)], labels)
    assert [r.score for r in T.classify(d, lab).collect()] == [want, want]
    assert T.classify(d.limit(0), lab).collect() == []
