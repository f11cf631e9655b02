import random
import zlib

import pytest

from fleetpulse.llm import quality as Q

SCHEMA = "doc_id long, text string, score string, label int"


def corpus(n=400, seed=8):
    rnd = random.Random(seed)
    syll = ["an", "the", "ro", "mi", "ta", "lo", "ne", "ki", "su"]
    word = lambda: "".join(rnd.choice(syll) for _ in range(rnd.randrange(1, 5)))
    docs, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        w = [word() for _ in range(rnd.randrange(5, 120))]
        t = " ".join(w) if good else "!! ".join(w).upper() if rnd.random() < 0.5 else " | ".join(w)
        docs.append((i, t, "x", 3))
        if rnd.random() < 0.8:
            labels.append((i, int(good), "z"))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, text string")


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    got = {r.doc_id: r for r in Q.classify(*frames(spark, docs, labels)).collect()}
    held = [(got[d], q) for d, q, _ in labels if zlib.crc32(str(d).encode()) % 3 == 1]
    assert len(got) == len(docs) and len(held) > 50
    assert all(r.held_out for r, _ in held)
    assert sum(r.predicted == q for r, q in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels = corpus(200)
    flipped = [(d, 1 - q if zlib.crc32(str(d).encode()) % 3 == 1 else q, x) for d, q, x in labels]
    a, b = (sorted((r.doc_id, r.score) for r in Q.classify(*frames(spark, docs, x)).collect()) for x in (labels, flipped))
    assert [d for d, _ in a] == [d for d, _ in b] and [s for _, s in a] == pytest.approx([s for _, s in b], abs=1e-9)


def test_odd_rows(spark):
    docs, labels = corpus(120)
    docs += [(None, None, None, None), (500, "", "x", 1), (501, None, "x", 1), (1, docs[1][1], "x", 1), (502, "word " * 60_000, "x", 1)]
    labels += [(None, 1, "x"), (3, None, "x"), (9999, 1, "x"), labels[0]]
    got = Q.classify(*frames(spark, docs, labels)).collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == len(docs) and by[500] == by[501] == by[None]


@pytest.mark.parametrize("labels,want", [([], 0.5), ([(d, 1, "x") for d in range(6)], 1.0)])
def test_without_a_class(spark, labels, want):
    d, lab = frames(spark, [(1, "a", "x", 1), (2, None, "x", 1)], labels)
    assert [r.score for r in Q.classify(d, lab).collect()] == [want, want]
    assert Q.classify(d.limit(0), lab).collect() == []


def test_dictionaries_learn_from_the_whole_of_a_text(spark):
    rnd = random.Random(31)
    shared, good, bad = ([f"{kind}{rnd.randrange(10**6)}" for _ in range(60)] for kind in ("open", "fine", "spam"))
    some = lambda vocab, n: " ".join(rnd.choice(vocab) for _ in range(n))
    docs = spark.createDataFrame([(i, some(shared, 700) + " " + some(good if i % 2 else bad, 700)) for i in range(120)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    assert min(len(t.text.split("fine")[0].split("spam")[0]) for t in docs.collect()) > Q.EXCERPT
    assert sum(w.encode() in model.good for w in good) > 30 and sum(w.encode() in model.bad for w in bad) > 30
    assert not any(w.encode() in model.good for w in bad) and not any(w.encode() in model.bad for w in good)


def test_good_rows_are_those_predicted_with_all_columns(spark):
    docs, labels = corpus(200)
    docs += [(900, None, "x", None), (None, docs[0][1], None, 1), (901, "", None, None), (3, docs[3][1], "x", 3)]
    d, lab = frames(spark, docs, labels)
    model = Q.fit(d, lab)
    want = {r.doc_id for r in Q.score(d, model).filter("score >= 0.5").collect()}
    got = Q.good_rows(d, model)
    assert got.columns == d.columns and set(map(tuple, got.collect())) <= set(docs)
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(str(x[0]) for x in docs if x[0] in want)
    assert Q.good_rows(d, 0.5).count() == len(docs) and Q.good_rows(d, 0.4).count() == 0
    assert Q.good_rows(d.limit(0), model).collect() == []
