import hashlib
import random

import pytest

import corpus_pipeline as P
from fleetpulse.llm import bpe
from test_decontam import brute as brute_contamination
from test_near_dedup import brute as brute_near

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, keep_doc_id long"


def corpus(seed=19):
    rnd = random.Random(seed)
    syll = ["an", "the", "ro", "mi", "ta", "lo", "ne", "ki", "su"]
    word = lambda: "".join(rnd.choice(syll) for _ in range(rnd.randrange(2, 6)))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(6)]
    texts, good = [], []
    for _ in range(150):
        w = [word() for _ in range(rnd.randrange(30, 90))]
        ok = rnd.random() < 0.75
        texts.append(" ".join(w) if ok else "!! ".join(w).upper())
        good.append(ok)
    for i in range(0, 60, 3):
        texts += [texts[i], texts[i] + " " + word()]
        good += [good[i]] * 2
    for i, (_, t) in enumerate(items):
        texts.append(" ".join(word() for _ in range(20 + 300 * (i % 2))) + " " + t)
        good.append(True)
    docs = [(i, t, "en", "s", len(t), "x", 1) for i, t in enumerate(texts)]
    docs += [(900, None, None, None, None, None, None), (901, "", None, None, None, None, None), (None, texts[0], None, None, None, None, None)]
    labels = [(i, int(g), 0) for i, g in enumerate(good) if rnd.random() < 0.8]
    return docs, items, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, items, labels = corpus()
    top = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return str(top)


def test_stages_match_brute_force_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs = stage(spark, docs, folder)
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        docs = P.written(docs, "test")
        kept[name] = [tuple(r) for r in docs.collect()]
        assert set(kept[name]) <= set(before)
        if name == "exact":
            last = {}
            for d, t, *_ in before:
                last[t or ""] = max(d if d is not None else -1, last.get(t or "", -1))
            assert sorted(r[0] for r in kept[name]) == sorted(last.values())
        if name == "near":
            known = [r for r in before if r[0] is not None]
            assert sorted(r[0] for r in kept[name] if r[0] is not None) == sorted(r[0] for r in brute_near(known) if r[3])
        if name == "decontaminate":
            items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            assert sorted(str(r[0]) for r in kept[name]) == sorted(str(r[0]) for r in brute_contamination([r[:2] for r in before], items) if not r[5])
            assert len(kept[name]) < len(before)
    labels = {d: q for d, q, _ in (tuple(r) for r in spark.read.parquet(f"{folder}/labels.parquet").collect())}
    stay = {r[0] for r in kept["quality"]}
    assert sum((d in stay) == bool(q) for d, q in labels.items()) / len(labels) > 0.95
    tokens = P.token_stage(spark, docs, folder).collect()
    enc = bpe._encoder(*bpe.vocabulary())
    want = [(r[0], len(enc.encode_ordinary(r[1] or "")), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in kept["decontaminate"]]
    assert sorted(map(str, ((r.doc_id, r.n_tokens, r.decoded_sha256) for r in tokens))) == sorted(map(str, want))


def test_run_chains_the_stages(spark, folder):
    got = P.run(spark, folder).collect()
    assert 20 < len(got) < 120 and len({r.doc_id for r in got}) == len(got)


def test_empty_documents(spark, folder, tmp_path):
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
