import hashlib
import random

import pytest
import regex

from fleetpulse.llm import bpe


@pytest.fixture(scope="module")
def enc():
    path, pattern = bpe.vocabulary()
    return bpe._encoder(path, pattern)


def want(enc, d, text):
    ids = enc.encode_ordinary(text or "")
    return d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_whole_and_chunked_texts_equal_the_library(spark, enc):
    rnd = random.Random(3)
    bits = ["the", " ", "  ", "\n", "\n\n ", "'ll", "'", "don't", "123", "é", "日本", "!?", "<|endoftext|>", " ", "x" * 60, "\t"]
    texts = ["", None, " ", "a" * 900, " " * 900, "'" * 500] + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 400))) for _ in range(60)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(2, " ", "x"), (None, texts[-1], None), (900, texts[-1], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    for chunk, overlap in ((64, 16), (40, 12), (10_000, 100)):
        got = bpe.digests(bpe.encode(df, *bpe.vocabulary(), chunk=chunk, overlap=overlap))
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(str(want(enc, d, t)) for d, t, _ in rows)


def test_long_runs_and_long_texts_at_the_default_chunk(spark, enc):
    """A run of blanks that the library's own pre-tokeniser does not survive, and texts of many chunks."""
    path, pattern = bpe.vocabulary()
    rnd = random.Random(5)
    prose = "".join(rnd.choice(["the ", "don't", " 12", "\n", "日本", "é", "  ", "!?"]) for _ in range(60_000))
    run = [(1, "word " + " " * 2_000_000 + "x"), (2, "word\t" + "\n " * 3000 + "x"), (3, prose), (4, "y" * 100_000), (5, " " * bpe.BLANKS)]
    got = {r.doc_id: tuple(r) for r in bpe.digests(bpe.encode(spark.createDataFrame(run, "doc_id long, text string"), path, pattern)).collect()}
    found = regex.compile(pattern)
    for d, text in run:
        ids = [i for m in found.findall(text) for i in enc._encode_single_piece(m)]
        assert d == 1 or ids == enc.encode_ordinary(text)
        assert got[d] == (d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_cuts_are_match_starts():
    _, pattern = bpe.vocabulary()
    found = regex.compile(pattern)
    rnd = random.Random(4)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "b", " ", " ", "'", "l", "s", "1", "\n", "!", "é"]) for _ in range(rnd.randrange(30, 300)))
        chunk, overlap = 30, rnd.choice([10, 14, 20])
        chunks = []
        for at in range(0, len(text), chunk):
            head, tail = bpe.chunk_boundaries(found, text[at : at + chunk + overlap], overlap if at else 0, chunk, at + chunk >= len(text))
            chunks.append((at, [at + s for s in head], [at + s for s in tail]))
        pieces = bpe.stitch(chunks, len(text))
        assert "".join(text[a:b] for a, b in pieces) == text
        assert [m for a, b in pieces for m in found.findall(text[a:b])] == found.findall(text)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.encode(df, *bpe.vocabulary())).collect() == []
