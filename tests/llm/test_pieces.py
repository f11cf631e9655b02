import hashlib
import random

import pytest
import sentencepiece

from fleetpulse.llm import pieces as P

BITS = ["the", " ", "  ", "   ", "\n", "\t", "don't", "123", "é", "é", "日本", "ｱﾌﾟ", "ﬁ", " ", "▁", "<s>", "<0x0A>", "\x00", "x" * 70, "\U0001f600", "​", "Ω", "한국", "ab"]


def texts(seed, n, most=60):
    rnd = random.Random(seed)
    return ["", " ", "  ", "▁", "a", " a ", "\n", "x" * 3000, " " * 3000, "日" * 700, "\U0001f600" * 50] + [
        "".join(rnd.choice(BITS) for _ in range(rnd.randrange(1, most))) for _ in range(n)
    ]


@pytest.fixture(scope="module")
def model():
    return P.model_path()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_file=model)


def spans(library, text):
    """(id, begin, end, surface) of the library's own encoding."""
    return [(p.id, p.begin, p.end, p.surface) for p in library.encode(text, return_type="proto").pieces]


@pytest.mark.parametrize("slab", [1, 7, 64, P.SLAB])
def test_ids_and_spans_are_the_librarys(model, library, slab):
    e = P.Encoder(model)
    for t in texts(1, 150):
        data = t.encode()
        ids, begins, ends = (x.tolist() for x in e.encode(data, slab))
        assert ids == library.encode(t), t
        assert [(i, b, f, data[b:f].decode()) for i, b, f in zip(ids, begins, ends, strict=True)] == spans(library, t), t


def test_spans_cover_the_text(model):
    e = P.Encoder(model)
    for t in texts(2, 50):
        data = t.encode()
        _, begins, ends = e.encode(data)
        assert b"".join(data[b:f] for b, f in zip(begins, ends, strict=True)) == data


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("remove_extra", [True, False])
def test_longest_prefixes_of_a_compiled_map(model, tmp_path, rule, remove_extra):
    """The installed model with another normaliser: ids and spans of the library again."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    ruled, own = pb.ModelProto(), pb.ModelProto()
    ruled.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    with open(model, "rb") as f:
        own.ParseFromString(f.read())
    own.normalizer_spec.precompiled_charsmap = ruled.normalizer_spec.precompiled_charsmap
    own.normalizer_spec.remove_extra_whitespaces = remove_extra
    path = str(tmp_path / "ruled.model")
    with open(path, "wb") as f:
        f.write(own.SerializeToString())
    library, e = sentencepiece.SentencePieceProcessor(model_file=path), P.Encoder(path)
    assert e.normaliser.map is not None
    for t in texts(3, 120, 30):
        data = t.encode()
        for slab in (5, P.SLAB):
            ids, begins, ends = (x.tolist() for x in e.encode(data, slab))
            assert ids == library.encode(t), t
            assert [(i, b, f) for i, b, f in zip(ids, begins, ends, strict=True)] == [s[:3] for s in spans(library, t)], t


def test_long_texts_without_a_cut_are_the_librarys(model, library):
    rnd = random.Random(4)
    e = P.Encoder(model)
    for alphabet in ("ab", "etaoin", "日本語", "▁ "):
        t = "".join(rnd.choice(alphabet) for _ in range(5000))
        assert e.encode(t.encode(), 100)[0].tolist() == e.encode(t.encode())[0].tolist() == library.encode(t)


def test_bytes_that_are_not_utf8(model, library):
    ids, begins, ends = P.Encoder(model).encode(b"a\xff b\xc3")
    assert ids.tolist() == library.encode("a� b�")
    assert ends.tolist()[-1] == 5 and begins.tolist()[0] == 0


def test_documents(spark, model, library):
    rows = [(i, t, "x", [1]) for i, t in enumerate(texts(5, 40))] + [(3, "▁", "x", None), (None, "a b", None, None), (900, None, None, None), (901, "word " * 200_000, "long", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    got = P.digests(P.decode(P.encode(df, model), model)).collect()

    def want(d, t):
        ids = library.encode(t or "")
        text = library.decode(ids) if ids else ""
        return d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    assert sorted(map(str, map(tuple, got))) == sorted(str(want(d, t)) for d, t, *_ in rows)
    assert P.digests(P.decode(P.encode(df.limit(0), model), model)).collect() == []
