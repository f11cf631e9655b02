import random

import pytest

from fleetpulse.llm import exact_dedup as X

SCHEMA = "doc_id long, text string, keep_id string, sha string"


def brute(rows):
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for d, t, *_ in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((d, keep, len(g), d == keep))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = X.exact_groups(spark.createDataFrame(rows, SCHEMA), **kw)
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


def test_pieces_combine_to_the_whole():
    rnd = random.Random(1)
    for _ in range(30):
        data = rnd.randbytes(rnd.randrange(0, 20_000))
        at = rnd.randrange(len(data) + 1)
        assert X.combine(X.fingerprint(data[:at]), X.fingerprint(data[at:]), len(data) - at) == X.fingerprint(data)
        want = sum(b * pow(X.BASES[0], len(data) - 1 - i, X.PRIME) for i, b in enumerate(data)) % X.PRIME
        assert X.fingerprint(data)[0] == want


@pytest.mark.parametrize("prime", [X.PRIME, 7])
def test_groups_match_brute_force(spark, prime):
    """A tiny prime makes different texts share fingerprints; they must be told apart."""
    rnd = random.Random(2)
    texts = ["", None, "a", "b", "é", "x" * 50, "x" * 49 + "y", "long " * 300, "long " * 299 + "lonG ", "ab" * 100, "ba" * 100]
    rows = [(i, rnd.choice(texts), "z", "q") for i in range(60)] + [(5, "a", None, None), (5, "a", None, None), (None, None, None, None), (None, "only", None, None)]
    assert run(spark, rows, chunk=64, prime=prime) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
