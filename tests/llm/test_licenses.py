import random
import re

from fleetpulse.llm import licenses as L
from fleetpulse.llm.common import letter_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def base_places(t):
    w = words(t)
    out = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, labels string, n_words int")
    return L.digests(L.scan(df)).collect()


def check_base(r, t):
    want = base_places(t)
    starts = [s for s, _ in want]
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words(t)), len(want), min(starts, default=None), max(starts, default=None)), t
    assert r.base_labels == ",".join(sorted({x for _, x in want}))
    assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_places_match_brute_force(spark):
    rnd = random.Random(9)
    vocab = ["cc", "CC", "by", "general", "Public", "license", "all", "rights", "reserved", "gnu", "the", "x", "é", "nc", "licensed", "under"]
    rows = [(i, rnd.choice([" ", ", ", "-"]).join(rnd.choice(vocab) for _ in range(rnd.randrange(60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "cc by"), (3, rows[3][1]), (202, "cc by " * 30_000), (203, "cc cc by by")]
    got = run(spark, rows)
    assert len(got) == len(rows)
    for r, (d, t) in zip(sorted(got, key=lambda r: str((r.doc_id, r.n_words))), sorted(rows, key=lambda x: str((x[0], len(words(x[1]))))), strict=True):
        assert r.doc_id == d
        check_base(r, t)
    assert run(spark, []) == []


def test_templates_and_their_variants(spark):
    rows = [(i, f"Foo bar.\n{t.title()}; more.") for i, t in enumerate(L.TEMPLATES)]
    rows += [(100, "Licensed under the Apache License, Version 2.0."), (101, "This work is licensed under the GNU (General Public License), ver version 3"), (102, "the license of the mit under it")]
    got = {r.doc_id: r for r in run(spark, rows)}
    for i, label in enumerate(L.TEMPLATES.values()):
        assert label in got[i].labels.split(",") and got[i].score == 1
    assert got[100].labels == "apache-2.0" and got[100].score == 1
    assert got[101].labels == "gpl,gpl-3.0" and got[102].labels == "" and got[102].score == 0


def test_matching_statistics():
    rnd = random.Random(10)
    seqs = [[rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randrange(1, 12))] for _ in range(6)]
    auto = L.Automaton([(s, "t") for s in seqs], [([b"a", b"b"], "p")])
    runs = {tuple(s[i:j]) for s in [*seqs, [b"a", b"b"]] for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for _ in range(200):
        w = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(rnd.randrange(30))]
        stat = [max((n for n in range(1, i + 2) if tuple(w[i + 1 - n : i + 1]) in runs), default=0) for i in range(len(w))]
        want = [(i + 1, n) for i, n in enumerate(stat) if n > 1 and (i + 1 == len(w) or stat[i + 1] != n + 1)]
        places, matches = auto.scan(w)
        assert [(e, n) for e, n, _ in matches] == want
        assert sorted(places) == [(i, "p") for i in range(len(w) - 1) if w[i : i + 2] == [b"a", b"b"]]
        for e, n, s in matches:
            ends = [(t, k) for t, x in enumerate(seqs) for k in range(n, len(x) + 1) if x[k - n : k] == w[e - n : e]]
            assert auto.ends[s] == sorted(ends)


def test_word_rule():
    t = "Ab-c9_Éé\tΩ{x}"
    assert [w.decode() for w in letter_words(t)] == words(t)


def test_overlapping_templates_hide_nothing(spark):
    texts = ["Licensed under CC BY NC SA 4.0", "a b c d e f g h and more", "x b c d e y", "b c d x d e f g"]
    templates = L.TEMPLATES | {"a b c d e f g h": "long", "b c d e": "inner", "c d e f g h and": "late", "b c d q e f g": "joined"}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: sorted((s.label, s.start, s.end, round(s.coverage, 3)) for s in r.spans) for r in L.scan(df, templates=templates).collect()}
    # Of the NC notice `4 0` is shorter than LEAST, so 5 of its 7 words count.
    assert got[0] == [("cc-by-sa-4.0", 0, 8, 1.0)]
    assert got[1] == [("inner", 1, 5, 1.0), ("joined", 1, 7, 0.857), ("late", 2, 9, 1.0), ("long", 0, 8, 1.0)]
    assert got[2] == [("inner", 1, 5, 1.0)]
    assert ("joined", 0, 8, round(6 / 7, 3)) in got[3]


def test_shared_runs_match_brute_force():
    rnd = random.Random(11)
    seqs = [[rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randrange(3, 12))] for _ in range(6)]
    auto = L.Automaton([(s, str(i)) for i, s in enumerate(seqs)], [])
    for _ in range(100):
        w = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(rnd.randrange(30))]
        want = set()
        for t, x in enumerate(seqs):
            for i in range(len(w)):
                for j in range(len(x)):
                    if w[i] == x[j] and not (i and j and w[i - 1] == x[j - 1]):
                        n = next((n for n in range(1, 99) if i + n >= len(w) or j + n >= len(x) or w[i + n] != x[j + n]))
                        if n >= L.LEAST:
                            want.add((t, i, j, n))
        found = {(t, e - run + i, j, n) for e, run, s in auto.scan(w)[1] for t, i, j, n in auto.shared(run, s)}
        # Every run that cannot grow in the text is among the shares; others are parts of one.
        assert want <= found
        assert all(any(t == u and i - j == k - m and k <= i and i + n <= k + o for u, k, m, o in want) for t, i, j, n in found)
