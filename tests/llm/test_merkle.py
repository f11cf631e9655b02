import hashlib
import random
import zlib

import pytest

from fleetpulse.llm import merkle as M
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, path int, root string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    d, _, lang, source, n = row[:5]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n, text)))


def grow(nodes):
    """Levels of a tree from its leaves up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def steps(levels, at):
    out = []
    for row in levels[:-1]:
        run = at // 3 * 3
        out.append(("".join(row[run:at]), "".join(row[at + 1 : run + 3])))
        at //= 3
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    trees = {}
    for s, rs in by.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = grow([leaf(r, r[1]) for r in rs])
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    top = grow([trees[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for s in order:
        for i, r in enumerate(by[s]):
            path = steps(trees[s], i) + steps(top, order.index(s))
            cut = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf(r, r[1].replace("\n", "") if cut else r[1])
            for before, after in path:
                node = sha(before + node + after)
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def run(spark, rows, every):
    tampered = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    df = M.audited(spark.createDataFrame(rows, SCHEMA), tampered, F.crc32(F.col("doc_id").cast("string")) % 2 == 0, every)
    return sorted((tuple(r) for r in df.collect()), key=str)


def make(sizes, seed=1):
    rnd = random.Random(seed)
    ids = rnd.sample(range(10_000), sum(n for _, n in sizes))
    rows, at = [], 0
    for source, n in sizes:
        for d in ids[at : at + n]:
            text = rnd.choice([None, "", "a\nb", f"text {d}", "é\n\nü" * (d % 5), "x" * 50_000])
            rows.append((d, text, rnd.choice(["en", None]), source, rnd.choice([None, d]), "k", 1, "r"))
        at += n
    return rows


@pytest.mark.parametrize("every", [1, 2, 4])
def test_sources_of_many_sizes_match_brute_force(spark, every):
    rows = make([(None, 4), ("", 1), ("a", 300), ("b", 2), ("é", 3), ("Z", 9), ("z", 10), ("zz", 28)])
    rows += [rows[5], rows[5], (None, "t\n", "en", "a", 1, None, None, None), (None, None, None, None, None, None, None, None), (rows[0][0], "other\n", None, None, 3, None, None, None)]
    got = run(spark, rows, every)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 27, 28, 81, 82, 243, 244])
def test_one_source(spark, n):
    rows = make([("only", n)], seed=n)
    assert run(spark, rows, 4) == brute(rows)


def test_what_is_stored_skips_levels(spark):
    leaves = M.document_leaves(spark.createDataFrame(make([("a", 100)]), SCHEMA))
    t = M.tree(leaves, ["doc_id", "digest"], every=2)
    nodes = [sum(len(r["nodes"]) for r in s.collect()) for s in t.stored]
    assert nodes == [100, 12, 2]
    assert max(len(r["nodes"]) for r in t.stored[0].collect()) == 9


def test_empty_table(spark):
    assert run(spark, [], 4) == []
