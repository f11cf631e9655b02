"""Near-dedup by a chosen-path set similarity join.

A document is the set of its distinct five-word shingles, as 64-bit
hashes. Documents with one and the same set form a class; one of each
class is joined. A class carries a minwise signature. Each tree starts
with one node per value of one signature position. A node with more
members than a leaf may hold branches: its members move to child nodes by
the values of one or two positions drawn for that node, so that a pair at
the threshold shares more than one child on average, while unlike
documents part. Leaves are compared exhaustively, first on signatures,
then what is left on the full sets. Independent trees bring the recall to
its target (0.15 ^ trees of the pairs at 0.85 are missed at the roots).

A node that does not come apart because its members are alike is not
branched: all members are checked against one pivot, and only those that
the pivot does not link are compared with every other member, in blocks.
No limit drops a member or a candidate.

Defined cases: a null or blank text has no shingles and is linked with
nothing, not even with other blank texts. Fewer than five words are one
shingle. Rows that share a doc_id count as linked. A row with a null
doc_id is linked with nothing and kept. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import dealt_join, space_words, table, text_column, written
from fleetpulse.llm.graph import components

WORDS = 5
PERCENT = 85  # 100 * intersection >= PERCENT * union
SIGNATURE = 64  # minwise values of a class
TREES = 6
LEAF = 1024  # members that are compared exhaustively
DEPTH = 16  # levels of a tree
PART = 4096  # members of a node that meet its pivot in one task, about
SECOND = 0.3  # share of nodes that branch on a second position
SLACK = 0.2  # signatures may agree by so much less than the threshold: over 4 standard deviations
TIGHT = 8  # a node is alike if at most one in TIGHT members is unlike its pivot


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (shifts and odd factors)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _factors(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, factors: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    w = space_words(text or "")
    if not w:
        return np.empty(0, np.uint64)
    x = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = max(1, len(w) - words + 1)
    with np.errstate(over="ignore"):
        out = np.full(n, min(len(w), words), np.uint64)
        for i in range(min(len(w), words)):
            out += x[i : i + n] * factors[i]
    return np.unique(_mix(out))


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each factor, its upper 32 bits."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 512):
            np.minimum(out, (shingles[at : at + 512, None] * factors).min(0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signed(docs: DataFrame, words: int = WORDS, size: int = SIGNATURE) -> DataFrame:
    """Per row: doc_id, n_shingles, the set's digest (f1, f2) and signature (null without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_factors, sig_factors = _factors(words, 1), _factors(size, 2)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                n, digest, sigs, ok = [], [], [], []
                for t in part.column(1):
                    s = shingle_set(t.as_py(), word_factors, words)
                    n.append(len(s))
                    ok.append(len(s) > 0)
                    digest.append(hashlib.sha256(s.tobytes()).digest()[:16])
                    sigs.append(signature(s, sig_factors))
                f = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
                ends = np.concatenate([[0], np.cumsum(np.where(ok, size, 0))]).astype(np.int32)
                values = np.concatenate([x for x, good in zip(sigs, ok, strict=True) if good] or [np.empty(0, np.int32)])
                sig = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(f[:, 0].copy()), pa.array(f[:, 1].copy()), sig],
                    ["doc_id", "n_shingles", "f1", "f2", "sig"],
                )

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return base.mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, sig array<int>")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the rows that share the first column's value, from rows in its order.

    Only groups of bounded size may be read this way.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if held and held[-1].column(0)[0] != b.column(0)[lo]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of a list column."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    return lists.flatten().to_numpy(), lists.value_lengths().to_numpy()


def _alike(sigs: np.ndarray, least: int) -> Iterator[np.ndarray]:
    """Members joined by chains of agreeing signatures, two or more at a time."""
    left = np.arange(len(sigs))
    while len(left):
        group, queue, left = [left[0]], [left[0]], left[1:]
        while queue and len(left):
            near = (sigs[left] == sigs[queue.pop()]).sum(1) >= least
            found, left = left[near], left[~near]
            group.extend(found)
            queue.extend(found)
        if len(group) > 1:
            yield np.array(group)


#: Shingles of a group that are compared by one table; beyond it, pair by pair in the memory of two sets.
TABLE = 4_000_000


def _common(sets: np.ndarray, sizes: np.ndarray):
    """A function of i and the members asked for: how many shingles each of them shares with member i."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    if len(sets) > TABLE:

        def by_pair(i: int, asked: np.ndarray) -> np.ndarray:
            own, out = sets[starts[i] : starts[i] + sizes[i]], np.zeros(len(sizes), np.int64)
            for j in np.flatnonzero(asked):
                out[j] = len(np.intersect1d(own, sets[starts[j] : starts[j] + sizes[j]], assume_unique=True))
            return out

        return by_pair
    _, local = np.unique(sets, return_inverse=True)
    mark = np.zeros(local.max() + 1, bool)

    def by_table(i: int, asked: np.ndarray) -> np.ndarray:
        own = local[starts[i] : starts[i] + sizes[i]]
        mark[own] = True
        out = np.add.reduceat(mark[local], starts, dtype=np.int64)
        mark[own] = False
        return out

    return by_table


def _links(sets: np.ndarray, sizes: np.ndarray, ids: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that span the components of a group, each confirmed on full sets."""
    common_with = _common(sets, sizes)
    root = np.arange(len(ids))
    out = []
    for i in range(len(ids)):
        apart = root != root[i]
        if not apart.any():
            break
        common = common_with(i, apart)
        linked = (100 * common >= percent * (sizes[i] + sizes - common)) & apart
        for j in np.flatnonzero(linked):
            if root[j] != root[i]:
                out.append((int(ids[i]), int(ids[j])))
                root[root == root[j]] = root[i]
    return out


def _ordered(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(key).sortWithinPartitions(key)


def full_sets(docs: DataFrame, ids: DataFrame, words: int = WORDS) -> DataFrame:
    """(id, shingles) of the documents with the given ids."""
    base = docs.select(F.col("doc_id").cast("long").alias("id"), text_column().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(words, 1)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                sets = [shingle_set(t.as_py(), factors, words) for t in part.column(1)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "shingles"])

    # The wanted ids grow with the documents: a sort-merge join at any size, whose sides can both spill.
    rows = base.join(ids.distinct().hint("merge"), "id").select("id", "text")
    return rows.mapInArrow(run, "id long, shingles array<long>").filter(F.size("shingles") > 0)


def confirmed(groups: DataFrame, sets: DataFrame, n: int, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) inside groups (gid, id), on the full sets; enough of them to span each group's components.

    `n` is about the number of ids.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in runs(batches):
            values, sizes = _flat(g.column(2))
            found = _links(values, sizes, g.column(1).to_numpy(), percent)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    # An id is in as many groups as leaves that hold it; a pivot is in all blocks of its node.
    counts = written(groups.groupBy("id").agg(F.count("*").alias("n")), "near-counts", n)
    rows = dealt_join(groups, sets, counts, "id", "gid").select("gid", "id", "shingles")
    return _ordered(rows, "gid").mapInArrow(compare, "a long, b long")


def tree_nodes(classes: DataFrame, trees: int, leaf: int, depth: int, size: int, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """Leaves (node, id), and the nodes that do not come apart (node, id, n) or None, of all trees."""
    spread = [int(i) for i in np.random.default_rng(3).permutation(max(size, trees))[:trees] % size]
    roots = F.array(*[F.struct(F.lit(r).alias("tree"), F.xxhash64(F.lit(r), F.col("sig")[p]).alias("node")) for r, p in enumerate(spread)])
    rows = classes.select("id", F.explode(roots).alias("r")).select("id", "r.tree", "r.node")
    # Each level of a tree draws from positions of its own, so that no node branches where an ancestor did.
    width = max(2, size // (depth + 1))
    n_rows = classes.count() * trees
    linked = int(size * percent / 100)  # values that a linked pair has in common, or most of such pairs
    leaves, tight = None, None
    for level in range(depth + 1):
        sized = written(rows.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1"), "near-sized", n_rows)
        rows = written(dealt_join(rows, sized, sized, "node", "id").select("node", "id", "tree", "n"), "near-level", n_rows)
        done = rows.filter(F.col("n") <= leaf).select("node", "id")
        leaves = done if leaves is None else leaves.unionByName(done)
        big = rows.filter(F.col("n") > leaf)
        if big.isEmpty():
            break
        if level < depth:
            # A node of any size meets its pivot in parts of a bounded number of members.
            parts = F.ceil(F.col("n") / PART)
            big = written(big.join(classes, "id").withColumn("part", F.pmod(F.xxhash64("id"), parts)), "near-big", n_rows)
            pivots = big.groupBy("node").agg(F.min(F.struct("id", "sig")).alias("p"), F.max("n").alias("n"))
            pivots = pivots.select("node", F.col("p.sig").alias("pivot"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
            same = F.aggregate(F.zip_with("sig", "pivot", lambda x, y: (x == y).cast("int")), F.lit(0), lambda x, y: x + y)
            scored = big.join(pivots, ["node", "part"]).groupBy("node", "part").agg(F.max("n").alias("n"), F.sum((same < linked).cast("long")).alias("far"))
            alike = scored.groupBy("node").agg(F.max("n").alias("n"), F.sum("far").alias("far")).filter(F.col("far") * TIGHT <= F.col("n"))
            alike = written(alike.select("node"), "near-alike", n_rows // leaf)
            stuck = big.join(alike, "node", "left_semi")
            big = big.join(alike, "node", "left_anti")
        else:
            stuck = big
        stuck = stuck.select("node", "id", "n")
        tight = stuck if tight is None else tight.unionByName(stuck)
        if level == depth:
            break
        start = F.lit(level * width) + F.col("tree") * F.lit(max(1, size // trees))
        pick = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(width))
        other = F.pmod(pick + 1 + F.pmod(F.xxhash64("node", F.lit(2)), F.lit(width - 1)), F.lit(width))
        first, other = (F.pmod(start + x, F.lit(size)).cast("int") for x in (pick, other))
        two = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1000)) < int(1000 * SECOND)
        child = lambda c, p: F.xxhash64("node", F.lit(c), F.element_at("sig", p + 1))
        keys = F.when(two, F.array(child(0, first), child(1, other))).otherwise(F.array(child(0, first)))
        rows = big.select("id", "tree", F.explode(keys).alias("node"))
    return leaves, tight


def leaf_groups(leaves: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(gid, id): members of leaves whose signatures agree, in chains; groups that several leaves hold come once."""
    least = int(size * (percent / 100 - SLACK))
    schema = pa.schema([("gid", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in runs(batches):
            ids = g.column(1).to_numpy()
            found = [np.unique(ids[m]) for m in _alike(_flat(g.column(2))[0].reshape(-1, size), least)]
            if found:
                gids = [int.from_bytes(hashlib.sha256(x.tobytes()).digest()[:8], "little", signed=True) for x in found]
                yield pa.RecordBatch.from_arrays([pa.array(gids, pa.int64()), pa.array(found, schema.field(1).type)], schema=schema)

    rows = _ordered(leaves.join(classes, "id").select("node", "id", "sig"), "node")
    return rows.mapInArrow(run, "gid long, ids array<long>").dropDuplicates(["gid"]).select("gid", F.explode("ids").alias("id"))


def all_links(groups: DataFrame, tight: DataFrame | None, docs: DataFrame, n: int, leaf: int, words: int, percent: int) -> DataFrame:
    """Links of leaf groups, and inside nodes whose members are alike: a star around a pivot, then whatever the pivot does not link."""
    if tight is None or tight.isEmpty():
        return confirmed(groups, full_sets(docs, groups.select("id"), words), n, percent)
    # The texts are read once: both passes compare from the sets.
    sets = written(full_sets(docs, groups.select("id").unionByName(tight.select("id")), words), "near-sets", n, 10_000)
    tight = written(tight.distinct(), "near-tight", n)
    half = max(1, leaf // 2)
    block = lambda n: F.pmod(F.xxhash64("id"), F.ceil(F.col(n) / half))
    pivots = written(tight.groupBy("node").agg(F.min("id").alias("pivot"), F.max("n").alias("n")), "near-pivots", n // leaf)
    blocks = pivots.select("node", "pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / half) - 1)).alias("j"))
    members = tight.select("node", "id", block("n").alias("j"))
    gid = F.xxhash64("node", "j")
    stars = members.select(gid.alias("gid"), "id").unionByName(blocks.select(gid.alias("gid"), F.col("pivot").alias("id"))).distinct()
    first_links = written(confirmed(written(groups.unionByName(stars), "near-stars", n), sets, n, percent), "near-links", n)
    # Whatever is linked to the pivot by now, directly or not, needs no other comparison with its like.
    star_roots = components(first_links, rows=n)
    own = star_roots.select(F.col("id").alias("pivot"), F.col("root").alias("pivot_root"))
    centres = pivots.join(own, "pivot", "left").select("node", "pivot", "pivot_root")
    placed = dealt_join(members.join(star_roots, "id", "left"), centres, pivots, "node", "id")
    apart = F.col("root").isNull() | F.col("pivot_root").isNull() | (F.col("root") != F.col("pivot_root"))
    far = written(placed.filter((F.col("id") != F.col("pivot")) & apart).select("node", "id"), "near-far", n)
    if far.isEmpty():
        return first_links
    counts = written(far.groupBy("node").agg(F.count("*").alias("n")), "near-far-counts", n // leaf)
    far = dealt_join(far, counts, counts, "node", "id").select("node", "id", block("n").alias("i"))
    fars = counts.withColumnRenamed("n", "m").join(blocks, "node").select("node", "pivot", "j", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("m") / half) - 1)).alias("i"))
    cell = F.xxhash64("node", "i", "j").alias("gid")
    cells = (
        members.join(fars.select("node", "i", "j"), ["node", "j"]).select(cell, "id")
        .unionByName(far.join(fars.select("node", "i", "j"), ["node", "i"]).select(cell, "id"))
        .unionByName(fars.select(cell, F.col("pivot").alias("id")))
        .distinct()
    )
    return first_links.unionByName(confirmed(written(cells, "near-cells"), sets, n, percent))


def similarity_classes(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, trees: int = TREES, leaf: int = LEAF, depth: int = DEPTH, size: int = SIGNATURE
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = written(signed(docs, words, size), "near-signed")
    full = rows.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    first = full.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "sig")).alias("m"))
    classes = written(first.select("f1", "f2", F.col("m.doc_id").alias("id"), "m.sig"), "near-classes", rows.count())
    reps = classes.select("f1", "f2", F.col("id").alias("rep"))
    classes = classes.select("id", "sig")
    n = classes.count()
    leaves, tight = tree_nodes(classes, trees, leaf, depth, size, percent)
    groups = written(leaf_groups(leaves, classes, size, percent), "near-groups", n)
    links = all_links(groups, tight, docs, n, leaf, words, percent)
    # An id that stands for several texts links their classes.
    texts = full.join(reps, ["f1", "f2"]).select("doc_id", "rep")
    several = texts.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).filter("b <> last").drop("last")
    same_id = texts.join(several, "doc_id").select(F.col("rep").alias("a"), "b")
    roots = components(links.unionByName(same_id), rows=n)
    named = reps.join(roots, F.col("rep") == F.col("id"), "left").select("f1", "f2", F.coalesce("root", "rep").alias("root"))
    return rows.join(named, ["f1", "f2"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("root")).alias("component_id"),
    ).select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def q_near_dedup(spark, sf_dir):
    return similarity_classes(table(spark, sf_dir, "documents"))
