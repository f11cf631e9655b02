"""Merkle manifest of a dataset: checkpoint and recompute.

Leaves are SHA-256 digests of rows. Per key (a document's source) they
stand in order, and every ARITY neighbours become the digest of their
concatenation, up to one subroot; the subroots of all keys, in key order,
go the same way up to the root. Only every `every`-th level is persisted,
as one row for each aligned subtree with the digests at its base. A proof
needs the levels between as well: each subtree regenerates them from its
stored base, emits the siblings of its base nodes' paths and discards
them. Proofs are made from the root down, a stored level at a time, so a
subtree meets one row, the path of its own top.

Positions come from one range sort of the digests and the row counts of
its partitions, so that a key with any share of all rows is spread over
many tasks; a task holds no more than `ARITY ** every` nodes of one.

Defined cases: a null field counts as `-`, which no value is written as;
null sources are one key, ordered first. Null doc_ids come first in their
source, equal doc_ids stand in the order of their leaves, so repeated
rows are neighbouring equal leaves. A row with a null doc_id is never
tampered with. An empty text is `0:`. An empty table has no root and an
empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.functions import once
from fleetpulse.llm.common import table, written

ARITY = 3
EVERY = 4  # levels from one persisted level to the next

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_POWERS = [ARITY**i for i in range(39)]  # up to what a long holds


def digest(*columns: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated inputs."""
    return F.sha2(F.concat(*columns), 256)


def field(value: Column) -> Column:
    """A field of a leaf: UTF-8 byte count, colon, value; `-` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """Digest of a document's row; `changed` replaces fields by other columns."""
    return digest(*[field(changed.get(c, F.col(c))) for c in FIELDS])


def source_key(source: Column) -> Column:
    """A source as a non-null key in the same order: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("-"))


def height(n: Column) -> Column:
    """Levels above `n` nodes: how often runs of ARITY must be merged until one node is left."""
    return F.size(F.filter(F.array(*map(F.lit, _POWERS)), lambda p: p < n))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `pos`, a row's place in its `key` from 0 on, and `h`, the height of the key's tree.

    One range sort; then the counts of each sorted partition, at most one
    row for a key and partition, tell where its rows begin.
    """
    placed = written(rows.sort("key", *order).withColumn("_id", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    of_key = Window.partitionBy("key")
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("key", "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    starts = starts.select(
        "key", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), height(F.sum("_rows").over(of_key)).alias("h")
    )
    joined = placed.join(starts, ["key", "_part"])
    return joined.select(*rows.columns, (F.col("_id") + F.col("_shift")).alias("pos"), "h")


def _levels(base: Column, steps: Column, every: int) -> Column:
    """Levels of a subtree from its base up, `steps` of them above the base."""

    def above(row: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(row) - 1) / ARITY).cast("int"))
        return F.transform(runs, lambda r: F.sha2(F.concat_ws("", F.slice(row, r * ARITY + 1, F.lit(ARITY))), 256))

    rounds = F.slice(F.array(*[F.lit(i) for i in range(every)]), F.lit(1), steps)
    return F.aggregate(rounds, F.array(base), lambda done, _: F.concat(done, F.array(above(F.element_at(done, -1)))))


def _siblings(levels: Column, steps: Column, at: Column, every: int) -> Column:
    """Path of a subtree's base node `at`: for each level the siblings' digests before and after it, concatenated."""

    def step(t: Column) -> Column:
        row = F.element_at(levels, t + 1)
        own = F.floor(at / F.element_at(F.array(*map(F.lit, _POWERS[: every + 1])), t + 1)).cast("int")
        run = F.floor(own / ARITY).cast("int") * ARITY
        return F.struct(
            F.concat_ws("", F.slice(row, run + 1, own - run)).alias("before"),
            F.concat_ws("", F.slice(row, own + 2, run + (ARITY - 1) - own)).alias("after"),
        )

    return F.transform(F.slice(F.array(*[F.lit(i) for i in range(every)]), F.lit(1), steps), step)


def _steps(i: int, every: int) -> Column:
    """Levels that a subtree of the `i`-th stored level spans; fewer at the top of its tree."""
    return F.least(F.lit(every), F.col("h") - i * every)


@dataclass
class Tree:
    """Persisted levels of the trees of all keys.

    `stored[i]` has a row for each aligned subtree whose base is level
    `i * every`: key, at (its place), h (the tree's height), nodes (the
    base in order: pos, digest and, on leaves, what the leaf carries) and
    top, the subtree's own digest. `roots` has key and root.
    """

    stored: list[DataFrame]
    roots: DataFrame
    every: int

    def proofs(self, above: DataFrame) -> DataFrame:
        """Every leaf with its path: what the leaf carries, digest, path, and the columns of `above`.

        `above` has one row for each key: key, path (the steps from its
        root on) and any other columns. A path is an array of steps, from
        the leaf up: the digests `before` and `after` the node in its run.
        """
        carried = [c for c in above.columns if c not in ("key", "path")]
        nodes, down = None, above.withColumn("at", F.lit(0).cast("long"))
        for i in range(len(self.stored) - 1, -1, -1):
            tall = F.col("h") > (i + 1) * self.every
            subtrees = self.stored[i].drop("top").withColumn("_steps", _steps(i, self.every))
            met = subtrees.filter(~tall).join(down, ["key", "at"])
            if nodes is not None:
                met = met.unionByName(subtrees.filter(tall).join(nodes, ["key", "at"]))
            met = met.withColumn("_levels", once(_levels(F.col("nodes.digest"), F.col("_steps"), self.every)))
            paths = F.transform(
                "nodes",
                lambda x, j: F.struct(x.alias("node"), F.concat(_siblings(F.col("_levels"), F.col("_steps"), j, self.every), F.col("path")).alias("path")),
            )
            met = met.select("key", *carried, F.explode(paths).alias("x"))
            nodes = met.select("key", *carried, "x.path", *(["x.node.*"] if i == 0 else [F.col("x.node.pos").alias("at")]))
        return nodes.drop("pos", "key")


def tree(leaves: DataFrame, order: list[str], every: int = EVERY) -> Tree:
    """Builds the trees over rows of key, digest and what else a leaf carries, in the order of the columns `order`."""
    carried = [c for c in leaves.columns if c != "key"]
    level, stored, tops = ranked(leaves, order), [], []
    while True:
        i = len(stored)
        node = F.struct("pos", *[c for c in (carried if i == 0 else ["digest"])])
        wide = F.lit(ARITY**every)
        runs = level.groupBy("key", F.floor(F.col("pos") / wide).cast("long").alias("at")).agg(
            F.first("h").alias("h"), F.array_sort(F.collect_list(node)).alias("nodes")
        )
        top = F.element_at(F.element_at(_levels(F.col("nodes.digest"), _steps(i, every), every), -1), 1)
        done = written(runs.withColumn("top", top), f"merkle-{i * every}")
        stored.append(done)
        tall = F.col("h") > (i + 1) * every
        tops.append(done.filter(~tall).select("key", F.col("top").alias("root")))
        if (done.agg(F.max("h")).first()[0] or 0) <= (i + 1) * every:
            break
        level = done.filter(tall).select("key", F.col("at").alias("pos"), "h", F.col("top").alias("digest"))
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    return Tree(stored, roots, every)


def manifest(rows: DataFrame, order: list[str], every: int = EVERY) -> DataFrame:
    """Every leaf with subroot, root and path, the proof that it belongs to the dataset.

    `rows`: key, digest and what else a leaf carries (none of subroot,
    root, path). Leaves stand in the order of the columns `order`.
    """
    by_key = tree(rows, order, every)
    subroots = by_key.roots.select(F.lit("").alias("key"), F.col("key").alias("of"), F.col("root").alias("digest"))
    over = tree(subroots, ["of"], every)
    no_steps = F.slice(F.array(F.struct(F.lit("").alias("before"), F.lit("").alias("after"))), 1, 0)
    whole = over.roots.select("key", "root", no_steps.alias("path"))
    above = over.proofs(whole).select(F.col("of").alias("key"), F.col("digest").alias("subroot"), "root", "path")
    return by_key.proofs(written(above, "merkle-subroots"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["before"], node, s["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"]))), 256)


def document_leaves(docs: DataFrame, changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """key, doc_id, digest of each document, and `seen`: the leaf of what is found later.

    `seen` is the leaf with the fields `changed` where `where` holds, else
    null: the row is as it was.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c) for c in FIELDS[1:]])
    seen = F.lit(None).cast("string") if changed is None else F.when(where, leaf(**changed))
    return rows.select(source_key(F.col("source")).alias("key"), "doc_id", leaf().alias("digest"), seen.alias("seen"))


def audited(docs: DataFrame, changed: dict[str, Column], where: Column, every: int = EVERY) -> DataFrame:
    """Manifest of docs, and whether each row as seen later still leads to the root."""
    leaves = written(document_leaves(docs, changed, where), "merkle-leaves")
    proved = manifest(leaves, ["doc_id", "digest"], every)
    out = proved.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("seen", "digest"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def q_merkle(spark, sf_dir):
    tampered = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return audited(table(spark, sf_dir, "documents"), tampered, hit)


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, [*FIELDS[:-1], text])) + ")"


#: CRC-32 bit by bit; the polynomial is its fixed value.
_CRC_SQL = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
 lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))))"""

SQL = f"""WITH RECURSIVE
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce('s' || source, '-') AS k, {_leaf_sql('text')} AS leaf,
 {_leaf_sql("replace(text, chr(10), '')")} AS other, coalesce({_CRC_SQL} % 2 = 0, false) AS hit FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY k) AS n FROM d),
up AS (
 SELECT 0 AS lv, k, pos, n, leaf AS h FROM p
 UNION ALL
 SELECT lv + 1, k, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY lv, k, pos // 3, n),
s AS (SELECT k, h AS subroot, row_number() OVER (ORDER BY encode(k)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
 SELECT 0 AS lv, pos, n, subroot AS h FROM s
 UNION ALL
 SELECT lv + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lv, pos // 3, n),
a AS (
 SELECT 0 AS lv, row, k, pos, n, CASE WHEN hit THEN other ELSE leaf END AS h, '' AS proof FROM p
 UNION ALL
 SELECT a.lv + 1, a.row, a.k, a.pos // 3, any_value(up.n + 2) // 3, sha256(string_agg(CASE WHEN up.pos = a.pos THEN a.h ELSE up.h END, '' ORDER BY up.pos)),
  a.proof || coalesce(string_agg(up.h, '' ORDER BY up.pos) FILTER (WHERE up.pos <> a.pos), '')
 FROM a JOIN up ON up.lv = a.lv AND up.k = a.k AND up.pos // 3 = a.pos // 3 WHERE a.n > 1 GROUP BY a.lv, a.row, a.k, a.pos, a.proof),
b AS (
 SELECT 0 AS lv, a.row, a.k, s.pos, s.n, a.h, a.proof FROM a JOIN s USING (k) WHERE a.n = 1
 UNION ALL
 SELECT b.lv + 1, b.row, b.k, b.pos // 3, any_value(top.n + 2) // 3, sha256(string_agg(CASE WHEN top.pos = b.pos THEN b.h ELSE top.h END, '' ORDER BY top.pos)),
  b.proof || coalesce(string_agg(top.h, '' ORDER BY top.pos) FILTER (WHERE top.pos <> b.pos), '')
 FROM b JOIN top ON top.lv = b.lv AND top.pos // 3 = b.pos // 3 WHERE b.n > 1 GROUP BY b.lv, b.row, b.k, b.pos, b.proof)
SELECT p.doc_id, p.leaf, s.subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(b.proof) AS proof_sha256, b.h AS folded_root,
 b.h = (SELECT h FROM top WHERE n = 1) AS verified
FROM p JOIN s USING (k) JOIN b ON b.row = p.row WHERE b.n = 1"""
