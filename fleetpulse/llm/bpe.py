"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text longer than a chunk is cut into chunks that overlap. Each chunk is
pre-tokenised on its own, in parallel, and its match starts inside the
two overlaps are noted. From a match start on, pre-tokenising depends
only on the text ahead, so where two neighbouring chunks have a match
start in common they agree from there on: the text is cut at the first
such place and the pieces are encoded independently. A neighbour that
never falls into step leaves one longer piece, encoded whole. Decoding
concatenates the raw bytes of the ids.

Defined cases: a null text counts as empty and has no ids. Repeated rows
give repeated results. An empty table gives an empty result. Other
columns of the input are ignored. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import table, text_column

CHUNK = 32_768  # characters per chunk
OVERLAP = 512  # characters that a chunk shares with the next one
MARGIN = 8  # more than any look-ahead of the pattern beside runs of one class
BLANKS = 4096  # the library's own pre-tokeniser fails on runs of white space that are some hundred times as long


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """(path, pattern) of an installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def chunk_boundaries(pattern, part: str, head: int, tail: int, last: bool) -> tuple[list[int], list[int]]:
    """Match starts of a chunk's scan inside its first `head` characters and from `tail` on.

    What the chunk's end cuts off can change a match that begins a few
    characters before it, so starts there don't count, but in the last chunk.
    Nor do starts after white space: the pattern looks ahead from a run of
    it, so a piece that ended there would match otherwise.
    """
    end = len(part) if last else len(part) - MARGIN
    first, rest = [], []
    for m in pattern.finditer(part):
        s = m.start()
        if s and part[s - 1].isspace():
            continue
        if s < head:
            first.append(s)
        if tail <= s < end:
            rest.append(s)
    return first, rest


def stitch(chunks: list[tuple[int, list[int], list[int]]], n_chars: int) -> list[tuple[int, int]]:
    """Pieces [start, end) of a text from its chunks' (start, head starts, tail starts).

    A chunk's scan is known to be right from a cut on. A chunk without a
    common start adds to the piece before it, and so do all after it: what
    is right there is not known without a scan.
    """
    cuts = [0]
    for (_, _, tail), (_, head, _) in zip(chunks, chunks[1:], strict=False):
        common = sorted(set(tail) & set(head))
        if not common:
            break
        cuts.append(common[0])
    return list(zip(cuts, [*cuts[1:], n_chars], strict=True))


def _encoder(ranks_path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={})


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds `data`, the raw bytes of the column `ids`; other columns stay."""
    schema = encoded.select(*[c for c in encoded.columns if c != "data"]).schema.add("data", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = {i: b for b, i in load_ranks(ranks_path).items()}
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                data = [None if x is None else b"".join(map(by_id.__getitem__, x)) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], [*part.schema.names, "data"])

    return encoded.select(*schema.names[:-1]).mapInArrow(run, schema)


def _ids(enc, found, blanks, text: str) -> list[int]:
    """ids of a text: by the library as a whole, or, with a long run of white space, match by match."""
    if blanks.search(text) is None:
        return enc.encode_ordinary(text)
    return [i for m in found.finditer(text) for i in enc._encode_single_piece(m.group())]


def _encode_rows(ranks_path: str, pattern: str, with_bytes: bool):
    """Worker for rows whose last column is the text: it becomes `ids`, and `data` after it if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(ranks_path, pattern)
        found, blanks = regex.compile(pattern), regex.compile(rf"\s{{{BLANKS}}}")
        for b in batches:
            names = [*b.schema.names[:-1], "ids", *["data"] * with_bytes]
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids, data = [], []
                for t in part.columns[-1]:
                    x = _ids(enc, found, blanks, t.as_py())
                    ids.append(pa.array(x, pa.int32()))
                    if with_bytes:
                        data.append(enc.decode_bytes(x))
                ends = [0]
                for x in ids:
                    ends.append(ends[-1] + len(x))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(ids))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, *[pa.array(data, pa.binary())] * with_bytes], names)

    return run


def _long_ids(texts: DataFrame, ranks_path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(doc_id, ids) of rows (key, doc_id, text) by overlapping chunks; rows with one key are the same row repeated."""

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                key, text = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                for at in range(0, len(text), chunk):
                    last = at + chunk >= len(text)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([at], pa.int64()), pa.array([last]), pa.array([text[at : at + chunk + overlap]])],
                        ["key", "at", "last", "part"],
                    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = regex.compile(pattern)
        kind = pa.list_(pa.int64())
        for b in batches:
            heads, tails = [], []
            for at, last, part in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                head, tail = chunk_boundaries(found, part.as_py(), overlap if at else 0, chunk, last)
                heads.append([at + s for s in head])
                tails.append([at + s for s in tail])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(heads, kind), pa.array(tails, kind)], ["key", "at", "head", "tail"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                key, doc, bounds, text = (c[i].as_py() for c in b.columns)
                chunks = {x["at"]: (x["at"], x["head"], x["tail"]) for x in bounds}
                for k, (lo, hi) in enumerate(stitch([chunks[at] for at in sorted(chunks)], len(text))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([doc], pa.int64()), pa.array([k], pa.int32()), pa.array([text[lo:hi]])],
                        ["key", "doc_id", "piece", "text"],
                    )

    bounds = (
        texts.select("key", "text")
        .mapInArrow(slices, "key string, at long, last boolean, part string")
        .repartition("key", "at")
        .mapInArrow(scanned, "key string, at long, head array<long>, tail array<long>")
        .groupBy("key")
        .agg(F.collect_list(F.struct("at", "head", "tail")).alias("bounds"))
    )
    return (
        texts.join(bounds, "key")
        .select("key", "doc_id", "bounds", "text")
        .mapInArrow(cut, "key string, doc_id long, piece int, text string")
        .repartition("key", "piece")
        .mapInArrow(_encode_rows(ranks_path, pattern, False), "key string, doc_id long, piece int, ids array<int>")
        .groupBy("key")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.array_distinct(F.array_sort(F.collect_list(F.struct("piece", "ids")))).alias("p"),
            F.count(F.when(F.col("piece") == 0, 1)).cast("int").alias("rows"),
        )
        .select("doc_id", F.flatten("p.ids").alias("ids"), F.explode(F.array_repeat(F.lit(0), F.col("rows"))))
        .select("doc_id", "ids")
    )


def encode(docs: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, ids, and data, the bytes that the ids decode to.

    A document's ids are gathered in one row, as its text was.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    n = F.char_length("text")
    short = base.filter(n <= chunk).mapInArrow(_encode_rows(ranks_path, pattern, True), "doc_id long, ids array<int>, data binary")
    texts = base.filter(n > chunk).select(F.sha2(F.concat_ws(" ", F.col("doc_id").cast("string"), "text"), 256).alias("key"), "doc_id", "text")
    return short.unionByName(decode(_long_ids(texts, ranks_path, pattern, chunk, overlap), ranks_path))


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of `encode`'s rows."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def q_byte_bpe(spark, sf_dir):
    return digests(encode(table(spark, sf_dir, "documents"), *vocabulary()))
