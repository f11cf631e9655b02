"""SentencePiece encoding and decoding that keeps the place of every piece in its text.

A text is first normalised: at each place the longest prefix that the
model's compiled character map knows is replaced, any other character
stays, and every byte of the outcome records where in the source its
rule began. (A model with an empty map keeps all characters but for
the space mark.) The normalised text is merged into pieces by the library,
set to take it as it is; characters that no piece holds become their
bytes. The lengths of the pieces, summed up and read through the
alignment, give each piece's span in the source bytes. Decoding is the
library's.

A text is normalised and merged a slab at a time. A slab ends where no
piece of the vocabulary spans the cut, so no merge can cross it; what is
held of a text beside its ids and spans is the slab and what it cut off.

Defined cases: a null text counts as empty and has no ids. Repeated rows
give repeated results, rows do not depend on each other. Bytes that are
not UTF-8 become U+FFFD, one each. An empty table gives an empty result.
Other columns of the input are ignored. Control pieces are ordinary text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import table

SPACE = "▁"  # the mark that stands for a space in pieces
SLAB = 1 << 18  # bytes of source normalised at a time

NORMAL, CONTROL, UNKNOWN, BYTE = 1, 3, 2, 6  # kinds of pieces, fixed values of the model format
BPE = 2

def model_path(name: str = "piece_bpe_32k.model") -> str:
    """Path of an installed model."""
    import public_tokenizers

    return public_tokenizers.path(name)


class CharMap:
    """Compiled character map: a double-array trie over source bytes and the replacements its values point to."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.texts = blob[4 + size :]

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest known prefix of data from `at`."""
        units, n = self.units, len(data)
        place, found = self._child(units[0]), None
        for end in range(at, n):
            place ^= data[end]
            unit = units[place]
            if unit & 0x800000FF != data[end]:
                break
            place ^= self._child(unit)
            if unit & 0x100:
                found = units[place] & 0x7FFFFFFF, end + 1 - at
        if found is None:
            return None
        start, length = found
        return self.texts[start : self.texts.index(b"\0", start)], length


def _character(data: bytes, at: int) -> tuple[bytes, int]:
    """The UTF-8 character at a place and its length; U+FFFD and 1 if there is none."""
    lead = data[at]
    n = 1 if lead < 0x80 else 2 if 0xC0 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF8 else 1
    try:
        data[at : at + n].decode()
        return data[at : at + n], n
    except UnicodeDecodeError:
        return b"\xef\xbf\xbd", 1


class Normaliser:
    """Source bytes to normalised text with alignment, by the rules of a model's normaliser."""

    def __init__(self, charmap: bytes, dummy_prefix: bool, remove_extra: bool, escape: bool):
        self.map = CharMap(charmap) if charmap else None
        self.dummy_prefix, self.remove_extra = dummy_prefix, remove_extra
        self.mark = SPACE.encode() if escape else b" "

    def slabs(self, data: bytes, slab: int = SLAB) -> Iterator[tuple[bytes, np.ndarray]]:
        """(normalised bytes, source offset of each) of a text, in order; the last has one offset more, the end.

        Slabs are cut between characters.
        """
        if self.map is None and not self.remove_extra:
            yield from self._plain(data, slab)
        else:
            yield from self._ruled(data, slab)

    def _plain(self, data: bytes, slab: int) -> Iterator[tuple[bytes, np.ndarray]]:
        """Without rules every character is its own; only spaces are marked."""
        try:
            data.decode()
        except UnicodeDecodeError:
            yield from self._ruled(data, slab)
            return
        at, head = 0, self.mark if self.dummy_prefix and data else b""
        while True:
            end = min(len(data), at + slab)
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end += 1
            part = data[at:end]
            width = np.where(np.frombuffer(part, np.uint8) == 0x20, len(self.mark), 1)
            offsets = [np.full(len(head), at), np.repeat(np.arange(at, end), width), np.full(int(end == len(data)), end)]
            yield head + part.replace(b" ", self.mark), np.concatenate(offsets)
            if end == len(data):
                return
            at, head = end, b""

    def _rules(self, data: bytes) -> Iterator[tuple[bytes, int, int]]:
        """(replacement, source offset, source length) from place to place."""
        at = 0
        while at < len(data):
            text, n = (self.map and self.map.longest(data, at)) or _character(data, at)
            yield text, at, n
            at += n

    def _ruled(self, data: bytes, slab: int) -> Iterator[tuple[bytes, np.ndarray]]:
        out, offsets, began = bytearray(), [], False
        after_space, end = self.remove_extra, 0
        for text, at, n in self._rules(data):
            if not began:
                if self.remove_extra and text == b" ":
                    continue
                began = True
                if self.dummy_prefix:
                    out += self.mark
                    offsets += [at] * len(self.mark)
            if after_space:
                text = text.lstrip(b" ")
            end = at + n
            if text:
                after_space = self.remove_extra and text.endswith(b" ")
                text = text.replace(b" ", self.mark)
                out += text
                offsets += [at] * len(text)
            if len(out) >= slab and not (self.remove_extra and out.endswith(self.mark)):
                yield bytes(out), np.array(offsets, np.int64)
                out, offsets = bytearray(), []
        while self.remove_extra and out.endswith(self.mark):
            keep = len(out) - len(self.mark)
            end = offsets[keep]
            del out[keep:], offsets[keep:]
        yield bytes(out), np.array([*offsets, end], np.int64)


class Encoder:
    """A model's pieces and normaliser. `encode` gives ids and spans of a text."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != BPE or not model.trainer_spec.byte_fallback or not kinds <= {NORMAL, CONTROL, UNKNOWN, BYTE}:
            raise ValueError("only BPE models with byte fallback and without user-defined or unused pieces are supported")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that put the space mark behind words are not supported")
        spec = model.normalizer_spec
        self.normaliser = Normaliser(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        #: Bytes of normalised text that an id stands for; of an id for a byte, that byte.
        self.lengths = np.array([len(p.piece.encode()) if p.type == NORMAL else 0 for p in model.pieces], np.int64)
        self.byte_of = np.array([int(p.piece[3:5], 16) if p.type == BYTE else -1 for p in model.pieces], np.int64)
        #: Neighbouring characters that some piece holds: only between these can a merge take place.
        self.joins = {p.piece[i : i + 2] for p in model.pieces if p.type == NORMAL for i in range(len(p.piece) - 1)}
        spec.precompiled_charsmap = b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.merge = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString()).encode

    def _last_cut(self, text: str) -> int:
        """The last place in a text that no merge can cross; 0 if there is none."""
        return next((i for i in range(len(text) - 1, 0, -1) if text[i - 1 : i + 1] not in self.joins), 0)

    def _pieces(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """ids of a part of the normalised text and the bytes of it that each stands for.

        Of the bytes of one character the last stands for all of them.
        """
        ids = np.asarray(self.merge(text, return_type="numpy"), np.int32)
        lengths, byte = self.lengths[ids], self.byte_of[ids]
        first = np.flatnonzero((byte >= 0) & (byte & 0xC0 != 0x80))
        size = 1 + (byte[first] >= 0xC0) + (byte[first] >= 0xE0) + (byte[first] >= 0xF0)
        lengths[first + size - 1] = size
        return ids, lengths

    def encode(self, data: bytes, slab: int = SLAB) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, begins and ends of the pieces of a text; spans are in bytes of `data`."""
        ids, begins, ends = [], [], []
        rest, rest_at = "", np.empty(0, np.int64)
        slabs = self.normaliser.slabs(data, slab)
        got = next(slabs, None)
        while got is not None:
            ahead = next(slabs, None)
            text, offsets = rest + got[0].decode(), np.concatenate([rest_at, got[1]])
            if ahead is not None:  # what follows the last cut may go on
                cut = self._last_cut(text)
                text, rest = text[:cut], text[cut:]
                rest_at = offsets[len(offsets) - len(rest.encode()) :]
            own, lengths = self._pieces(text)
            stops = np.cumsum(lengths)
            ids.append(own)
            begins.append(offsets[stops - lengths])
            ends.append(offsets[stops])
            got = ahead
        return np.concatenate(ids), np.concatenate(begins), np.concatenate(ends)


def encode(docs: DataFrame, model: str, slab: int = SLAB) -> DataFrame:
    """One row per document: doc_id, ids, and begins and ends, the pieces' spans in the bytes of its text."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = [encoder.encode(x.as_buffer().to_pybytes(), slab) for x in part.column(1)]
                stops = pa.array(np.cumsum([0, *[len(r[0]) for r in rows]]), pa.int32())
                lists = [pa.ListArray.from_arrays(stops, pa.array(np.concatenate(c), pa.int32())) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], ["doc_id", "ids", "begins", "ends"])

    return base.mapInArrow(run, "doc_id long, ids array<int>, begins array<int>, ends array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and `decoded`, the text that the column `ids` stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                flat, stops = part.column(1).values.to_numpy(), part.column(1).offsets.to_pylist()
                texts = [processor.decode(flat[i:j].tolist()) if i < j else "" for i, j in zip(stops, stops[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of `decode`'s rows."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def q_pieces(spark, sf_dir):
    model = model_path()
    return digests(decode(encode(table(spark, sf_dir, "documents"), model), model))
