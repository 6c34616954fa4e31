"""SentencePiece encoding with byte offsets, and decoding.

Text is normalised by longest prefixes through the model's compiled character
map (a double-array trie over UTF-8, with the replacements behind it), and
every normalised byte keeps the place of the source byte it came from. The
normalised text falls into words that start with the model's space mark; no
piece of a supported model crosses into the next word, so each different word
is segmented once per task, by the library on the model with its normaliser
switched off. A piece's source span follows from the lengths of the pieces
before it and the alignment.

Supported: models with byte fallback, space marks and a dummy prefix, and no
piece with a mark behind another character; others raise ``ValueError``.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, texts_of

SPACE = "▁"
_MARK = SPACE.encode()
#: Different words whose segmentation a task remembers; then it starts over.
CACHE_WORDS = 400_000


# ------------------------------------------------------------- the model
def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield tag >> 3, message[at : at + size]
        at += size


class CharacterMap:
    """A compiled character map: 4 bytes of trie size, the trie's units, and
    the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.replacements = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``data[at:]``, and its replacement."""
        units, found = self.units, None
        if not units:
            return None
        node = units[0] >> 10 << ((units[0] & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= unit >> 10 << ((unit & 512) >> 6)
            if unit & 256:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.replacements.index(0, found[1])
        return found[0], self.replacements[found[1] : end]


class PieceModel:
    def __init__(self, proto: bytes) -> None:
        self.prefix, self.squeeze, escape, blob = True, True, True, b""
        for field, value in _fields(proto):
            if field == 3:
                for inner, v in _fields(value):
                    if inner == 2:
                        blob = v
                    elif inner in (3, 4, 5):
                        self.prefix, self.squeeze, escape = (bool(v) if inner == k else old for k, old in ((3, self.prefix), (4, self.squeeze), (5, escape)))
        self.map = CharacterMap(blob)
        # a later normaliser message overrides single fields: no map, a prefix, spaces as they are
        plain = b"\x0a\x08identity\x12\x00\x18\x01\x20\x00\x28\x01"
        self.words = sentencepiece.SentencePieceProcessor(model_proto=proto + b"\x1a" + bytes([len(plain)]) + plain)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = self.words.get_piece_size()
        pieces = [self.words.id_to_piece(i) for i in range(n)]
        fallback = [self.words.is_byte(i) for i in range(n)]
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p, b in zip(pieces, fallback) if not b)
        if crossing or not any(fallback) or not self.prefix or not escape:
            raise ValueError("unsupported model: see the module's docstring")
        self.size = np.array([1 if b else len(p.encode()) for p, b in zip(pieces, fallback)], np.int64)
        self.known: dict[str, int] = {}
        self.flat, self.begin, self.count = (np.zeros(0, np.int64) for _ in range(3))

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text and, for each of its bytes and its end, the source
        byte where what it came from begins."""
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            data = np.frombuffer(text.encode(), np.uint8)
            wide = np.where(data == 32, len(_MARK), 1)
            at = np.concatenate([np.zeros(len(_MARK), np.int64), np.repeat(np.arange(len(data)), wide), [len(data)]])
            return SPACE + text.replace(" ", SPACE), at
        data, at = text.encode(), 0
        parts: list[tuple[bytes, int]] = []
        while at < len(data):
            mapped = self.map.longest(data, at)
            if mapped is None:
                first = data[at]
                mapped = (n := 1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4, data[at : at + n])
            parts.append((mapped[1], at))
            at += mapped[0]
        if self.squeeze:
            while parts and parts[0][0] in (b" ", b""):
                parts.pop(0)
        out, source = bytearray(), []
        begin = parts[0][1] if parts else 0
        end = len(data)
        if parts:
            out += _MARK
            source += [begin] * len(_MARK)
        gap = self.squeeze
        for piece, where in parts:
            if gap:
                piece = piece.lstrip(b" ")
            if piece:
                gap = self.squeeze and piece.endswith(b" ")
                piece = piece.replace(b" ", _MARK)
                out += piece
                source += [where] * len(piece)
        if self.squeeze:
            while out.endswith(_MARK) and out:
                end = source[-len(_MARK)]
                del out[-len(_MARK) :], source[-len(_MARK) :]
        return out.decode(), np.array([*source, end], np.int64)

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """Each word's number; words not yet known are segmented in one call."""
        if len(self.known) > CACHE_WORDS:
            self.known, self.flat, self.begin, self.count = {}, *(np.zeros(0, np.int64) for _ in range(3))
        new = [w for w in words if w not in self.known]
        if new:
            # the library puts a mark before any text but an empty one
            made = self.words.encode([w[len(_MARK) :].decode() for w in new], num_threads=1)
            made = [ids or [self.words.piece_to_id(SPACE)] for ids in made]
            count = np.fromiter(map(len, made), np.int64, len(made))
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(made), np.int64, int(count.sum()))])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All texts' ids, their source byte spans (begins, ends), and where
        each text's ids start (one more entry than texts)."""
        plain = [self.normalize(t) for t in texts]
        data = "".join(t for t, _ in plain).encode()
        sizes = np.array([len(at) - 1 for _, at in plain], np.int64)
        text_at = np.concatenate([[0], np.cumsum(sizes)])
        if not data:
            none = np.zeros(0, np.int32)
            return none, none, none, np.zeros(len(texts) + 1, np.int64)
        u = np.frombuffer(data, np.uint8)
        mark = np.zeros(len(u) + len(_MARK), bool)
        mark[len(_MARK) : -2] = (u[:-2] == _MARK[0]) & (u[1:-1] == _MARK[1]) & (u[2:] == _MARK[2])
        head = mark[len(_MARK) :] & ~mark[: -len(_MARK)]      # marks that no mark precedes
        head[text_at[:-1][sizes > 0]] = True
        edges = np.concatenate([np.flatnonzero(head), [len(u)]]).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()
        w = self._learn(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        count = self.count[w]
        begin = np.cumsum(count) - count
        ids = self.flat[np.repeat(self.begin[w] - begin, count) + np.arange(int(count.sum()))]
        ends = np.cumsum(self.size[ids])
        if int(ends[-1]) != len(u):
            raise ValueError("pieces do not cover the normalised text")
        starts = ends - self.size[ids]
        firsts = np.searchsorted(starts, text_at)             # pieces never cross from text to text
        extra = np.repeat(np.arange(len(texts)), np.diff(firsts))    # a text's alignment has one entry more than bytes
        at = np.concatenate([a for _, a in plain]).astype(np.int32)
        return ids.astype(np.int32), at[starts + extra], at[ends + extra], firsts

    def decode(self, ids: list[int]) -> str:
        return self.whole.decode(ids)


# ----------------------------------------------------------- on DataFrames
def _model(shared):
    """The task's model; the broadcast holds the model file's bytes."""
    return PieceModel(shared.value)


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


#: A model file is read on the driver and broadcast; larger ones are refused.
MODEL_BYTES = 64 << 20


def encode(docs: DataFrame, proto: bytes, doc_id: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``(doc_id, ids, begins, ends[, decoded])`` per row: piece ids, and each
    piece's byte span in the text's UTF-8. Null and empty texts have no ids."""
    if len(proto) > MODEL_BYTES:
        raise ValueError(f"model of {len(proto)} bytes; the bound is {MODEL_BYTES}")
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = src.drop("text").schema
    for name in ("ids", "begins", "ends"):
        schema = schema.add(name, T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add("decoded", "string")
    shared = docs.sparkSession.sparkContext.broadcast(proto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                *made, firsts = model.encode(texts_of(part, "text"))
                cols = [pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(x)) for x in made]
                if decoded:
                    cols.append(pa.array([model.decode(x) for x in cols[0].to_pylist()], pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=["doc_id", "ids", "begins", "ends", "decoded"][: len(cols) + 1])

    return src.mapInArrow(run, schema)


def decode(encoded: DataFrame, proto: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give a null text. ``out``
    must not be a column yet."""
    if out in encoded.columns:
        raise ValueError(f"{out} is a column already")
    shared = encoded.sparkSession.sparkContext.broadcast(proto)
    schema = encoded.schema
    schema = type(schema)(list(schema.fields)).add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in batches:
            texts = [None if x is None else model.decode(x) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return encoded.mapInArrow(run, schema)
