"""Byte-level BPE encoding and decoding through a sentencepiece model made from the vocabulary.

The ranks file is turned into a serialised sentencepiece BPE model, nothing is
trained: one piece for each rank, its bytes mapped to 256 printable characters,
its score the negative rank, normalisation off.  Highest score first is then
lowest rank first, so sentencepiece merges as the ranks do.  A text is split by
the vocabulary's pattern and every match is encoded separately; decoding maps an
id's piece back to bytes.

Scale: a map over the scan without a shuffle.  The model (about 1 MB, the size
of the vocabulary) is broadcast; each worker keeps a cache of bounded size from
pre-token to ids, and long texts are taken in pieces of bounded size.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartograph.llm.common import free_name, text_or_empty

CACHE = 400_000  # pre-tokens that a worker remembers at most
AT_ONCE = 1 << 18  # pre-tokens of a long text that are held at once
UNKNOWN = "⁇"  # a piece that the mapped bytes cannot spell


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else from U+0100 on, in order."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in keep else next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The token of each rank, in order; a ranks file without gaps is asked for."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: the ranks have gaps")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """A protocol buffer field: int as varint, float as 32 bits, bytes with their length."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece model whose id of a piece is its rank; the unknown piece comes last."""
    character = byte_characters()
    # Fixed values of the model format: ModelProto has pieces 1, trainer_spec 2, normalizer_spec 3;
    # a piece has text 1, score 2, type 3 (1 normal, 2 unknown); the trainer has model_type 3 (2: BPE);
    # the normalizer has name 1, add_dummy_prefix 3, remove_extra_whitespaces 4, escape_whitespaces 5.
    out = [_field(1, _field(1, "".join(character[b] for b in token).encode()) + _field(2, -float(rank)) + _field(3, 1))
           for rank, token in enumerate(tokens)]
    out.append(_field(1, _field(1, UNKNOWN.encode()) + _field(2, -float(len(tokens))) + _field(3, 2)))
    out.append(_field(2, _field(3, 2)))
    out.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(out)


class _Known(dict):
    """Pre-token to ids, learnt when asked for; of two generations the older one is forgotten."""

    def __init__(self, learn):
        super().__init__()
        self.learn, self.older = learn, {}

    def __missing__(self, match: str) -> bytes:
        if len(self) >= CACHE // 2:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(match)
        if ids is None:
            ids = self.learn(match)
        self[match] = ids
        return ids


class Codec:
    """A worker's encoder and decoder over a serialised model."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern)
        character = byte_characters()
        self.mapped = dict(enumerate(character))
        byte = {c: b for b, c in enumerate(character)}
        n = self.model.get_piece_size() - 1
        self.token = [bytes(byte[c] for c in self.model.id_to_piece(i)) for i in range(n)]
        # A token whose merges don't lead to it is still its own id when a whole match spells it.
        alone = self.model.encode([self.model.id_to_piece(i) for i in range(n)], num_threads=1)
        self.whole = {self.token[i]: [i] for i, ids in enumerate(alone) if ids != [i]}
        self.known = _Known(self._learn)

    def _learn(self, match: str) -> bytes:
        spelled = match.encode()
        ids = self.whole.get(spelled) or self.model.encode(spelled.decode("latin-1").translate(self.mapped))
        return array("i", ids).tobytes()

    def _ids(self, matches: list[str]) -> bytes:
        return b"".join(map(self.known.__getitem__, matches))

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit integers."""
        if len(text) <= AT_ONCE:
            return self._ids(self.find.findall(text))
        found, out = (m[0] for m in self.find.finditer(text)), []
        while some := list(islice(found, AT_ONCE)):
            out.append(self._ids(some))
        return b"".join(out)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _with_column(df: DataFrame, name: str, kind: T.DataType, make) -> DataFrame:
    """``df`` and a column that ``make`` gives for each slice of rows."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 512):
            made = make(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``ids_col``: the token ids of the whole text, array<int>.

    Defined cases: a null or empty text has no ids; text that spells a special
    token is ordinary text; a column already called ``ids_col`` is replaced;
    null or repeated ids, repeated rows and extra columns are carried as they
    are; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(serialise(read_ranks(path)))
    rest = [F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns) if c.lower() != ids_col.lower()]
    text = free_name(docs, "_llm_text")

    def make(batch: pa.RecordBatch) -> pa.Array:
        codec = _codec(model.value, pattern)
        found = [codec.encode(t) for t in batch.column(text).to_pylist()]
        ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(found), dtype=np.int32)))

    marked = docs.select(*rest, text_or_empty(F.col(f"`{text_col}`")).alias(text))
    return _with_column(marked, ids_col, T.ArrayType(T.IntegerType()), make).drop(text)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``bytes_col``: the bytes that its ids spell (binary; null ids spell nothing)."""
    model = encoded.sparkSession.sparkContext.broadcast(serialise(read_ranks(path)))

    def make(batch: pa.RecordBatch) -> pa.Array:
        codec = _codec(model.value, pattern)
        return pa.array([codec.decode(x.as_py() or ()) for x in batch.column(ids_col)], pa.binary())  # one text's ids as objects at a time

    rest = encoded.select(*[F.col(f"`{c}`") for c in encoded.columns if c.lower() != bytes_col.lower()])
    return _with_column(rest, bytes_col, T.BinaryType(), make)


def ids_digest(ids_col: str = "ids"):
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), " "), 256)
