"""Byte-level BPE by a sentencepiece model that is serialised from the ranks themselves."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.llm.shipping import with_modules
from climagrid.llm.units import UnitTable, kept, text_slices

#: A byte is written as the character at this code point plus its value.
FIRST_CHARACTER = 0x100
_CHARACTERS = {byte: chr(FIRST_CHARACTER + byte) for byte in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank; the ranks of the file must be 0, 1, 2 and so on."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if not all(tokens):
        raise ValueError(f"{path}: ranks are not contiguous")
    return tokens


def byte_mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_CHARACTERS)


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out + bytes([value]))


def _field(number: int, content: bytes | int) -> bytes:
    """A protocol-buffer field: a varint or a length-delimited string."""
    if isinstance(content, int):
        return _varint(number << 3) + _varint(content)
    return _varint(number << 3 | 2) + _varint(len(content)) + content


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised BPE model whose ids are the ranks.

    Pieces are byte-mapped and scored by the negative rank, so the best merge is the one of the
    lowest rank; the normaliser is the identity. The last id is the unknown piece, which byte-mapped
    text never yields.
    """
    model = bytearray()
    for rank, token in enumerate(tokens):
        piece = _field(1, byte_mapped(token).encode())
        piece += _varint(2 << 3 | 5) + struct.pack("<f", -rank) + _field(3, 1)
        model += _field(1, piece)
    model += _field(1, _field(1, b"<unk>") + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    trainer += b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))  # no <s>, </s>, <pad>
    model += _field(2, trainer)
    model += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(model)


class Codec:
    """Encoder and decoder over one rank file."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(ranks_path)
        self._rank = {token: rank for rank, token in enumerate(self.tokens)}
        self._pieces = sentencepiece.SentencePieceProcessor(
            model_proto=sentencepiece_model(self.tokens)
        )
        self._split = regex.compile(pattern).findall
        self.table = UnitTable(self._encode)

    def _encode(self, units: list[str]) -> Iterator[bytes]:
        split = [[t.encode() for t in self._split(unit)] for unit in units]
        # A pre-token that is itself in the vocabulary is one id, whatever the merges give.
        open_ones = list({t for tokens in split for t in tokens if t not in self._rank})
        ids = self._pieces.encode([byte_mapped(t) for t in open_ones], num_threads=1)
        found = {t: np.asarray(i, "<u4").tobytes() for t, i in zip(open_ones, ids, strict=True)}
        rank = self._rank
        for tokens in split:
            yield b"".join(
                [found[t] if t in found else rank[t].to_bytes(4, "little") for t in tokens]
            )


def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec for each Python worker."""
    return kept(("bpe", ranks_path, pattern), lambda: Codec(ranks_path, pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the text's ``ids`` as an integer array.

    Each match of ``pattern`` is encoded separately and whole texts are encoded, without special
    tokens. A null or empty text has no ids. Rows stay one to one, also with null or repeated
    ``doc_id``; other columns are ignored; an empty table gives no rows. A task holds about 4 MB of
    texts, or one longer text, with their ids.
    """
    kind = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codec(ranks_path, pattern).table
        for batch in batches:
            for part in text_slices(batch, "text"):
                packed = list(table.pack(part.column("text").fill_null("").to_pylist()))
                ends = np.cumsum([0, *map(len, packed)]) // 4
                ids = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], schema=kind)

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return with_modules(chosen).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the bytes they stand for as ``decoded``.

    The inverse mapping by rank. Null ids decode to no bytes; an id outside the vocabulary raises.
    """
    kind = pa.schema(
        [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = np.array(read_ranks(ranks_path), dtype=object)
        for batch in batches:
            column = batch.column("ids")
            bytes_of = [
                b"" if ids is None else b"".join(tokens[np.asarray(ids, np.int64)].tolist())
                for ids in (x.values.to_numpy() if x.is_valid else None for x in column)
            ]
            arrays = [batch.column("doc_id"), column, pa.array(bytes_of, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema=kind)

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id bigint, ids array<int>, decoded binary"
    )
