"""Documents packed into token sequences by best-fit decreasing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.llm.shipping import with_modules
from climagrid.llm.units import ByteLevel, UnitMemo, kept, packed, text_slices

WINDOW = 1024
#: Remainders packed together by one task: at most so many windows of ids are held in memory.
BLOCK = 16_384
#: Units in a worker's table before a new one takes over what is still used: bounds memory, not results.
TABLE_ENTRIES = 400_000

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    + [(name, pa.int64()) for name in ("doc_tokens", "sequence_id", "offset")]
)

class _Table:
    """A vocabulary's table, which is renewed when it is full."""

    def __init__(self, path: str):
        vocabulary = ByteLevel(path)
        self.units = UnitMemo(lambda unit: packed(vocabulary.ids_of_unit(unit)))

    def renewed(self) -> UnitMemo:
        self.units = self.units.renewed(TABLE_ENTRIES)
        return self.units


def _unit_table(path: str) -> UnitMemo:
    """One table for each Python worker: tasks of the worker share it."""
    return kept(("packing", path), lambda: _Table(path)).renewed()


class OpenWindows:
    """Open windows in a segment tree indexed by remaining capacity."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._at: dict[int, list[int]] = {}

    def _add(self, room: int, change: int) -> None:
        node = room + self._leaves
        while node:
            self._count[node] += change
            node >>= 1

    def put(self, window: int, room: int) -> None:
        if room:
            self._at.setdefault(room, []).append(window)
            self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The tightest open window with room for ``need``, as (window, its room)."""
        node = need + self._leaves
        if not self._count[node]:
            while node > 1 and (node & 1 or not self._count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node *= 2
                if not self._count[node]:
                    node += 1
        room = node - self._leaves
        self._add(room, -1)
        return self._at[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(window, offset) for each length; longest first, ties in the given order."""
    open_windows, placed, windows = OpenWindows(capacity), [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = open_windows.take(lengths[i])
        if found is None:
            found = windows, capacity
            windows += 1
        window, room = found
        placed[i] = window, capacity - room
        open_windows.put(window, room - lengths[i])
    return placed


def _pack(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int, block: int):
    end = np.asarray([end_id], dtype="<u4").tobytes()
    numbers = iter(range(TaskContext.get().partitionId() << 40, 1 << 63))
    rows: list[tuple] = []
    rest: list[tuple] = []

    def emit() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)],
            schema=_ARROW,
        )
        rows.clear()
        return out

    def close() -> None:
        windows: dict[int, int] = {}
        placed = best_fit_decreasing([r[2] for r in rest], window)
        for row, (k, offset) in zip(rest, placed, strict=True):
            if k not in windows:
                windows[k] = next(numbers)
            rows.append((*row, windows[k], offset))
        rest.clear()

    for batch in batches:
        for part in text_slices(batch, "text"):
            texts = part.column("text").fill_null("").to_pylist()
            table = _unit_table(path)
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), table.pack(texts), strict=True):
                ids += end
                tokens = len(ids) // 4
                for start in range(0, tokens - tokens % window, window):
                    cut = ids[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, window, cut, tokens, next(numbers), 0))
                if left := tokens % window:
                    rest.append((doc_id, tokens - left, left, ids[4 * (tokens - left) :], tokens))
                if len(rest) >= block:
                    close()
                if len(rows) >= 4096:
                    yield emit()
    close()
    if rows:
        yield emit()


def pack_documents(
    docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = 0, block: int = BLOCK
) -> DataFrame:
    """Token pieces of all documents with their place in sequences of at most ``window`` tokens.

    A document's ids end with ``end_id``. Full windows are cut first and fill a sequence each; what
    remains is packed within its partition, ``block`` remainders at a time: longest first, each into
    the open window with the least sufficient room. Nothing is shuffled. ``ids`` holds the piece as
    packed little-endian unsigned 32-bit integers.

    A null or empty text is one piece of the end id. Each row is a document of its own, also with a
    null or repeated ``doc_id``. Columns other than ``doc_id`` and ``text`` are ignored. An empty
    table gives no rows. A task holds about 4 MB of texts, or one longer text with all its ids, and the
    ids of the remainders of one block.
    """
    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return with_modules(chosen).mapInArrow(
        lambda batches: _pack(batches, tokenizer_path, window, end_id, block), SCHEMA
    )
