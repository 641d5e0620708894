"""Documents cut at drawn character positions and rearranged for filling in the middle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.llm.shipping import with_modules
from climagrid.llm.units import text_slices

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
#: Percent of the documents that are rearranged, and percent of those whose suffix comes first.
RATE, SUFFIX_FIRST = 90, 20

SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string())]
    + [("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)

_LOW = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)


def _bits(count: int) -> np.uint64:
    return np.uint64(count)


class CharacterIndex:
    """Rank and select of characters in a buffer of UTF-8, eight bytes at a time.

    ``marks`` has the lowest bit of each byte set that ends a character: one that no continuation
    byte (``10xxxxxx``) follows. The buffer is cut at character boundaries by its texts, so one index
    serves all texts that lie in it.
    """

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        padded = np.zeros((self.size + 7) // 8 * 8 + 8, np.uint8)
        padded[: self.size] = data
        words = padded.view("<u8")
        starts = ~(words >> _bits(7) & ~(words >> _bits(6))) & _LOW
        ends = starts[:-1] >> _bits(8) | (starts[1:] & _bits(1)) << _bits(56)
        if spare := -self.size % 8:  # the zeros after the last byte are no characters
            ends[-1] &= np.uint64((1 << 64 - 8 * spare) - 1)
        self._marks = ends
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(ends), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many characters end before byte ``at``."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        inside = np.append(self._marks, np.uint64(0))[word] & ((_bits(1) << _bits(8) * byte) - _bits(1))
        return self._before[word] + np.bitwise_count(inside)

    def select(self, count: np.ndarray) -> np.ndarray:
        """The byte after which ``count`` characters have ended (0 for none)."""
        word = np.maximum(np.searchsorted(self._before, count) - 1, 0)
        wanted = (count - self._before[word]).astype(np.uint64)
        if not len(self._marks):
            return np.zeros(len(count), np.int64)
        upto = self._marks[np.minimum(word, len(self._marks) - 1)] * _LOW  # per byte: ends up to it
        reached = (upto | _HIGH) - wanted * _LOW & _HIGH  # bytes by which the wanted one has ended
        inside = 9 - np.bitwise_count(reached).astype(np.int64)
        return np.where(count > 0, 8 * word + inside, 0)


def cut_points(texts: pa.StringArray, first: np.ndarray, second: np.ndarray):
    """Per text its number of characters, both cuts in characters and the three byte positions.

    The cuts are the draws modulo the number of possible cuts, the smaller one first. Positions are
    those of the texts' bytes, which come back too.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    index = CharacterIndex(data)
    before = index.rank(offsets)
    n = np.diff(before)
    one, two = first % (n + 1), second % (n + 1)
    one, two = np.minimum(one, two), np.maximum(one, two)
    at = [np.where(c > 0, index.select(before[:-1] + c), offsets[:-1]) for c in (one, two)]
    return data, n, one, two, offsets, at


def _arrange(batches: Iterator[pa.RecordBatch], rate: int, suffix_first: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            texts = part.column("text").fill_null("")
            draws = [part.column(f"h{i}").to_numpy() for i in range(1, 5)]
            data, n, one, two, offsets, (cut, resume) = cut_points(texts, *draws[:2])
            raw = data.tobytes()
            marked = [pa.compute.match_substring(texts, m).to_numpy(zero_copy_only=False) for m in MARKERS]
            plain = (n == 0) | np.logical_or.reduce(marked) | (draws[2] % 100 >= rate)
            forms = np.where(plain, "plain", np.where(draws[3] % 100 < suffix_first, "spm", "psm"))
            p, s, m = (x.encode() for x in MARKERS)
            outputs = []
            for form, a, b, c, d in zip(
                forms.tolist(), offsets[:-1].tolist(), cut.tolist(), resume.tolist(), offsets[1:].tolist(), strict=True
            ):
                if form == "plain":
                    outputs.append(raw[a:d])
                elif form == "psm":
                    outputs.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
                else:
                    outputs.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
            arrays = [
                part.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array(forms),
                pa.array(one, pa.int64(), mask=plain),
                pa.array(two - one, pa.int64(), mask=plain),
                pa.array(outputs, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def _draw(seed: int, number: int) -> Column:
    """The 32-bit draw of this number (from 1), which the document's id and the seed decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("bigint").alias(f"h{number}")


def fill_in_middle(
    docs: DataFrame, seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """Per document ``doc_id, n, form, prefix_chars, middle_chars, output``: its text rearranged.

    Two cuts are drawn from the seed and ``doc_id`` alone, so a run again gives the same output. They
    cut the text into prefix, middle and suffix, counted in code points, of which it has ``n``. ``form``
    is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain`` (the text as it
    is): for empty texts, for those that hold a marker themselves, and for all but ``rate`` percent.

    The bytes of a batch are viewed as 64-bit words; bytes that end a character are marked and counted
    a word at a time, and a cut is found by a search of the running counts and a selection inside the
    word. Nothing is shuffled. A task holds about 4 MB of texts at a time; one longer text alone.

    A null text is empty, its form ``plain`` and its output empty. A null ``doc_id`` draws as the empty
    string does; rows that repeat a ``doc_id`` have the same draws, each for its own text. Other columns
    are ignored. An empty table gives no rows.
    """
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    drawn = chosen.select("doc_id", "text", *[_draw(seed, i) for i in range(1, 5)])
    return with_modules(drawn).mapInArrow(lambda batches: _arrange(batches, rate, suffix_first), SCHEMA)


def restore(arranged: DataFrame) -> DataFrame:
    """``arranged`` with the ``restored`` text, rebuilt from ``output`` and ``form`` alone.

    No piece holds a marker, so the three markers of an output are its only ones. A null output or form
    restores to null.
    """
    pieces = F.split("output", "|".join(MARKERS))  # what stands before the first marker is empty
    text = F.when(F.col("form") == "psm", F.concat(*[F.get(pieces, i) for i in (1, 3, 2)]))
    text = text.when(F.col("form") == "spm", F.concat(*[F.get(pieces, i) for i in (2, 3, 1)]))
    return arranged.withColumn("restored", text.when(F.col("form") == "plain", F.col("output")))
