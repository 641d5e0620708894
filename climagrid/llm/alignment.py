"""Two tokenizers' ids aligned by the bytes they cover, and how many documents hold each id pair."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.llm.shipping import with_modules
from climagrid.llm.units import KEPT_CHARS, WHITE_SPACE, ByteLevel, ids_of_units, text_slices
from climagrid.operators.joins import lookup_join
from climagrid.sources.scratch import materialize

#: What sentencepiece writes for a space (fixed value).
PIECE_SPACE = "▁"
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")

#: A block's documents share bitmaps: so many at most, and so many of their id pairs, are held at a time.
BLOCK_DOCS = 1 << 16
BLOCK_PAIRS = 1 << 19
#: Bytes of text aligned at a time, and units in a worker's table before a new one takes over what is still
#: used of it: they bound memory, not results.
SLICE, TABLE_ENTRIES = 1 << 20, 100_000
#: Bytes that a task's writer holds before it writes them: rows of groups and bitmaps are wide.
ROW_GROUP = 16 << 20
#: Posting rows of one pair that a task may get.
PAIR_ROWS = 1 << 14
#: Bits of an id of B in a pair, and of one of A above them.
SHIFT, A_BITS = 18, 19

ALIGNED = (
    "block bigint, ordinal int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups string, pair bigint, plane int, docs bigint, links bigint, places binary, bits binary"
)
_ALIGNED = pa.schema(
    [("block", pa.int64()), ("ordinal", pa.int32()), ("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups", pa.string()), ("pair", pa.int64()), ("plane", pa.int32())]
    + [("docs", pa.int64()), ("links", pa.int64()), ("places", pa.binary()), ("bits", pa.binary())]
)


class Side:
    """A tokenizer: the ids of many texts, the bytes of each id, and the white space before which it may
    not cut."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], entries: list[bytes], joined: str):
        self.encode, self.entries, self.joined = encode, entries, joined
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self._written: dict[str, np.ndarray] = {}

    def spells(self, ids: list[list[int]], raw: list[bytes]) -> bool:
        """Whether the ids of each unit stand for its bytes."""
        entries = self.entries
        spelled = [b"".join([entries[i] for i in own]) for own in ids]
        return spelled == raw

    def written(self, mark: str) -> np.ndarray:
        """Every id as decimal text with ``mark`` behind it."""
        if mark not in self._written:
            self._written[mark] = np.array([f"{i}{mark}" for i in range(len(self.entries))], object)
        return self._written[mark]


def byte_level_side(path: str) -> Side:
    vocabulary = ByteLevel(path)
    return Side(vocabulary.ids, vocabulary.entries, "")  # its pre-tokens cut before all white space


def piece_side(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    entries = []
    for piece in pieces:
        byte = _BYTE_PIECE.fullmatch(piece)
        entries.append(bytes([int(byte[1], 16)]) if byte else piece.replace(PIECE_SPACE, " ").encode())
    plain = [p.replace(PIECE_SPACE, " ") for p in pieces]
    joined = {b for p in plain for a, b in zip(p, p[1:], strict=False) if b in WHITE_SPACE and a not in WHITE_SPACE}
    lead = "a"  # takes the space that the model puts before a text
    skip = len(model.encode(lead))

    def encode(texts: list[str]) -> list[list[int]]:
        """Ids without that space: of texts that begin with white space before which it cuts."""
        return [ids[skip:] for ids in model.encode([lead + t for t in texts], num_threads=1)]

    sizes = np.array([len(e) for e in entries])
    return Side(lambda units: ids_of_units(units, encode, sizes), entries, "".join(sorted(joined)))


class Aligner:
    """Aligned units of texts, kept by a worker.

    A unit is a run of white space with what follows it, up to the next white space before which both
    tokenizers cut. So tokens, groups and links of a text are those of its units in order.
    """

    def __init__(self, a: Side, b: Side):
        if len(a.entries) > 1 << A_BITS or len(b.entries) > 1 << SHIFT:
            raise ValueError("a vocabulary is too large for the pairs' integers")
        self.a, self.b = a, b
        joined = re.escape(a.joined + b.joined)
        more = f"(?:[{joined}][{WHITE_SPACE}]*+[^{WHITE_SPACE}]*+)*+" if joined else ""
        self._units = re.compile(f"[{WHITE_SPACE}]*+[^{WHITE_SPACE}]++{more}|[{WHITE_SPACE}]++").findall
        #: Unit to its counts (tokens of A, of B, groups), its links as packed pairs, and its groups.
        self._known: dict[str, tuple[int, bytes, str | None]] = {}
        self._older: dict[str, tuple[int, bytes, str | None]] = {}

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, bytes, str]]:
        """Per text its tokens of A, of B, groups, links as packed pairs, and the groups' ids."""
        cut = [[] if not t or PIECE_SPACE in t else self._units(" " + t) for t in texts]
        if len(self._known) > TABLE_ENTRIES:
            self._known, self._older = {}, self._known
        missing = set().union(*cut).difference(self._known)
        kept = missing.intersection(self._older)
        self._known.update(zip(kept, map(self._older.__getitem__, kept), strict=True))
        long = self._learn(list(missing - kept))
        known = self._known
        known.update(long)
        mask = (1 << 40) - 1
        for units in cut:
            counts, links, groups = zip(*[known[u] for u in units], strict=True) if units else ((), (), ())
            if not units or None in groups:
                yield 0, 0, 0, b"", ""
                continue
            total = sum(counts)
            yield total >> 80, total >> 40 & mask, total & mask, b"".join(links), ";".join(groups)
        for unit in long:
            del known[unit]

    def _learn(self, units: list[str]) -> dict[str, tuple]:
        """Keeps what is found for the units; returns what is too long for that."""
        a, b = self.a.encode(units), self.b.encode(units)
        raw = [unit.encode() for unit in units]
        whole = self.a.spells(a, raw) and self.b.spells(b, raw)
        good = range(len(units))
        long = {}
        if not whole:
            good = [i for i in good if self.a.spells(a[i : i + 1], raw[i : i + 1]) and self.b.spells(b[i : i + 1], raw[i : i + 1])]
            for i in set(range(len(units))).difference(good):
                (self._known if len(units[i]) <= KEPT_CHARS else long)[units[i]] = (0, b"", None)
        for i, entry in zip(good, self._aligned([a[i] for i in good], [b[i] for i in good]), strict=True):
            (self._known if len(units[i]) <= KEPT_CHARS else long)[units[i]] = entry
        return long

    def _aligned(self, a: list[list[int]], b: list[list[int]]) -> Iterator[tuple[int, bytes, str]]:
        """Per unit its counts, links and groups.

        All units' bytes are one stretch, which both sides cut. Each piece between two neighbouring cuts
        lies in one token of either side, and each overlapping pair of tokens has exactly one such piece.
        """
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64, n.sum()) for x, n in ((a, n_a), (b, n_b)))
        if not len(ids_a):
            return
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        cuts = np.union1d(ends_a, ends_b)
        links = ids_a[np.searchsorted(ends_a, cuts)] << SHIFT | ids_b[np.searchsorted(ends_b, cuts)]
        last_a = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a  # of their group
        last_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
        # The ids' texts in the order of the groups, A's before B's in each.
        until_a, until_b = (np.concatenate([[0], np.flatnonzero(x) + 1]) for x in (last_a, last_b))
        at_a = np.arange(len(ids_a)) + until_b[np.cumsum(last_a) - last_a]
        at_b = np.arange(len(ids_b)) + until_a[np.cumsum(last_b) - last_b + 1]
        texts = np.empty(len(ids_a) + len(ids_b), object)
        texts[at_a] = np.where(last_a, self.a.written("|")[ids_a], self.a.written(",")[ids_a])
        texts[at_b] = np.where(last_b, self.b.written(";")[ids_b], self.b.written(",")[ids_b])
        texts, packed = texts.tolist(), links.astype("<i8").tobytes()
        stops = np.cumsum(n_a) - 1  # the last token of A in each unit ends it
        n_links = np.searchsorted(cuts, ends_a[stops]) + 1
        n_groups = np.cumsum(last_a)[stops]
        rows = zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), strict=True)
        text, group, link = 0, 0, 0
        for own_a, own_b, groups, found in rows:
            joined = "".join(texts[text : text + own_a + own_b])[:-1]
            yield own_a << 80 | own_b << 40 | groups - group, packed[8 * link : 8 * found], joined
            text, group, link = text + own_a + own_b, groups, found


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each Python worker."""
    key = path_a, path_b
    if key not in _aligners:
        _aligners[key] = Aligner(byte_level_side(path_a), piece_side(path_b))
    return _aligners[key]


class PairBitmaps:
    """Per id pair and plane a bitmap of a block's documents, compressed to its bytes that are not zero.

    Plane ``k`` marks the documents that hold the pair linked a number of times with bit ``k`` set.
    An entry is one integer: the pair, the plane, the byte's place and its bits.
    """

    def __init__(self):
        self._planes: list[np.ndarray] = []
        self.size = 0

    def add(self, pairs: np.ndarray, ordinals: np.ndarray) -> None:
        """Links of some documents, each with its pair and its document's number in the block."""
        keys, times = np.unique(pairs << 16 | ordinals, return_counts=True)
        plane = 0
        while len(keys):
            chosen = keys[(times >> plane & 1).astype(bool)]
            entries = self._merged((chosen >> 16) << 5 | plane, chosen & 0xFFFF)
            self._planes.append(entries)
            self.size += len(entries)
            left = times >> plane + 1 > 0
            keys, times, plane = keys[left], times[left], plane + 1

    @staticmethod
    def _merged(named: np.ndarray, ordinals: np.ndarray) -> np.ndarray:
        """Entries of documents one by one, those in one byte united."""
        places = named << 13 | ordinals >> 3
        bits = np.left_shift(1, ordinals & 7)
        if not len(places):
            return places
        first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        return places[first] << 8 | np.bitwise_or.reduceat(bits, first)

    def rows(self, block: int, size: int = 1 << 14) -> Iterator[pa.RecordBatch]:
        """Rows ``block, pair, plane, docs, links, places, bits``; ``docs`` stands at a pair's lowest plane."""
        entries = np.sort(np.concatenate(self._planes)) if self._planes else np.empty(0, np.int64)
        if not len(entries):
            return
        keys, bits = entries >> 8, entries & 0xFF
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, bits = keys[first], np.bitwise_or.reduceat(bits, first).astype(np.uint8)
        named, places = keys >> 13, (keys & 0x1FFF).astype("<u2")
        begins = np.flatnonzero(np.concatenate([[True], named[1:] != named[:-1]]))
        pairs, planes = named[begins] >> 5, named[begins] & 31
        lowest = np.concatenate([[True], pairs[1:] != pairs[:-1]])
        # The documents of a pair: its planes' bitmaps united, then counted.
        by_place = (keys >> 18) << 13 | keys & 0x1FFF
        order = np.argsort(by_place, kind="stable")
        sorted_places = by_place[order]
        start = np.flatnonzero(np.concatenate([[True], sorted_places[1:] != sorted_places[:-1]]))
        united = np.bitwise_count(np.bitwise_or.reduceat(bits[order], start))
        owner = np.searchsorted(pairs[lowest], sorted_places[start] >> 13)
        docs = np.zeros(len(pairs), np.int64)
        docs[lowest] = np.bincount(owner, united, minlength=lowest.sum()).astype(np.int64)
        links = np.add.reduceat(np.bitwise_count(bits).astype(np.int64), begins) << planes
        ends = np.append(begins, len(keys))
        for i in range(0, len(pairs), size):
            j = min(i + size, len(pairs))
            a, b = ends[i], ends[j]
            offsets = (ends[i : j + 1] - a).astype(np.int32)
            yield _batch(
                j - i,
                block=np.full(j - i, block),
                pair=pairs[i:j],
                plane=planes[i:j].astype(np.int32),
                docs=docs[i:j],
                links=links[i:j],
                places=_binary(2 * offsets, places[a:b]),
                bits=_binary(offsets, bits[a:b]),
            )


def _binary(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(values).tobytes()
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def _batch(rows: int, **columns) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array)
        else columns.get(f.name, pa.nulls(rows, f.type))
        for f in _ALIGNED
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_ALIGNED)


def _align(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, block_docs: int, block_pairs: int):
    """Rows of documents, and after each block of them the rows of its pairs."""
    own = aligner(path_a, path_b)
    blocks = iter(range(TaskContext.get().partitionId() << 32, 1 << 63))
    block, used, bitmaps = next(blocks), 0, PairBitmaps()
    for batch in batches:
        for part in text_slices(batch, "text", SLICE):
            texts, ids = part.column("text").to_pylist(), part.column("doc_id").to_pylist()
            while texts:
                room = block_docs - used
                found = list(own.align(texts[:room]))
                n_a, n_b, n_groups, packed, groups = zip(*found, strict=True)
                n_links = np.array([len(p) >> 3 for p in packed], np.int64)
                ordinals = np.arange(used, used + len(found))
                yield _batch(
                    len(found), block=np.full(len(found), block), ordinal=ordinals.astype(np.int32),
                    doc_id=ids[:room], n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links, groups=groups,
                )
                bitmaps.add(np.frombuffer(b"".join(packed), "<i8"), np.repeat(ordinals, n_links))
                texts, ids, used = texts[room:], ids[room:], used + len(found)
                if used >= block_docs or bitmaps.size >= block_pairs:
                    yield from bitmaps.rows(block)
                    block, used, bitmaps = next(blocks), 0, PairBitmaps()
                    pa.default_memory_pool().release_unused()
    yield from bitmaps.rows(block)


def align(
    docs: DataFrame, path_a: str, path_b: str, block_docs: int = BLOCK_DOCS, block_pairs: int = BLOCK_PAIRS
) -> tuple[DataFrame, DataFrame]:
    """Aligned documents and the inverted bitmaps of their id pairs, from one pass, both written once.

    A is a byte-level vocabulary of the tokenizers library, given a space and the text; B a sentencepiece
    model, given the text, before which it puts the space itself. Where tokens of both end, the bytes are
    cut into groups; tokens of both that overlap are linked.

    Documents: ``block, ordinal`` (their number there), ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links`` and ``groups``, the ids as ``a1,a2|b1;a3|b2``. Postings, per block, id pair and plane: the
    bytes of a bitmap of documents that are not zero (``bits``) and their ``places``; plane ``k`` marks
    those that hold the pair a number of times with bit ``k`` set. ``links`` counts for the plane, ``docs``
    for all planes of the pair, at its lowest.

    A null or empty text, and one whose tokens' bytes are not a space and the text, has no tokens: zeros
    and empty ``groups``. Each row is a document of its own, also with a null or repeated ``doc_id``. Other
    columns are ignored. An empty table gives no rows. A task holds about 1 MB of texts, or one longer
    text, with its links (8 bytes each), and one block's bitmaps.
    """
    if not 0 < block_docs <= BLOCK_DOCS:
        raise ValueError(f"a block has 1 to {BLOCK_DOCS} documents, not {block_docs}")
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = with_modules(chosen).mapInArrow(
        lambda batches: _align(batches, path_a, path_b, block_docs, block_pairs), ALIGNED
    )
    both = materialize(both, "aligned", ROW_GROUP)
    documents = ["block", "ordinal", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    postings = ["block", "pair", "plane", "docs", "links", "places", "bits"]
    return both.where("ordinal IS NOT NULL").select(*documents), both.where("pair IS NOT NULL").select(*postings)


def pair_counts(postings: DataFrame) -> DataFrame:
    """Per id pair ``a_id, b_id``, how many ``docs`` hold it linked, how many ``links`` it has, in how
    many ``posting_rows``, and whether it is a ``best`` one: no pair of its A id is in more documents.

    Blocks hold different documents, so the bitmaps' counts add up.
    """
    sums = [F.sum("docs").alias("docs"), F.sum("links").alias("links"), F.count("*").alias("posting_rows")]
    counts = postings.groupBy("pair").agg(*sums)
    counts = counts.withColumn("a_id", F.shiftright("pair", SHIFT))
    counts = materialize(counts.withColumn("b_id", F.col("pair").bitwiseAND((1 << SHIFT) - 1)), "pair-counts")
    most = counts.groupBy("a_id").agg(F.max("docs").alias("most"))  # a row for each entry of A's vocabulary
    return counts.join(F.broadcast(most), "a_id").withColumn("best", F.col("docs") == F.col("most")).drop("most")


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of one block after the other: adds up what they hold for each of its documents."""
    _aligners.clear()  # a worker that has aligned needs its tables no more
    pa.default_memory_pool().release_unused()
    block, sums, best = None, np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
    names = ["block", "ordinal", "n_best", "count_sum"]

    def finished() -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(sums)
        columns = np.full(len(at), block), at.astype(np.int32), best[at], sums[at]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    for batch in batches:
        blocks = batch.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
        for i, j in zip(edges, edges[1:], strict=False):
            if i == j:
                continue
            if blocks[i] != block:
                if block is not None:
                    yield from finished()
                block, sums[:], best[:] = blocks[i], 0, 0
            rows = batch.slice(i, j - i)
            bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint8)
            places = np.frombuffer(b"".join(rows.column("places").to_pylist()), "<u2").astype(np.int64)
            sizes = pa.compute.binary_length(rows.column("bits")).to_numpy()
            times = np.left_shift(1, rows.column("plane").to_numpy().astype(np.int64))
            which, bit = np.nonzero(np.unpackbits(bits[:, None], axis=1, bitorder="little"))
            ordinals = places[which] << 3 | bit
            row = np.repeat(np.arange(len(sizes)), sizes)[which]
            np.add.at(sums, ordinals, (times * rows.column("docs").to_numpy())[row])
            chosen = rows.column("best").to_numpy(zero_copy_only=False)
            np.add.at(best, ordinals, np.where(chosen, times, 0)[row])
    if block is not None:
        yield from finished()


def with_scores(documents: DataFrame, postings: DataFrame) -> DataFrame:
    """Aligned ``documents`` with ``n_best`` and ``count_sum`` in place of ``block`` and ``ordinal``.

    A pair's count is the number of documents that hold it linked. ``n_best`` counts a document's links
    whose pair has the highest count of its A id, ties included; ``count_sum`` adds up the counts over
    its links. The postings are joined with their counts and go to their block, where each hands its
    count to its documents: a frequent pair is a few rows a block, however many documents hold it.
    """
    counts = materialize(pair_counts(postings).select("pair", "docs", "best", "posting_rows"), "best-pairs")
    bitmaps = postings.select("block", "pair", "plane", "places", "bits")
    counted = lookup_join(bitmaps, counts, ["pair"], key_rows=PAIR_ROWS, weight="posting_rows")
    counted = counted.select("block", "plane", "docs", "best", "places", "bits")
    sums = counted.repartition("block").sortWithinPartitions("block").mapInArrow(
        _score, "block bigint, ordinal int, n_best bigint, count_sum bigint"
    )
    scored = documents.join(sums, ["block", "ordinal"], "left").drop("block", "ordinal")
    return scored.na.fill(0, ["n_best", "count_sum"])
