"""Near duplicates by bottom-k sketches of word shingles, verified on the full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.llm.components import connected_components
from climagrid.llm.shipping import with_modules
from climagrid.llm.units import let_go, text_slices
from climagrid.operators.joins import lookup_join
from climagrid.sources.scratch import materialize

WORDS = 5
PERCENT = 75
#: Values kept of a set. Of the union's k smallest, 96 are expected in both sets at 75 percent.
K = 128
#: Fewer shared values than this among k have a probability below 1e-9 at 75 percent.
LEAST_SHARED = 64
#: Frequent values up to this size are broadcast to the sketches, beyond it both are shuffled.
BROADCAST_BYTES = 96 << 20
#: Members up to which a list's pairs are compared as they are; larger lists are drawn anew.
LIST = 64

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def word_codes(words: list[bytes]) -> np.ndarray:
    """The 64-bit hash of each word; hashing anew takes less than looking up what was hashed before."""
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """The 64-bit hash of each window of ``size`` words."""
    count = len(codes) - size + 1
    folded = np.full(count, size, np.uint64)
    for i in range(size):
        folded = folded * _FACTOR + codes[i : i + count]
    folded = (folded ^ (folded >> np.uint64(30))) * _MIX[0]
    folded = (folded ^ (folded >> np.uint64(27))) * _MIX[1]
    return (folded ^ (folded >> np.uint64(31))).view(np.int64)


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    found = text.encode().lower().split()  # of bytes: A-Z and the ASCII blanks only
    if not found:
        return np.empty(0, np.int64)
    return np.unique(window_hashes(word_codes(found), min(words, len(found))))


def _sets(docs: DataFrame, words: int, keep: int | None) -> DataFrame:
    """``doc_id, text_hash, n_shingles, set_key`` and the ``keep`` smallest hashes as ``hashes``."""
    names = ["doc_id", "text_hash", "n_shingles", "set_key", "hashes"]
    kind = pa.schema(
        list(zip(names, [*[pa.int64()] * 3, pa.binary(), pa.list_(pa.int64())], strict=True))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in text_slices(batch, "text"):
                sets = [shingle_set(t, words) for t in part.column("text").to_pylist()]
                kept = [s[:keep] for s in sets]
                ends = np.cumsum([0, *map(len, kept)])
                arrays = [
                    part.column("doc_id"),
                    part.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(kept))),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=kind)

    return with_modules(docs.select("doc_id", "text_hash", "text")).mapInArrow(
        run,
        "doc_id bigint, text_hash bigint, n_shingles bigint, set_key binary, hashes array<bigint>",
    )


def _least_shared(n: Column) -> Column:
    """How many retained values a set must share with any set that it is linked with."""
    return F.when(4 * n <= 3 * K, F.ceil(n * PERCENT / 100)).otherwise(LEAST_SHARED)


def _postings(classes: DataFrame, whole: bool = False) -> DataFrame:
    """Inverted lists ``v``: ``node, n, weight, rest``, of the values that suffice to meet partners.

    Linked sets share at least ``_least_shared`` retained values, so each may leave out all but one
    of so many: the most frequent ones. Lists of common passages thereby go, nothing else does.
    ``weight`` counts a set's shared values and ``rest`` those from this one on, by frequency.
    ``whole`` says that ``sketch`` holds all values, not the smallest ones.
    """
    values = classes.select("node", "n", F.explode("sketch").alias("v"))
    counts = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    counts = materialize(counts, "value-counts")
    shared = lookup_join(values, counts, ["v"], BROADCAST_BYTES, weight="df").groupBy("node", "n")
    lists = shared.agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("found"))
    weight = F.size("found")
    least = F.ceil(F.col("n") * PERCENT / 100) if whole else _least_shared(F.col("n"))
    spare = weight - least + 1
    used = lists.where(spare > 0).withColumn("used", F.slice("found", F.lit(1), spare.cast("int")))
    placed = used.select("node", "n", weight.alias("weight"), F.posexplode("used.v").alias("at", "v"))
    return placed.select("node", "n", "weight", (F.col("weight") - F.col("at")).alias("rest"), "v")


def _enough(n_a: Column, n_b: Column, whole: bool) -> Column:
    """Values that sets of these sizes share at least if they are linked."""
    exact = F.ceil((n_a + n_b) * PERCENT / (100 + PERCENT))
    if whole:
        return exact
    both = (n_a <= K) & (n_b <= K)
    return F.when(both, exact).otherwise(F.least(_least_shared(n_a), _least_shared(n_b)))


def _may_link(n_a: Column, rest_a: Column, n_b: Column, rest_b: Column, whole: bool) -> Column:
    """Whether sets of these sizes that meet at this value first can still share enough: what they
    share comes from here on in both."""
    fits = 100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)
    return fits & (F.least(rest_a, rest_b) >= _enough(n_a, n_b, whole))


def _linked(pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` with enough in common: estimated on the union's sketch, then exact."""

    def side(table: DataFrame, name: str, value: str) -> DataFrame:
        return table.select(F.col("node").alias(name), F.col(value).alias(f"s_{name}"))

    met = pairs.join(side(sketches, "a", "sketch"), "a").join(side(sketches, "b", "sketch"), "b")
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, K)
    shared = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), union))
    enough = F.when(F.size(union) < K, F.ceil(F.size(union) * PERCENT / 100)).otherwise(LEAST_SHARED)
    likely = materialize(met.where(shared >= enough).select("a", "b"), "likely-pairs")
    full = likely.join(side(sets, "a", "hashes"), "a").join(side(sets, "b", "hashes"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return full.where(
        100 * common >= PERCENT * (F.size("s_a") + F.size("s_b") - common)
    ).select("a", "b")


def _named(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings with the component that their class belongs to so far."""
    named = postings.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return materialize(named, "named-postings")


def _stars(postings: DataFrame) -> DataFrame:
    """The members of each list paired with its pivot, the member that shares most: in a group of
    copies that is the copied text."""
    top = F.max(F.struct("weight", "node", "n", "rest")).alias("top")
    pivots = postings.groupBy("v").agg(top, F.count("*").alias("c")).where("c > 1")
    pivots = pivots.select(
        "v", F.col("top.node").alias("pivot"), F.col("top.n").alias("p_n"), F.col("top.rest").alias("p_rest")
    )
    met = postings.join(materialize(pivots, "pivots"), "v").where("node <> pivot")
    met = met.where(_may_link(F.col("n"), F.col("rest"), F.col("p_n"), F.col("p_rest"), False))
    return met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def _open_lists(named: DataFrame) -> DataFrame:
    """Lists that hold several components, with their members ``c`` and smallest set ``low``."""
    lists = named.groupBy("v").agg(
        F.count("*").alias("c"), F.min("n").alias("low"),
        F.min("comp").alias("first"), F.max("comp").alias("last"),
    )
    return materialize(lists.where("first <> last").select("v", "c", "low"), "open-lists")


def _all_pairs(named: DataFrame, lists: DataFrame, whole: bool) -> DataFrame:
    """All pairs of different components in these lists that may be linked."""
    left = materialize(named.join(lists.select("v"), "v"), "open-postings")

    def side(name: str) -> DataFrame:
        columns = {"node": name, "n": f"n_{name}", "rest": f"rest_{name}", "comp": f"c_{name}"}
        return left.select("v", *[F.col(c).alias(new) for c, new in columns.items()])

    met = side("a").join(side("b"), "v").where("a < b AND c_a <> c_b")
    met = met.where(_may_link(F.col("n_a"), F.col("rest_a"), F.col("n_b"), F.col("rest_b"), whole))
    return met.select("a", "b").distinct()


def _drawn_anew(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Postings of the whole sets of ``members`` (``node, comp``), for lists too large to compare.

    With all values known, two sets must share a value among few, and a member whose values from
    here on are fewer than even the list's smallest set asks for meets nobody in it. Twice, the
    lists that this leaves with one component are closed.
    """
    whole = sets.join(members, "node").select("node", F.size("hashes").cast("bigint").alias("n"), F.col("hashes").alias("sketch"))
    named = _named(materialize(_postings(whole, whole=True), "whole-postings"), members)
    for _ in range(2):
        lists = _open_lists(named)
        low = F.greatest(F.col("low"), F.ceil(F.col("n") * PERCENT / 100))
        useful = named.join(lists, "v").where(F.col("rest") >= _enough(F.col("n"), low, True))
        named = materialize(useful.select(*named.columns), "useful-postings")
    return named


def near_duplicates(docs: DataFrame, words: int = WORDS, list_size: int = LIST) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, kept``: whom it is linked with.

    Documents are linked if their sets of ``words``-word shingles overlap by at least ``PERCENT`` of
    their union; ``component_id`` is the smallest ``doc_id`` reachable over links, ``kept`` marks it.

    Documents with equal sets are one class, which one row stands for. The ``K`` smallest hashes of a
    class's set are its sketch; inverted lists of retained values bring classes together, the sketch
    of their union estimates the overlap, and the full sets decide. Within a list, members first meet
    a pivot, and classes found linked are one component from then on. Then lists of up to ``list_size``
    members compare their pairs of different components. The members of larger ones are indexed by
    their whole sets, which leaves little to compare. So a group of many near copies does not become
    all its pairs, yet every pair is compared, already connected, or too different by its counts.

    A text without words (or null) has an empty set, is linked with nothing and is its own component.
    Fewer words than ``words`` make one shingle. Rows with a null ``doc_id`` take part, but only others
    name a component: it is null if there are none. Rows that repeat a ``doc_id`` are compared each by
    its own text. Columns other than ``doc_id`` and ``text`` are ignored. An empty table gives no rows.
    A task holds about 4 MB of texts, or one longer text with its words; the whole set of a document that
    may have partners, 8 bytes a shingle, is one row.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    sketched = materialize(_sets(source, words, K), "sketches")
    classes = materialize(
        sketched.where("n_shingles > 0")
        .groupBy(F.col("set_key").alias("node"))
        .agg(
            F.first("n_shingles").alias("n"),
            F.first("hashes").alias("sketch"),
            F.min(F.struct("doc_id", "text_hash")).alias("speaker"),
            F.min("doc_id").alias("smallest"),
        ),
        "classes",
    )
    postings = materialize(_postings(classes), "postings")
    nodes = materialize(postings.select("node").distinct(), "nodes")
    sketches = materialize(classes.select("node", "sketch", "speaker").join(nodes, "node"), "near-sketches")

    speakers = sketches.select("node", F.col("speaker.doc_id").alias("id"), "speaker.text_hash")
    texts = source.join(
        speakers.withColumnRenamed("text_hash", "hash"),
        F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")),
        "left_semi",
    )
    sets = _sets(texts, words, None).groupBy(F.col("set_key").alias("node"))
    sets = materialize(sets.agg(F.first("hashes").alias("hashes")), "sets")

    links = _linked(materialize(_stars(postings), "pairs"), sketches, sets)
    labels = connected_components(links)
    named = _named(postings, labels)
    lists = _open_lists(named)
    small, large = lists.where(F.col("c") <= list_size), lists.where(F.col("c") > list_size)
    pairs = _all_pairs(named, small, False)
    if not large.isEmpty():
        members = named.join(large.select("v"), "v").select("node", "comp").distinct()
        anew = _drawn_anew(materialize(members, "large-members"), sets)
        pairs = pairs.union(_all_pairs(anew, _open_lists(anew), True)).distinct()
    links = _linked(materialize(pairs, "pairs"), sketches, sets)
    labels = connected_components(links.union(labels.select("node", "comp")))

    named = classes.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = materialize(named.select("node", "comp", "smallest"), "named-classes")
    roots = materialize(named.groupBy("comp").agg(F.min("smallest").alias("component_id")), "roots")
    members = materialize(named.join(roots, "comp").select("node", "component_id"), "members")
    rows = sketched.select("doc_id", "n_shingles", "set_key")
    some = rows.where("n_shingles > 0").join(members, F.col("set_key") == F.col("node"))
    none = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    result = some.select("doc_id", "n_shingles", "component_id").unionByName(none.drop("set_key"))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
