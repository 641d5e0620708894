"""Lines that several documents share, kept in one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.sources.scratch import materialize

MIN_CHARS = 10
MIN_DOCS = 2

#: Characters stripped at both ends of a line.
BLANKS = " \t\n\v\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    # lower() is exact and much faster where every character is ASCII.
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n", -1)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id`` and the positions of its lines that go, as ``dropped``; documents with any only.

    Lines travel as a 96-bit hash of their key. Document counts come from partial aggregates, so a
    line in a third of all documents costs each task one row; the join back meets it only in
    shuffled sides, which adaptive execution splits.
    """
    lines = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.posexplode(_lines("text")).alias("pos", "line")
    ).where("doc_id IS NOT NULL")
    keyed = (
        lines.where(F.octet_length("line") >= min_chars)
        .withColumn("line_key", line_key(F.col("line")))
        .where(F.char_length("line_key") >= min_chars)
        .select("doc_id", "pos", F.xxhash64("line_key").alias("h1"), F.hash("line_key").alias("h2"))
    )
    keyed = materialize(keyed, "line-hashes")
    if min_docs <= 2:
        shared = keyed.groupBy("h1", "h2").agg(
            F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last")
        )
        shared = shared.where("keeper < last" if min_docs == 2 else "true")
    else:
        once = keyed.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
        shared = once.groupBy("h1", "h2").agg(
            F.min("doc_id").alias("keeper"), F.count("one").alias("docs")
        )
        shared = shared.where(F.col("docs") >= min_docs)
    shared = materialize(shared.select("h1", "h2", "keeper"), "shared-lines")
    gone = keyed.join(shared, ["h1", "h2"]).where("doc_id > keeper")
    return gone.groupBy("doc_id").agg(F.collect_set("pos").alias("dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Documents without the lines that an earlier document has, and how many lines went.

    A line's key is the line stripped of blanks, A-Z in lower case. Keys of at least ``min_chars``
    code points in at least ``min_docs`` documents lose all their lines but those of the smallest
    ``doc_id`` that holds it; the others stay in order. Adds ``n_lines`` (before) and ``n_dropped``
    to the columns of ``docs`` and replaces ``text``; columns of these names are replaced, others,
    whatever their names, come through.

    A null or empty text is one empty line and comes back empty. Rows with a null ``doc_id`` neither
    count nor lose lines. Rows that share a ``doc_id`` are one document for the counts and each lose
    the positions that any of them loses. An empty table gives no rows. A very long text is one row with
    the list of its lines; its lines travel as hashes.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    gone = dropped_lines(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("__gone_id"), F.sort_array("dropped").alias("__gone")
    )
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    # Null ids find no partner; a hash in their place keeps them from meeting in one task.
    key = F.coalesce(F.col("doc_id").cast("bigint"), -F.abs(F.xxhash64(F.coalesce("text", F.lit("")))) - 1)
    found = F.col("doc_id").isNotNull() & F.col("__gone").isNotNull()
    joined = source.withColumn("__key", key).join(gone, F.col("__key") == F.col("__gone_id"), "left")
    lines = _lines("text")
    return joined.select(
        *[F.col(f"`{c}`") if c != "text" else _without(lines, found).alias("text") for c in kept],
        F.size(lines).cast("bigint").alias("n_lines"),
        F.when(found, F.size("__gone")).otherwise(0).cast("bigint").alias("n_dropped"),
    )


def _without(lines: Column, found: Column) -> Column:
    """The stretches of lines between the sorted positions of ``__gone``, put together again."""
    gone, count = F.col("__gone"), F.size("__gone")

    def stretch(i: Column) -> Column:
        before = F.when(i == 0, -1).otherwise(F.get(gone, i - 1))
        after = F.when(i == count, F.size(lines)).otherwise(F.get(gone, i))
        return F.slice(lines, before + 2, after - before - 1)

    rest = F.flatten(F.transform(F.sequence(F.lit(0), count), stretch))
    return F.when(found, F.array_join(rest, "\n")).otherwise(
        F.coalesce(F.col("text").cast("string"), F.lit(""))
    )
