"""The training-data operators chained over ``documents``.

Each stage works on all that the one before it kept; ``run`` writes every result to the shared folder
and reads it for the next. The stages in turn drop documents of bad quality, drop lines that an
earlier document has, keep one document of each group of near duplicates, replace personal data, and
pack the rest into token sequences.

Each row is a document of its own, also with a null or repeated ``doc_id``: verdicts hold for rows, and
of rows that are near copies one stays, that of the smallest id (null ids last). Null and empty texts,
further columns and empty tables are treated as the operators say.
"""

from __future__ import annotations

import os
import secrets
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climagrid.llm import line_dedup, minhash, packing, quality, surrogates
from climagrid.operators.joins import BROADCAST_BYTES, table_bytes
from climagrid.sources.scratch import job_scratch, materialize, scratch_path

#: Variable with the secret key of the surrogates. Without it each session draws one of its own.
KEY_VARIABLE = "CORPUS_SURROGATE_KEY"
_drawn_key = secrets.token_hex(32)


def _by_row(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on documents whose ``doc_id`` tells rows apart, with their own ids in its result.

    Where ids are repeated or null, rows get numbers in the order of their ids instead: the rows are
    written once with a number each, then the ids alone are sorted.
    """
    counts = docs.groupBy("doc_id").count()
    if counts.where("count > 1 OR doc_id IS NULL").isEmpty():
        return work(docs)
    columns = [c for c in docs.columns if c != "doc_id"]
    ids = [F.col("doc_id").alias("__id"), F.monotonically_increasing_id().alias("__row")]
    rows = materialize(docs.select(*ids, *[F.col(f"`{c}`") for c in columns]), "numbered-rows")
    order = rows.select("__id", F.col("__row").alias("__r")).orderBy(F.col("__id").asc_nulls_last(), "__r")
    order = materialize(order.select("__r", F.monotonically_increasing_id().alias("doc_id")), "row-order")
    keyed = materialize(rows.join(order, F.col("__row") == F.col("__r")).drop("__row", "__r"), "keyed-rows")
    done = work(keyed).drop("doc_id")
    return done.select(*[F.col("__id").alias("doc_id") if c == "doc_id" else F.col(f"`{c}`") for c in docs.columns])


def _of_kept(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The documents whose id is kept; their ids are broadcast if they are small when measured."""
    ids = materialize(verdicts.where("kept").select(F.col("doc_id").alias("__kept_id")), "kept-ids")
    if table_bytes(ids) <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    return docs.join(ids, F.col("doc_id") == F.col("__kept_id"), "left_semi")


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of documents whose text has changed, with ``n_chars`` as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _by_row(docs, lambda rows: _of_kept(rows, quality.quality_verdicts(rows)))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _by_row(docs, lambda rows: _with_length(line_dedup.dedup_lines(rows), rows.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _by_row(docs, lambda rows: _of_kept(rows, minhash.near_duplicates(rows)))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = os.environ.get(KEY_VARIABLE, _drawn_key)
    return _with_length(surrogates.replace_entities(docs, key), docs.columns)


def token_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, path).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", shared_lines),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("packing", token_sequences),
]

#: The quality verdict, the surrogates and the token ids cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order. What a stage keeps for itself goes when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        with job_scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
