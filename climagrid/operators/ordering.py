"""Sorting and limiting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COPIES_PER_CHUNK = 1_000_000


def sorted_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Global sort of a report (one row per group)."""
    return df.orderBy(*keys)


def sorted_rows(df: DataFrame, *keys: str | Column, fold_copies: bool = False) -> DataFrame:
    """Global sort of a row-level dataset in which any key may be heavy; values stay as they are.

    A range shuffle cannot split rows that compare equal, so a date with a third of all rows
    would go to one task. The remaining columns break ties, in the same shuffle. Only exact
    copies then share a task; where one row has very many, ``fold_copies`` folds them into counts
    in a shuffle before, cut into chunks and unfolded after the sort. Needs columns that can be
    ordered (no maps, no ML vectors).
    """
    columns = df.columns
    by_name = {key for key in keys if isinstance(key, str)}
    ties = [c for c in columns if c not in by_name]
    if not fold_copies:
        return df.orderBy(*keys, *ties)
    # Grouping takes -0.0 for 0.0, so floating values are told apart by their text.
    floats = [c for c, kind in df.dtypes if kind in ("float", "double")]
    groups = [F.col(c).cast("string").alias(f"__{c}") if c in floats else F.col(c) for c in columns]
    folded = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("__copies"), *[F.first(c).alias(c) for c in floats]
    )
    chunks = folded.select(
        *columns,
        "__copies",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / _COPIES_PER_CHUNK)))
        .alias("__chunk"),
    )
    in_chunk = F.least(
        F.lit(_COPIES_PER_CHUNK), F.col("__copies") - F.col("__chunk") * _COPIES_PER_CHUNK
    ).cast("int")
    return (
        chunks.orderBy(*keys, *ties, "__chunk")
        .select(*columns, F.explode(F.array_repeat(F.lit(True), in_chunk)).alias("__copy"))
        .drop("__copy")
    )


def head(df: DataFrame, n: int = 100, *keys: str | Column) -> DataFrame:
    """First ``n`` rows, all rows for ``n <= 0``.

    With ``keys`` the rows come from a total order, which Spark runs as a top-k without a
    full sort; without, they are any ``n`` rows.
    """
    ordered = df.orderBy(*keys) if keys else df
    return ordered.limit(n) if n > 0 else ordered
