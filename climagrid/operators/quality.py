"""Data-quality operators, each one job over its table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.functions.stats import sample_deviation

_WITH_NAN = ("double", "float")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column (NULL, or NaN where the type has it) and their percentage.

    All columns are counted in one aggregate, which is then turned into rows.
    """
    types = dict(df.dtypes)
    names = list(columns or df.columns)

    def missing(name: str):
        null = F.col(name).isNull()
        return null | F.isnan(name) if types[name] in _WITH_NAN else null

    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(missing(n)).alias(f"missing_{i}") for i, n in enumerate(names)],
    )
    entries = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.lit(types[n]).alias("column_type"),
            F.col(f"missing_{i}").alias("null_count"),
        )
        for i, n in enumerate(names)
    ]
    return counts.select("total_rows", F.inline(F.array(*entries))).withColumn(
        "null_pct", F.round(F.try_divide(F.col("null_count") * 100.0, "total_rows"), 2)
    )


def column_stats(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """Lowest, highest, mean and sample deviation of a column."""
    return df.agg(
        F.round(F.min(col), digits).alias("min_value"),
        F.round(F.max(col), digits).alias("max_value"),
        F.round(F.avg(col), digits).alias("avg_value"),
        F.round(sample_deviation(col), digits).alias("stddev_value"),
    )


def date_range(df: DataFrame, col: str = "weather_date") -> DataFrame:
    """First and last date."""
    return df.agg(F.min(col).alias("first_date"), F.max(col).alias("last_date"))


def distinct_count(df: DataFrame, col: str, approximate: bool = False) -> DataFrame:
    """Number of distinct values, NULL among them; ``approximate`` needs no shuffle of values.

    The approximate count leaves NULL out.
    """
    if approximate:
        return df.agg(F.approx_count_distinct(col).alias("distinct_values"))
    return df.select(col).distinct().agg(F.count(F.lit(1)).alias("distinct_values"))


def row_distribution(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group, most first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), *keys)


def available_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values in order."""
    return df.select(col).distinct().orderBy(col)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
