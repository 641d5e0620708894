"""Observations, documents and locations derived from the retail check tables.

The tables hold no weather. Line items stand for observations, suppliers for locations; the
derived values are multiples of 0.5 with NULLs in every measure, and all rows take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns used of each table; a declared schema saves the job that would infer one.
SCHEMAS = {
    "lineitem": """l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_discount DOUBLE,
                   l_tax DOUBLE, l_shipdate TIMESTAMP_NTZ""",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _placed(spark: SparkSession, sf_dir: str, suppliers: DataFrame) -> DataFrame:
    """Rows with a supplier, joined to nation and region.

    Joined one table after the other, each side is a plain scan: Spark knows its file size
    and decides on that whether to broadcast it.
    """
    nation, region = (_table(spark, sf_dir, name) for name in ("nation", "region"))
    return suppliers.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def _unless(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _percent(col: str) -> Column:
    return F.round(F.col(col) * 100)


def _derived(spark: SparkSession, sf_dir: str, extended: bool) -> DataFrame:
    line = F.col("l_linenumber")
    rain = (
        F.when(F.col("l_tax") < 0.03, F.lit(0.0))
        .otherwise(
            _percent("l_tax")
            * (F.col("n_nationkey") % 5)
            * 0.5
            * F.when(line == 7, 2).otherwise(1)
        )
    )
    temp = F.col("l_quantity") - F.col("n_nationkey")
    columns = {
        "weather_date": F.col("l_shipdate").cast("date"),
        "location_id": F.col("n_nationkey").cast("int"),
        "city_name": F.col("n_name"),
        "country": F.col("r_name"),
        "max_temp_c": _unless(line == 6, temp),
        "precipitation_mm": _unless(line == 5, rain),
        "population": (F.col("n_nationkey") * 100000 + 50000).cast("int"),
        "elevation": (F.col("s_suppkey") * 10).cast("double"),
    }
    if extended:
        columns |= {
            "min_temp_c": _unless(line == 4, temp - 5 - _percent("l_discount") * 0.5),
            "humidity_percent": _unless(
                line == 3, 40 + _percent("l_tax") * 5 - _percent("l_discount") * 1.5
            ),
            "location_latitude": F.col("n_nationkey") * 0.5
            - 6
            + F.col("s_suppkey") % 3 * 0.125,
            "location_longitude": F.col("r_regionkey") * 10.0
            - 70
            - F.col("s_suppkey") % 2 * 0.125,
        }
    supplied = _table(spark, sf_dir, "lineitem").join(
        _table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    return _placed(spark, sf_dir, supplied).select(*[column.alias(name) for name, column in columns.items()])


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight trusted columns, one row per line item."""
    return _derived(spark, sf_dir, extended=False)


def extended_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also lowest temperature, humidity and coordinates."""
    return _derived(spark, sf_dir, extended=True)


def _cell(supplier: Column) -> tuple[Column, Column]:
    """A grid cell for every supplier, so that the grid join stays one to one at any scale."""
    return (
        (supplier % 1440) * 0.125 - 90,
        F.floor(supplier / 1440) * 0.125 - 180,
    )


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw document per line item, off its supplier's grid point.

    Line 1 lies on a tie between two cells. Line 7 has no days, line 5 with a low discount
    no ``daily`` at all; the rain array is one short and line 6 has a NULL temperature.
    """
    line = F.col("l_linenumber")
    lat, lon = _cell(F.col("l_suppkey"))
    day = F.col("l_shipdate").cast("date")
    off = F.when(line == 1, 0.0625).otherwise((line - 4) * 0.0125)
    temp, rain = F.col("l_quantity"), _percent("l_tax")
    days = F.array(*[F.date_add(day, n).cast("string") for n in range(3)])
    daily = F.struct(
        F.when(line == 7, F.array().cast("array<string>")).otherwise(days).alias("time"),
        F.when(line == 7, F.array().cast("array<double>"))
        .otherwise(F.array(temp, _unless(line == 6, temp + 1), temp - 2))
        .alias("temperature_2m_max"),
        F.when(line == 7, F.array().cast("array<double>"))
        .otherwise(F.array(rain, rain * 0.5))
        .alias("precipitation_sum"),
    )
    return _table(spark, sf_dir, "lineitem").select(
        (lat + off).alias("latitude"),
        (lon - off).alias("longitude"),
        F.lit(0.5).alias("generationtime_ms"),
        F.lit(-18000).alias("utc_offset_seconds"),
        F.lit("America/Bogota").alias("timezone"),
        F.lit("-05").alias("timezone_abbreviation"),
        (F.col("l_suppkey") * 10).cast("double").alias("elevation"),
        F.struct(
            F.lit("iso8601").alias("time"),
            F.lit("°C").alias("temperature_2m_max"),
            F.lit("mm").alias("precipitation_sum"),
        ).alias("daily_units"),
        F.when((line == 5) & (F.col("l_discount") < 0.02), F.lit(None))
        .otherwise(daily)
        .alias("daily"),
    )


def location_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw location rows as text, one per supplier; some populations are no number."""
    lat, lon = _cell(F.col("s_suppkey"))
    text = {
        "location_id": F.col("s_suppkey"),
        "city_name": F.col("n_name"),
        "country": F.col("r_name"),
        "latitude": lat + 0.03125,
        "longitude": lon - 0.03125,
        "population": F.when(F.col("s_suppkey") % 10 == 3, F.lit("unknown")).otherwise(
            (F.col("s_suppkey") * 1000 % 1000000).cast("string")
        ),
        "elevation": F.col("s_suppkey") * 10,
        "average_tourism_visits_per_year": F.col("s_suppkey") % 100 * 500,
    }
    return _placed(spark, sf_dir, _table(spark, sf_dir, "supplier")).select(
        *[column.cast("string").alias(name) for name, column in text.items()]
    )
