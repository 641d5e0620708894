"""Sources: raw documents, location tables, trusted observations, catalog tables."""

from __future__ import annotations

import operator
from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climagrid.sources.schemas import LOCATION_COLUMNS, LOCATION_CSV, WEATHER_DOCUMENT


def read_weather_json(
    spark: SparkSession, path: str | list[str], multi_line: bool = True
) -> DataFrame:
    """Weather documents under a declared schema; text that does not parse gives NULL rows.

    ``multi_line`` reads one pretty-printed document per file, one task per file. Documents
    landed by ``write_raw_json`` hold one per line: pass ``False`` there. Those gzipped files are
    read by one task each, as large as a task wrote them; Spark splits plain files of lines.
    """
    docs = spark.read.schema(WEATHER_DOCUMENT).option("multiLine", multi_line).json(path)
    return docs.drop("slot")  # of a landed root's folders


def has_days() -> Column:
    """Whether a document has at least one day; false if missing, empty or malformed."""
    return F.coalesce(F.size("daily.time"), F.lit(0)) > 0


def split_valid_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with at least one day, and the rest (missing, empty or malformed)."""
    return docs.filter(has_days()), docs.filter(~has_days())


def read_locations_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Location rows as text, header first."""
    return spark.read.schema(LOCATION_CSV).option("header", True).csv(path)


def read_locations_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
) -> DataFrame:
    """The eight location columns of a database table.

    With ``bounds`` (lowest and highest ``location_id``) the table is read in
    ``partitions`` parallel ranges; ids outside the bounds still arrive, in the end ranges.
    Without, one task reads it all.
    """
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **(properties or {})}
    if bounds is not None:
        low, high = bounds
        options |= {
            "partitionColumn": "location_id",
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load().select(*LOCATION_COLUMNS)


def read_observations(
    spark: SparkSession,
    path: str | list[str],
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Trusted observations, in the yearly layout of ``write_observations`` or flat files.

    A date range also skips the year folders outside it.
    """
    obs = spark.read.parquet(*([path] if isinstance(path, str) else path))
    by_year = "weather_year" in obs.columns
    for bound, keep in ((start, operator.ge), (end, operator.le)):
        if bound is None:
            continue
        day = F.lit(str(bound)).cast("date")
        obs = obs.filter(keep(F.col("weather_date"), day))
        if by_year:
            obs = obs.filter(keep(F.col("weather_year"), F.year(day)))
    return obs.drop("weather_year")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session catalog."""
    return spark.table(name)
