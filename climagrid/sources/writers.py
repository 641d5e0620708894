"""Sinks: raw landing, trusted observations, named datasets, exports, catalog tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climagrid.functions.dates import parse_date
from climagrid.operators.ordering import sorted_rows
from climagrid.sources.schemas import LOCATION_COLUMNS
from climagrid.sources.scratch import materialize
from climagrid.sources.versions import publish

# Folder of each dataset category.
CATEGORY_FOLDERS = {
    "descriptive_analytics": "descriptive_analytics_results",
    "ml_analytics": "ml_analytics_results",
}
EXPORT_FORMATS = ("json", "csv")

#: Folders of landed documents in a year.
SLOTS = 16
#: Parts that a year's observations are dealt to, so that also one task's share of a year can be split.
YEAR_PARTS = 16

#: Shuffled bytes that a task of a sorted write gets. Rows are ten times as large in its memory, where they
#: are sorted; with Spark's default of 64 MB executors of 10 GB spill nearly all rows once.
SORTED_BYTES = 16 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}
_sorting: dict[SparkSession, tuple[int, str | None]] = {}
_changing = Lock()


@contextmanager
def sorted_partitions(spark: SparkSession) -> Iterator[None]:
    """Rebalanced partitions of at most ``SORTED_BYTES`` shuffled; a session that asks for less gets less.

    It is the session's setting that is changed meanwhile, and given back when the last of several
    concurrent writes ends.
    """
    with _changing:
        writes, before = _sorting.get(spark, (0, spark.conf.get(_ADVISORY, None)))
        _sorting[spark] = writes + 1, before
        if not writes and (before is None or _bytes(before) > SORTED_BYTES):
            spark.conf.set(_ADVISORY, SORTED_BYTES)
    try:
        yield
    finally:
        with _changing:
            writes, before = _sorting.pop(spark)
            if writes > 1:
                _sorting[spark] = writes - 1, before
            elif before is None:
                spark.conf.unset(_ADVISORY)
            else:
                spark.conf.set(_ADVISORY, before)


def _bytes(size: str) -> int:
    """The bytes of a setting such as ``64MB``, ``64m`` or ``67108864b``."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", size.lower()).groups()
    return int(number) * _UNITS[unit]


def write_raw_json(docs: DataFrame, root: str, by_city: bool = False) -> None:
    """Land documents as JSON lines under ``year=`` and ``slot=``, sorted by their ``city`` column.

    The year is that of the first day; a city's slot is one of ``SLOTS`` that its name hashes to.
    Documents of a landed city and year replace what the root holds of them; other cities and years
    stay. Only folders of landed slots are written anew, with the documents of their other cities, so a
    late city costs a share of its year. Rebalancing gathers a folder's documents into few files, and
    adaptive execution splits a heavy one over several tasks. The one sort begins with the folders, as
    the writer needs it, and files are gzipped: names and units repeat in every line. ``by_city`` makes a folder per city inside
    each year instead, so that only the landed ones are touched; keep it for few cities, since the
    number of folders is cities times years.

    Folders are replaced when all is written, so the root may be read by the same job.
    """
    folders = ["year", "city" if by_city else "slot"]
    landed = docs.withColumn(
        "year", F.year(parse_date(F.try_element_at("daily.time", F.lit(1))))
    ).withColumn("city", F.replace(F.lower("city"), F.lit(" "), F.lit("_")))
    if not by_city:
        landed = _with_other_cities(landed.withColumn("slot", city_slot("city")), root)
    with sorted_partitions(docs.sparkSession):
        (
            landed.hint("rebalance", *folders)
            .sortWithinPartitions(*folders, *([] if by_city else ["city"]))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "gzip")
            .partitionBy(*folders)
            .json(root)
        )


def city_slot(city: str) -> Column:
    """The slot of a city's documents; a missing name has one too."""
    return F.pmod(F.xxhash64(city), F.lit(SLOTS)).cast("int")


def _with_other_cities(landed: DataFrame, root: str) -> DataFrame:
    """The landed documents and those of other cities in the same folders that the root holds.

    Landed cities and years are found in a first pass that reads no measurements, and kept: years times
    slots are few, so their folders are named to the scan.
    """
    try:
        held = landed.sparkSession.read.schema(landed.schema).json(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return landed
    keys = landed.select(
        F.col("year").alias("__year"), F.col("slot").alias("__slot"), F.col("city").alias("__city")
    )
    keys = materialize(keys.distinct(), "landed-cities")
    folder = lambda year, slot: F.concat_ws("/", F.coalesce(year, F.lit(-1)), slot)
    folders = keys.select(folder(F.col("__year"), F.col("__slot"))).distinct().collect()
    touched = held.where(folder(F.col("year"), F.col("slot")).isin([r[0] for r in folders]))
    same = F.col("year").eqNullSafe(F.col("__year")) & F.col("city").eqNullSafe(F.col("__city"))
    return landed.unionByName(touched.join(keys, same, "left_anti"))


def write_locations_csv(locations: DataFrame, path: str) -> None:
    """Location columns as CSV with a header."""
    locations.select(*LOCATION_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def write_observations(obs: DataFrame, path: str, ordered: bool = False) -> None:
    """Write trusted observations as Parquet.

    By default into one folder per year, every file sorted by date and city, so that both
    the folders and the row-group statistics prune. Rebalancing replaces a global sort:
    a year is dealt to ``YEAR_PARTS`` by place and month, and adaptive execution splits or merges
    those by size, to what a task sorts in memory. ``ordered`` asks for flat files in one global
    date and city order instead.
    """
    if ordered:
        sorted_rows(obs, "weather_date", "city_name").write.mode("overwrite").parquet(path)
        return
    part = F.pmod(F.xxhash64("city_name", "location_id", F.month("weather_date")), F.lit(YEAR_PARTS))
    with sorted_partitions(obs.sparkSession):
        (
            obs.withColumns({"weather_year": F.year("weather_date"), "__part": part})
            .hint("rebalance", "weather_year", "__part")
            .drop("__part")
            .sortWithinPartitions("weather_year", "weather_date", "city_name")
            .write.mode("overwrite")
            .partitionBy("weather_year")
            .parquet(path)
        )


def load_table(df: DataFrame, name: str, path: str | None = None) -> int:
    """Replace a catalog table by ``df`` and return its row count.

    The rows go to a fresh folder first; only then is the table pointed there, so that a load that
    fails, at whatever row, leaves the table as it was. With the columns of before that is one change
    of the catalog; with others the table is dropped and made anew. The files lie under ``path``, by
    default beside the warehouse's tables, in versions (see ``sources.versions``). A table that keeps
    its files elsewhere is taken over, and its old files go with its own drop.

    The count reads only Parquet footers of the new table, not ``df`` a second time.
    """
    spark = df.sparkSession
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/versions_of_{name.replace('.', '/')}"

    def point(place: str) -> None:
        schema = spark.read.parquet(place).schema
        if spark.catalog.tableExists(name):
            if spark.table(name).schema == schema and spark.catalog.getTable(name).tableType == "EXTERNAL":
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
                spark.catalog.refreshTable(name)
                return
            spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=place, source="parquet", schema=schema)

    publish(spark, base, df.write.parquet, point)
    return spark.table(name).count()


def dataset_path(root: str, category: str, name: str) -> str:
    """Folder of a named dataset."""
    return f"{root.rstrip('/')}/{CATEGORY_FOLDERS[category]}/{name}"


def save_dataset(df: DataFrame, root: str, category: str, name: str) -> str:
    """Replace a named dataset under its category and return the folder of its new version.

    Readers have the old version until the new one is complete, also if writing fails.
    """
    return publish(df.sparkSession, dataset_path(root, category, name), df.write.parquet)


def export_dataset(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write rows as JSON lines or as CSV with a header."""
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"unknown export format {fmt!r}, use one of {EXPORT_FORMATS}")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.option("ignoreNullFields", False).json(path)
