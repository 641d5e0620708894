"""Named result datasets: listing and reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climagrid.functions.labels import label_of
from climagrid.operators.ordering import head
from climagrid.sources.versions import POINTER, current_version
from climagrid.sources.writers import CATEGORY_FOLDERS, dataset_path

# The published datasets and their category.
DATASETS = {
    "correlations": "descriptive_analytics",
    "monthly_analysis": "descriptive_analytics",
    "seasonal_analysis": "descriptive_analytics",
    "extreme_cities": "descriptive_analytics",
    "precipitation_patterns": "descriptive_analytics",
    "cities_comparison": "descriptive_analytics",
    "tropical_analysis": "descriptive_analytics",
    "clustering_results": "ml_analytics",
    "regression_results": "ml_analytics",
    "anomalies": "ml_analytics",
    "temporal_patterns": "ml_analytics",
    # Of the older set only.
    "temperature_predictions": "ml_analytics",
    # Shown by the published job, kept here.
    "null_profile": "descriptive_analytics",
    "cluster_summary": "ml_analytics",
    "regression_metrics": "ml_analytics",
}


def list_datasets(spark: SparkSession, root: str) -> DataFrame:
    """Name, category and number of Parquet files of every dataset under ``root``.

    Files of the version that readers get, or files that lie flat in a dataset's folder. Only paths
    are taken from the listing; no file is opened.
    """
    categories = {folder: category for category, folder in CATEGORY_FOLDERS.items()}
    under = f"/({'|'.join(categories)})/([^/]+)/(?:(version-[^/.]+)({POINTER})?)?"
    entries = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{{.parquet,{POINTER}}}")
        .load(root)
        .select(*[F.regexp_extract("path", under, i + 1).alias(c) for i, c in enumerate(("folder", "name", "version", "end"))])
        .filter(F.col("folder") != "")
    )
    # A dataset's entries are its part files and a few versions: one small group each.
    versions = entries.groupBy("folder", "name", "version").agg(
        F.count_if(F.col("end") == "").alias("file_count"), F.max("end").alias("end")
    )
    shown = (F.col("end") != "") | (F.col("version") == "")
    newest = F.max_by("file_count", F.when(shown, F.col("version")))
    return (
        versions.groupBy("name", label_of("folder", categories, "").alias("category"))
        .agg(newest.alias("file_count"))
        .where(F.col("file_count") > 0)
        .orderBy("category", "name")
    )


def get_dataset(
    spark: SparkSession, root: str, name: str, limit: int = 100, order: Sequence[str] = ()
) -> DataFrame:
    """A dataset by name, at most ``limit`` rows (0 for all): the first by ``order``, if given.

    Looked for under the descriptive, then the ML category, then the root itself; all part
    files of its current version are read, or files that lie flat in its folder.
    """
    if not name:
        raise ValueError(f"no dataset named; available: {sorted(DATASETS)}")
    places = [dataset_path(root, category, name) for category in CATEGORY_FOLDERS]
    places.append(f"{root.rstrip('/')}/{name}")
    for place in places:
        try:
            return head(spark.read.parquet(current_version(spark, place) or place), limit, *order)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise ValueError(f"no data for dataset {name!r} in {places}")
