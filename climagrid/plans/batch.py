"""The batch job from raw files to refined datasets, in one Spark application."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from climagrid.operators.anomalies import anomalies
from climagrid.operators.joins import join_on_grid
from climagrid.operators.quality import null_profile
from climagrid.operators.rollup import MONTHLY_GRAIN, rollup
from climagrid.operators.transforms import explode_daily, prepare_locations, snap_documents
from climagrid.plans import reports
from climagrid.plans.catalog import DATASETS
from climagrid.plans.models import (
    choose_k,
    cluster_cities,
    predict_temperature,
    regress_precipitation,
    regression_metrics,
)
from climagrid.sources.readers import (
    has_days,
    read_locations_csv,
    read_observations,
    read_weather_json,
    split_valid_documents,
)
from climagrid.sources.schemas import OBSERVATION_COLUMNS
from climagrid.sources.scratch import job_scratch, materialize
from climagrid.sources.writers import load_table, save_dataset, write_observations

CONCURRENT_WRITES = 4


def trusted_observations(docs: DataFrame, locations: DataFrame) -> DataFrame:
    """Observations of all locations from raw documents and raw location rows.

    Documents meet their locations before their days are exploded, so the join sees one row
    per document instead of one per day.
    """
    valid, _ = split_valid_documents(docs)
    snapped = snap_documents(valid.select("latitude", "longitude", "daily"))
    placed = join_on_grid(snapped, prepare_locations(locations))
    return explode_daily(placed).select(*OBSERVATION_COLUMNS)


def refined_datasets(obs: DataFrame) -> dict[str, DataFrame | None]:
    """All published datasets; None where there is too little data for a model.

    One rollup, kept in the shared folder, feeds every report and also the anomaly statistics, so
    the observations are scanned once for them all. The regression's fit does not wait for it: the
    many small jobs of the clustering run beside its scans.
    """
    with ThreadPoolExecutor(1) as pool:
        fitting = pool.submit(regress_precipitation, obs)
        monthly = materialize(rollup(obs), "monthly-rollup")
        clusters = cluster_cities(reports.city_features(monthly))
        regression = fitting.result()
    return {
        "correlations": reports.correlations(monthly),
        "monthly_analysis": reports.monthly_analysis(monthly),
        "seasonal_analysis": reports.seasonal_analysis(monthly),
        "extreme_cities": reports.extreme_cities(monthly),
        "precipitation_patterns": reports.precipitation_patterns(monthly),
        "cities_comparison": reports.cities_comparison(monthly),
        "tropical_analysis": reports.tropical_analysis(monthly),
        "clustering_results": clusters,
        "cluster_summary": clusters and reports.cluster_summary(clusters),
        "regression_results": regression and regression.predictions,
        "regression_metrics": regression and regression_metrics(regression.predictions),
        "null_profile": null_profile(obs),
        "anomalies": anomalies(obs, source=monthly),
        "temporal_patterns": reports.temporal_patterns(monthly),
    }


def extended_datasets(obs: DataFrame) -> dict[str, DataFrame | None]:
    """The older set of datasets, for observations that also have lowest temperature, humidity
    and coordinates; None where there is too little data for a model.
    """
    coordinates = ("location_latitude", "location_longitude")
    monthly = materialize(rollup(obs, (*MONTHLY_GRAIN, *coordinates)), "monthly-rollup")
    clusters = choose_k(reports.city_features(monthly, geo=True))
    temperature = predict_temperature(obs)
    return {
        "monthly_analysis": reports.monthly_analysis(monthly, extended=True),
        "extreme_cities": reports.extreme_cities(monthly, scale="global"),
        "seasonal_analysis": reports.seasonal_analysis(monthly, "temperate"),
        "correlations": reports.humidity_correlations(obs),
        "clustering_results": clusters and clusters.predictions,
        "temperature_predictions": temperature and temperature.predictions,
    }


def run_batch(
    spark: SparkSession,
    weather: str,
    locations: str,
    trusted: str,
    refined: str,
    table: str | None = None,
    multi_line: bool = True,
) -> dict[str, str]:
    """Raw files to trusted observations to refined datasets; returns the datasets' folders.

    Documents without days are kept as JSON lines in ``rejected_path(trusted)``. They are counted while
    the others are used, and only if there are any are the documents parsed once more. ``table`` also
    loads the observations into a catalog table.
    """
    docs = read_weather_json(spark, weather, multi_line)
    unusable = Observation("documents")
    watched = docs.select("latitude", "longitude", "daily").observe(
        unusable, F.count_if(~has_days()).alias("rejected")
    )
    write_observations(trusted_observations(watched, read_locations_csv(spark, locations)), trusted)
    _, rejected = split_valid_documents(docs)
    if not unusable.get["rejected"]:
        rejected = rejected.limit(0)
    rejected.write.mode("overwrite").json(rejected_path(trusted))
    return refine(spark, trusted, refined, table)


def rejected_path(trusted: str) -> str:
    """Where the batch keeps the documents that it could not use."""
    return f"{trusted.rstrip('/')}_rejected"


def refine(
    spark: SparkSession, trusted: str, refined: str, table: str | None = None, older: bool = False
) -> dict[str, str]:
    """Trusted observations to refined datasets; returns their folders.

    ``older`` makes the older set, from observations that have its further columns. The datasets do
    not depend on each other, so a few are written at a time and the tail of one job leaves no idle
    cores. What the job keeps in the shared folder goes at its end.
    """
    with job_scratch(spark):
        obs = spark.read.parquet(trusted) if older else read_observations(spark, trusted)
        if table is not None:
            load_table(obs, table)
        found = extended_datasets(obs) if older else refined_datasets(obs)
        built = {name: df for name, df in found.items() if df is not None}
        with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
            folders = pool.map(
                lambda name: save_dataset(built[name], refined, DATASETS[name], name), built
            )
            return dict(zip(built, folders, strict=True))
