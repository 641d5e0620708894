"""Every operator as a query over the check tables (see ``checks.retail``)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climagrid import functions as fn
from climagrid import sources as io
from climagrid.checks import retail
from climagrid.functions.labels import CLIMATE_BANDS, RAIN_BANDS
from climagrid.operators import anomalies as an
from climagrid.operators import joins, ordering, quality
from climagrid.operators import transforms as tr
from climagrid.operators.rollup import rollup
from climagrid.plans import batch, catalog, models, reports

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SERIES = (("NATION_1", "NATION_2"), "1996-01-01", "1997-12-31")
CITY_LABELS = {"NATION_1": "first city", "NATION_2": "second city"}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _on_observations(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(retail.observations(spark, sf_dir))


def _on_extended(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(retail.extended_observations(spark, sf_dir))


# Reports
_on_observations("monthly_analysis", reports.monthly_analysis)
_on_extended("monthly_extended", lambda obs: reports.monthly_analysis(obs, extended=True))
_on_observations("extreme_cities", reports.extreme_cities)
_on_observations("extreme_cities_global", lambda obs: reports.extreme_cities(obs, scale="global"))
_on_observations("seasonal_analysis", reports.seasonal_analysis)
_on_observations("seasonal_temperate", lambda obs: reports.seasonal_analysis(obs, "temperate"))
_on_observations("tropical_analysis", reports.tropical_analysis)
_on_observations("precipitation_patterns", reports.precipitation_patterns)
_on_observations(
    "cities_comparison", lambda obs: reports.cities_comparison(obs, CITY_LABELS, "elsewhere")
)
_on_observations("correlations", reports.correlations)
_on_extended("humidity_correlations", reports.humidity_correlations)
_on_observations("temporal_patterns", reports.temporal_patterns)
_on_observations("city_features", reports.city_features)
_on_extended("city_features_geo", lambda obs: reports.city_features(obs, geo=True))
_on_observations("compare_cities", lambda obs: reports.compare_cities(obs, *SERIES[0], *SERIES[1:]))

# Quality
_on_observations("column_stats", lambda obs: quality.column_stats(obs, "max_temp_c"))
_on_observations("date_range", quality.date_range)
_on_observations("distinct_cities", lambda obs: quality.distinct_count(obs, "city_name"))
_on_observations(
    "row_distribution", lambda obs: quality.row_distribution(obs, "city_name", "country")
)
_on_observations("null_profile", quality.null_profile)
_on_observations("available_cities", lambda obs: quality.available_values(obs, "city_name"))

# Rows
_on_observations(
    "sorted_observations", lambda obs: ordering.sorted_rows(obs, "weather_date", "city_name")
)
_on_observations(
    "head_monthly",
    lambda obs: ordering.head(
        reports.monthly_analysis(obs), 100, "city_name", "year", "month", "country"
    ),
)
_on_observations("select_series", lambda obs: tr.select_series(obs, *SERIES))
_on_observations(
    "not_null_rows",
    lambda obs: tr.require_not_null(obs, ["max_temp_c", "precipitation_mm"]),
)
_on_extended(
    "drop_null_rows",
    lambda obs: quality.count_by(
        tr.drop_null(obs, ["min_temp_c", "humidity_percent"]), "city_name"
    ),
)
_on_extended(
    "prediction_error",
    lambda obs: tr.with_error(obs, "max_temp_c", "min_temp_c").select(
        "weather_date", "location_id", "error"
    ),
)
_on_observations(
    "calendar_features",
    lambda obs: quality.count_by(fn.with_calendar(obs), "year", "month", "day_of_year"),
)
_on_observations(
    "epoch_phases",
    lambda obs: quality.count_by(
        obs.withColumn("phase", fn.epoch_phase("weather_date")), "weather_date", "phase"
    ),
)
_on_observations(
    "threshold_classes",
    lambda obs: quality.count_by(
        obs.withColumn("temp_class", fn.classify("max_temp_c", *CLIMATE_BANDS["local"])).withColumn(
            "rain_class", fn.classify("precipitation_mm", *RAIN_BANDS, op=">")
        ),
        "temp_class",
        "rain_class",
    ),
)
_on_observations(
    "season_calendars",
    lambda obs: quality.count_by(
        fn.with_calendar(obs).withColumns(
            {c: fn.season("month", c) for c in ("dry_wet", "tropical", "temperate")}
        ),
        "month",
        "dry_wet",
        "tropical",
        "temperate",
    ),
)
_on_observations(
    "label_lookup",
    lambda obs: quality.count_by(
        obs.withColumn("label", fn.label_of("city_name", CITY_LABELS, "elsewhere")), "label"
    ),
)


@query
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = tr.split(retail.observations(spark, sf_dir), *models.SPLIT_KEYS)
    sides = train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )
    return quality.count_by(sides, "city_name", "side")


# Results of results
_on_observations(
    "correlation_filter",
    lambda obs: tr.filter_result(
        reports.correlations(obs), F.col("temp_precipitation_corr") < 0
    ),
)
_on_observations(
    "countries_in_result", lambda obs: quality.count_by(reports.correlations(obs), "country")
)
_on_observations(
    "projected_result",
    lambda obs: tr.project(
        reports.correlations(obs), {"city": "city_name", "temp_corr": "temp_precipitation_corr"}
    ),
)


# Anomalies
@query
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = an.anomalies(retail.observations(spark, sf_dir))
    return found.withColumns(
        {c: F.round(c, 6) for c in ("temp_z_score", "precip_z_score")}
    )


@query
def anomalies_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = retail.observations(spark, sf_dir)
    found = an.anomalies(obs, source=rollup(obs))
    return found.withColumns({c: F.round(c, 6) for c in ("temp_z_score", "precip_z_score")})


@query
def group_stats_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retail.observations(spark, sf_dir).select("weather_date", "city_name", "max_temp_c")
    placed = joins.with_group_stats(rows, ["city_name"], {"max_temp_c": "temp"})
    return placed.withColumns({c: F.round(c, 6) for c in ("mean_temp", "std_temp")})


# Models
def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.city_features(retail.observations(spark, sf_dir))


@query
def standardized_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = models.standardize(_features(spark, sf_dir)).withColumn(
        "z", vector_to_array("features")
    )
    return scaled.select(
        "city_name",
        "country",
        *[F.round(F.col("z")[i], 6).alias(f"z_{c}") for i, c in enumerate(models.CLUSTER_FEATURES)],
    )


@query
def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    warm = F.when(F.col("avg_max_temp") >= 20, 0).when(F.col("avg_max_temp") >= 10, 1).otherwise(2)
    return reports.cluster_summary(_features(spark, sf_dir).withColumn("prediction", warm))


def _certified(clusters: DataFrame) -> DataFrame:
    """Adds what holds for any good clustering, whatever its labels: that each city's own centre is
    the nearest one, and how many clusters there are."""
    cities = clusters.withColumn("z", vector_to_array("features"))
    size = len(models.CLUSTER_FEATURES)
    centres = cities.groupBy("prediction").agg(
        F.array(*[F.avg(F.col("z")[i]) for i in range(size)]).alias("centre")
    )
    # One row that holds as many centres as there are clusters.
    listed = centres.agg(F.map_from_entries(F.collect_list(F.struct("*"))).alias("centres"))

    def distance(centre: Column) -> Column:
        squares = F.zip_with("z", centre, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda a, b: a + b)

    own = distance(F.element_at("centres", F.col("prediction")))
    least = F.array_min(F.transform(F.map_values("centres"), distance))
    return cities.join(F.broadcast(listed)).select(
        "city_name",
        "country",
        *models.CLUSTER_FEATURES,
        (own <= least + 1e-9).alias("own_centre_is_nearest"),
        F.size("centres").alias("clusters"),
    )


@query
def clustering_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _certified(models.cluster_cities(_features(spark, sf_dir)))


@query
def cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are arbitrary, so members are listed by the size of their cluster."""
    members = models.cluster_members(models.cluster_cities(_features(spark, sf_dir)))
    sizes = members.groupBy("prediction").agg(F.count("*").alias("size"))
    total = members.join(sizes, "prediction")
    listed = total.agg(F.sum(F.lit(1) / F.col("size")).alias("clusters"))
    return members.drop("prediction").join(F.broadcast(listed)).withColumn(
        "clusters", F.round("clusters").cast("int")
    )


@query
def silhouette_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every k tried, and whether the chosen one has the best score and its clusters give it."""
    features = reports.city_features(retail.extended_observations(spark, sf_dir), geo=True)
    choice = models.choose_k(features)
    best = choice.scores.agg(F.max_by("k", F.struct("silhouette", -F.col("k")))).first()[0]
    rows = choice.predictions.select(vector_to_array("features").alias("z"), "prediction")
    moments = rows.select("prediction", F.posexplode("z").alias("i", "x")).groupBy("prediction", "i")
    moments = moments.agg(F.count("*").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    clusters = moments.groupBy("prediction").agg(
        F.first("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("i", "m"))).alias("centre"),
        F.sum("v").alias("spread"),
    )
    clusters = clusters.agg(F.collect_list(F.struct("*")).alias("clusters"))

    def mean_square(cluster: Column) -> Column:
        """The mean squared distance of a row from all rows of a cluster."""
        gaps = F.zip_with("z", F.transform(cluster["centre"], lambda p: p["m"]), lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda a, b: a + b) + cluster["spread"]

    own = F.filter("clusters", lambda c: c["prediction"] == F.col("prediction"))[0]
    inside = mean_square(own) * own["n"] / F.greatest(own["n"] - 1, F.lit(1))
    others = F.filter("clusters", lambda c: c["prediction"] != F.col("prediction"))
    outside = F.array_min(F.transform(others, mean_square))
    score = F.when(own["n"] > 1, (outside - inside) / F.greatest(inside, outside)).otherwise(0.0)
    computed = rows.join(F.broadcast(clusters)).agg(F.avg(score)).first()[0]
    evaluated = choice.scores.where(F.col("k") == choice.best_k).first()["silhouette"]
    agrees = best == choice.best_k and abs(computed - evaluated) < 1e-6
    return choice.scores.select("k", F.lit(agrees).alias("choice_is_right"))


@query
def regression_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = models.regress_precipitation(retail.observations(spark, sf_dir))
    return fitted.predictions.drop("features").withColumn("prediction", F.round("prediction", 4))


@query
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = models.regress_precipitation(retail.observations(spark, sf_dir))
    metrics = models.regression_metrics(fitted.predictions)
    return metrics.select(*[F.round(c, 4).alias(c) for c in metrics.columns])


@query
def temperature_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = models.predict_temperature(retail.extended_observations(spark, sf_dir))
    return tr.with_error(fitted.predictions).select(
        "city_name",
        "weather_date",
        "max_temp_c",
        *[F.round(c, 2).alias(c) for c in ("prediction", "error")],
    )


# Raw zone to trusted zone
@query
def grid_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapped = tr.snap_documents(retail.weather_documents(spark, sf_dir))
    return quality.count_by(snapped, "latitude", "longitude")


@query
def explode_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tr.snap_documents(retail.weather_documents(spark, sf_dir))
    return tr.explode_daily(docs.select("latitude", "longitude", "daily"))


@query
def prepare_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.prepare_locations(retail.location_rows(spark, sf_dir))


@query
def extracted_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.snap_extract(retail.location_rows(spark, sf_dir))


@query
def join_on_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tr.snap_documents(retail.weather_documents(spark, sf_dir))
    locations = tr.prepare_locations(retail.location_rows(spark, sf_dir))
    joined = joins.join_on_grid(docs, locations)
    return quality.count_by(joined, "location_id", "city_name", "latitude", "longitude")


@query
def join_on_grid_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tr.snap_documents(retail.weather_documents(spark, sf_dir))
    locations = tr.prepare_locations(retail.location_rows(spark, sf_dir))
    joined = joins.join_on_grid(docs, locations, broadcast_bytes=-1, key_rows=500)
    return quality.count_by(joined, "location_id", "city_name", "latitude", "longitude")


@query
def trusted_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.trusted_observations(
        retail.weather_documents(spark, sf_dir), retail.location_rows(spark, sf_dir)
    )


@query
def valid_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, rejected = io.split_valid_documents(retail.weather_documents(spark, sf_dir))
    sides = valid.select(F.lit("valid").alias("side")).unionAll(
        rejected.select(F.lit("rejected").alias("side"))
    )
    return quality.count_by(sides, "side")


# Through files and tables
def _town() -> Column:
    number = (F.col("elevation") / 10 % 25).cast("int").cast("string")
    return F.concat(F.lit("Town "), number)


def _land_documents(spark: SparkSession, sf_dir: str) -> str:
    valid, _ = io.split_valid_documents(retail.weather_documents(spark, sf_dir))
    root = io.scratch_path(spark, "weather")
    io.write_raw_json(valid.withColumn("city", _town()), root)
    return root


def _land_locations(spark: SparkSession, sf_dir: str) -> str:
    path = io.scratch_path(spark, "locations")
    io.write_locations_csv(retail.location_rows(spark, sf_dir), path)
    return path


@query
def weather_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed in two steps, the second with cities that are new and one that is there already."""
    valid, _ = io.split_valid_documents(retail.weather_documents(spark, sf_dir))
    named, root = valid.withColumn("city", _town()), io.scratch_path(spark, "weather")
    late = F.pmod(F.xxhash64("city"), F.lit(2)) == 0
    io.write_raw_json(named.where(~late | (F.col("city") == "Town 1")), root)
    io.write_raw_json(named.where(late | (F.col("city") == "Town 1")), root)
    docs = io.read_weather_json(spark, root, multi_line=False)
    return tr.explode_daily(tr.snap_documents(docs).drop("generationtime_ms"))


@query
def locations_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.read_locations_csv(spark, _land_locations(spark, sf_dir))


@query
def observations_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = io.scratch_path(spark, "observations")
    io.write_observations(retail.observations(spark, sf_dir), path)
    return io.read_observations(spark, path)


@query
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"observations_{uuid.uuid4().hex}"
    io.load_table(retail.observations(spark, sf_dir), name, io.scratch_path(spark, "table"))
    return io.read_table(spark, name)


@query
def dataset_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = io.scratch_path(spark, "refined")
    monthly = reports.monthly_analysis(retail.observations(spark, sf_dir))
    io.save_dataset(monthly, root, catalog.DATASETS["monthly_analysis"], "monthly_analysis")
    return catalog.get_dataset(spark, root, "monthly_analysis", limit=0)


def _export(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    path = io.scratch_path(spark, f"export-{fmt}")
    rain = reports.precipitation_patterns(retail.observations(spark, sf_dir))
    io.export_dataset(rain, path, fmt)
    return spark.read.schema(rain.schema).option("header", True).format(fmt).load(path)


@query
def json_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export(spark, sf_dir, "json")


@query
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export(spark, sf_dir, "csv")


@query
def dataset_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = io.scratch_path(spark, "refined")
    obs = retail.observations(spark, sf_dir)
    for name, report, files in (
        ("monthly_analysis", reports.monthly_analysis, 2),
        ("temporal_patterns", reports.temporal_patterns, 3),
    ):
        io.save_dataset(report(obs).repartition(files), root, catalog.DATASETS[name], name)
    return catalog.list_datasets(spark, root)


@query
def dataset_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = io.scratch_path(spark, "refined")
    monthly = reports.monthly_analysis(retail.observations(spark, sf_dir))
    io.save_dataset(monthly, root, catalog.DATASETS["monthly_analysis"], "monthly_analysis")
    order = ("city_name", "year", "month", "country")
    return catalog.get_dataset(spark, root, "monthly_analysis", limit=100, order=order)


_batches: dict[tuple[str, str], str] = {}


def _refined(spark: SparkSession, sf_dir: str) -> str:
    """Where the batch job over the tables has written, once per application."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _batches:
        refined = io.scratch_path(spark, "refined")
        trusted = io.scratch_path(spark, "trusted")
        weather, places = _land_documents(spark, sf_dir), _land_locations(spark, sf_dir)
        batch.run_batch(spark, weather, places, trusted, refined, multi_line=False)
        _batches[key] = refined
    return _batches[key]


@query
def raw_to_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.get_dataset(spark, _refined(spark, sf_dir), "monthly_analysis", limit=0)


#: Datasets of the batch and their rounded columns, read back as they were published.
BATCH = {
    "correlations": (),
    "seasonal_analysis": (),
    "extreme_cities": (),
    "precipitation_patterns": (),
    "tropical_analysis": (),
    "temporal_patterns": (),
    "regression_results": ("prediction",),
    "anomalies": ("temp_z_score", "precip_z_score"),
}


def _on_batch(name: str, rounded: tuple[str, ...]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = catalog.get_dataset(spark, _refined(spark, sf_dir), name, limit=0)
        digits = 4 if name == "regression_results" else 6
        return found.drop("features").withColumns({c: F.round(c, digits) for c in rounded})

    QUERIES[f"batch_{name}"] = run


for _name, _rounded in BATCH.items():
    _on_batch(_name, _rounded)
