"""Clustering and regression with Spark ML."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.functions.dates import epoch_phase
from climagrid.functions.stats import is_constant
from climagrid.operators.ordering import sorted_by
from climagrid.operators.transforms import drop_null, require_not_null, split
from climagrid.sources.scratch import materialize

# Model inputs and parameters of the published datasets.
CLUSTER_FEATURES = ("avg_max_temp", "total_precipitation", "temp_variability")
GEO_CLUSTER_FEATURES = (
    "avg_max_temp",
    "total_precipitation",
    "avg_humidity",
    "temp_variability",
)
TEMPERATURE_FEATURES = (
    "location_latitude",
    "location_longitude",
    "humidity_percent",
    "precipitation_mm",
    "month_num",
    "day_of_year",
)
NET_STRENGTH, NET_MIX = 0.1, 0.8
SEED = 42
TRAIN_FRACTION = 0.8
MIN_REGRESSION_ROWS = 11
SWEEP = range(2, 8)

# Partitions of the clusterings' input, whatever the number of cities.
LAYOUT = 16
CONCURRENT_FITS = 3

# An observation is split by its place and day.
SPLIT_KEYS = ("city_name", "location_id", "weather_date")


class KChoice(NamedTuple):
    """Silhouette of every k tried, the best k, and the clusters for it."""

    scores: DataFrame
    best_k: int
    predictions: DataFrame


class Regression(NamedTuple):
    """Fitted model and its predictions for the rows held back."""

    model: object
    predictions: DataFrame


def _scaling(cols: Sequence[str], raw: str, scaled: str) -> list:
    return [
        VectorAssembler(inputCols=list(cols), outputCol=raw),
        StandardScaler(inputCol=raw, outputCol=scaled, withMean=True, withStd=True),
    ]


def standardize(df: DataFrame, cols: Sequence[str] = CLUSTER_FEATURES) -> DataFrame:
    """Add ``features_raw`` and the z-standardised ``features`` vectors.

    Rows with a missing feature are dropped, since a vector cannot hold NULL.
    """
    complete = drop_null(df, cols)
    return Pipeline(stages=_scaling(cols, "features_raw", "features")).fit(complete).transform(
        complete
    )


def _scaled_input(kept: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scaled features in a layout that depends on the rows alone.

    The starting points drawn from a seed depend on where the rows lie, so rows are placed by
    their hash in a fixed number of partitions and sorted; otherwise a second run, or one with
    another city, could give other clusters.
    """
    placed = kept.repartition(LAYOUT, *kept.columns)
    return standardize(placed.sortWithinPartitions(*kept.columns), cols)


def cluster_cities(
    features: DataFrame,
    k: int = 3,
    cols: Sequence[str] = CLUSTER_FEATURES,
    seed: int = SEED,
) -> DataFrame | None:
    """Cities with their cluster in ``prediction``; None with fewer than two cities.

    ``k`` is lowered to the number of cities.
    """
    kept = materialize(drop_null(features, cols), "city-features")
    cities = kept.count()
    if cities < 2:
        return None
    scaled = _scaled_input(kept, cols)
    return KMeans(k=min(k, cities), seed=seed).fit(scaled).transform(scaled)


def choose_k(
    features: DataFrame,
    ks: Iterable[int] = SWEEP,
    cols: Sequence[str] = GEO_CLUSTER_FEATURES,
    seed: int = SEED,
) -> KChoice | None:
    """Clusters for the k with the best silhouette; None with fewer than three cities.

    The k tried stay below the number of cities. The first of equal scores wins.
    """
    kept = materialize(drop_null(features, cols), "city-features")
    cities = kept.count()
    tried = [k for k in ks if k < cities]
    if not tried:
        return None
    scaled = _scaled_input(kept, cols)
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    scaled = materialize(scaled, "scaled-features")

    def attempt(k: int) -> tuple[object, float]:
        fit = KMeans(k=k, seed=seed).fit(scaled)
        return fit, evaluator.evaluate(fit.transform(scaled))

    # The fits do not depend on each other and each is mostly the latency of small jobs.
    with ThreadPoolExecutor(CONCURRENT_FITS) as pool:
        results = dict(zip(tried, pool.map(attempt, tried), strict=True))
    fits = {k: fit for k, (fit, _) in results.items()}
    scores = [(k, score) for k, (_, score) in results.items()]
    best_k = max(scores, key=lambda score: score[1])[0]
    table = features.sparkSession.createDataFrame(scores, "k INT, silhouette DOUBLE")
    return KChoice(table, best_k, fits[best_k].transform(scaled))


def cluster_members(
    pred: DataFrame, features: Sequence[str] = CLUSTER_FEATURES
) -> DataFrame:
    """Cities listed by cluster."""
    listed = pred.select("city_name", "country", "prediction", *features)
    return sorted_by(listed, "prediction", "city_name", "country")


def regression_rows(obs: DataFrame) -> DataFrame:
    """Temperature, rain and calendar of the days that have both measures."""
    return require_not_null(obs, ["max_temp_c", "precipitation_mm"]).select(
        F.col("max_temp_c").alias("temperature"),
        F.col("precipitation_mm").alias("precipitation"),
        "city_name",
        "location_id",
        "weather_date",
        F.month("weather_date").alias("month"),
        F.year("weather_date").alias("year"),
    )


def temperature_rows(obs: DataFrame) -> DataFrame:
    """Days with temperature, humidity and rain, and the time of year (``day_of_year`` as double)."""
    complete = require_not_null(obs, ["max_temp_c", "humidity_percent", "precipitation_mm"])
    return complete.withColumns(
        {"month_num": F.month("weather_date"), "day_of_year": epoch_phase("weather_date").cast("double")}
    )


def regress_precipitation(
    obs: DataFrame, keys: Sequence[str] = SPLIT_KEYS
) -> Regression | None:
    """Least squares of rain on temperature and month.

    None unless there are more than ten rows and both sides of the split have some. Equal
    training rows are first folded into one with their number as weight, which gives the
    same fit: measures come in steps of a tenth, so the solver then reads a small kept table
    however many observations there are.
    """
    rows = regression_rows(obs)
    if len(rows.select(F.lit(1)).take(MIN_REGRESSION_ROWS)) < MIN_REGRESSION_ROWS:
        return None
    train, test = split(rows, *keys, frac=TRAIN_FRACTION, seed=SEED)
    folded = train.groupBy("temperature", "month", "precipitation").agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )
    folded = materialize(folded, "regression-rows")
    if folded.isEmpty() or test.isEmpty():
        return None
    features = VectorAssembler(inputCols=["temperature", "month"], outputCol="features")
    solver = LinearRegression(
        featuresCol="features", labelCol="precipitation", weightCol="weight", solver="normal"
    )
    model = solver.fit(features.transform(folded))
    predictions = model.transform(features.transform(test.drop("location_id", "weather_date")))
    return Regression(model, predictions)


def predict_temperature(
    obs: DataFrame, keys: Sequence[str] = SPLIT_KEYS
) -> Regression | None:
    """Elastic net for temperature from place, humidity, rain and time of year.

    ``day_of_year`` is a phase (see ``epoch_phase``). None if a side of the split is empty.
    Scaling and solving read the training rows a fixed number of times; nothing is cached. The solver
    works on the features' products alone, so it runs until it gains nothing more.
    """
    rows = temperature_rows(obs)
    train, test = split(rows, *keys, frac=TRAIN_FRACTION, seed=SEED)
    if train.isEmpty() or test.isEmpty():
        return None
    solver = LinearRegression(
        featuresCol="scaled_features",
        labelCol="max_temp_c",
        regParam=NET_STRENGTH,
        elasticNetParam=NET_MIX,
        solver="normal",
        tol=1e-12,
        maxIter=1000,
    )
    stages = [*_scaling(TEMPERATURE_FEATURES, "pred_features", "scaled_features"), solver]
    model = Pipeline(stages=stages).fit(train)
    return Regression(model, model.transform(test))


def optimality_gap(fitted: Regression, train: DataFrame) -> DataFrame:
    """How far the elastic net is from its optimum over ``train``: ``feature, coefficient, gradient, gap``.

    Per standardised feature, the squared error's gradient must equal the penalty's slope at the
    coefficient, or lie within the slopes that the penalty has at 0. ``gap`` is the distance, 0 at the
    optimum, in the label's unit; the intercept's is the mean residual. One aggregate over the rows.
    """
    z, label, net = vector_to_array("scaled_features"), F.col("max_temp_c"), fitted.model.stages[-1]
    rows = fitted.model.transform(train).withColumn("z", z).withColumn("residual", label - F.col("prediction"))
    names = list(enumerate(TEMPERATURE_FEATURES))
    sums = rows.agg(
        F.avg("residual").alias("mean_residual"),
        F.stddev_pop(label).alias("label_spread"),
        *[F.stddev_pop(F.col("z")[i]).alias(f"spread_{i}") for i, _ in names],
        *[F.covar_pop(F.col("z")[i], F.col("residual")).alias(f"pull_{i}") for i, _ in names],
    )

    def entry(i: int, name: str) -> Column:
        own = F.lit(float(net.coefficients[i])) * F.col(f"spread_{i}")
        gradient = F.coalesce(F.try_divide(F.col(f"pull_{i}"), F.col(f"spread_{i}")), F.lit(0.0))
        slope = F.signum(own) * NET_STRENGTH * NET_MIX
        slope += F.try_divide(own * NET_STRENGTH * (1 - NET_MIX), F.col("label_spread"))
        at_zero = F.greatest(F.abs(gradient) - NET_STRENGTH * NET_MIX, F.lit(0.0))
        gap = F.when(own == 0, at_zero).otherwise(F.abs(gradient - slope))
        return F.struct(F.lit(name).alias("feature"), own.alias("coefficient"), gradient.alias("gradient"), gap.alias("gap"))

    intercept = F.struct(
        F.lit("intercept").alias("feature"),
        F.lit(float(net.intercept)).alias("coefficient"),
        F.col("mean_residual").alias("gradient"),
        F.abs("mean_residual").alias("gap"),
    )
    return sums.select(F.inline(F.array(*[entry(i, n) for i, n in names], intercept)))


def regression_metrics(
    pred: DataFrame, label: str = "precipitation", prediction: str = "prediction"
) -> DataFrame:
    """RMSE, MAE and R2 in one aggregate; R2 is NULL for a constant label."""
    error = F.col(label) - F.col(prediction)
    explained = F.lit(1.0) - F.try_divide(F.avg(error * error), F.var_pop(label))
    return pred.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(~is_constant(label), explained).alias("r2"),
    )
