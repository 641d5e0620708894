import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from climagrid.operators.transforms import split
from climagrid.plans import batch, models, reports


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(5)
    rows = []
    for group, centre in enumerate([(10, 100, 1), (20, 500, 3), (30, 900, 6)]):
        for i in range(6):
            values = [float(v + rng.normal(0, 0.05 * v)) for v in centre]
            rows.append((f"city{group}{i}", "X", *values, values[0] * 2))
    rows.append(("gap", "X", None, 1.0, 1.0, 1.0))
    return spark.createDataFrame(
        rows,
        "city_name string, country string, avg_max_temp double, total_precipitation double, "
        "temp_variability double, avg_humidity double",
    )


def test_standardize(features):
    got = np.array([r.features.toArray() for r in models.standardize(features).collect()])
    assert got.shape == (18, 3)
    assert got.mean(axis=0) == pytest.approx(0, abs=1e-12)
    assert got.std(axis=0, ddof=1) == pytest.approx(1)


def test_clusters_are_a_fixed_point_and_repeat(features):
    rows = models.cluster_cities(features).collect()
    assert {r.city_name for r in rows} == {f"city{g}{i}" for g in range(3) for i in range(6)}
    points = np.array([r.features.toArray() for r in rows])
    labels = np.array([r.prediction for r in rows])
    centres = np.array([points[labels == k].mean(axis=0) for k in sorted(set(labels))])
    nearest = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == labels).all()
    groups = {frozenset(r.city_name for r in rows if r.prediction == k) for k in set(labels)}
    assert groups == {frozenset(f"city{g}{i}" for i in range(6)) for g in range(3)}
    again = {r.city_name: r.prediction for r in models.cluster_cities(features).collect()}
    assert again == {r.city_name: r.prediction for r in rows}


def test_few_cities(features):
    two = features.filter("city_name in ('city00', 'city10')")
    assert {r.prediction for r in models.cluster_cities(two).collect()} == {0, 1}
    assert models.cluster_cities(features.filter("city_name in ('city00', 'gap')")) is None
    assert models.choose_k(two) is None


def silhouette(points, labels):
    """Mean silhouette with squared distances, over all pairs."""
    square = ((points[:, None] - points) ** 2).sum(axis=2)
    scores = []
    for i, own in enumerate(labels):
        peers = (labels == own).sum() - 1
        if peers == 0:
            scores.append(0.0)
            continue
        a = square[i][labels == own].sum() / peers
        b = min(square[i][labels == k].mean() for k in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


def test_choose_k(features):
    choice = models.choose_k(features)
    scores = {r.k: r.silhouette for r in choice.scores.collect()}
    assert list(scores) == [2, 3, 4, 5, 6, 7]
    assert choice.best_k == 3 == max(scores, key=scores.get)
    rows = choice.predictions.collect()
    points = np.array([r.features.toArray() for r in rows])
    labels = np.array([r.prediction for r in rows])
    assert scores[3] == pytest.approx(silhouette(points, labels))
    few = models.choose_k(features.filter("city_name like 'city%0' or city_name = 'city01'"))
    assert [r.k for r in few.scores.collect()] == [2, 3]


def test_members(features):
    rows = models.cluster_members(models.cluster_cities(features)).collect()
    assert len(rows) == 18
    assert [(r.prediction, r.city_name) for r in rows] == sorted(
        (r.prediction, r.city_name) for r in rows
    )


@pytest.fixture(scope="module")
def year(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(1500):
        day = dt.date(2020, 1, 1) + dt.timedelta(days=i % 1000)
        humidity, rain = round(float(rng.uniform(30, 90)), 1), round(float(rng.exponential(3)), 1)
        lat, lon = (i % 7) * 0.125, (i % 5) * 0.125
        temp = round(30 - 0.1 * humidity + 2 * lat - 0.3 * rain + float(rng.normal()), 1)
        rows.append(
            (day, i % 35, f"c{i % 35}", None if i % 50 == 0 else temp,
             None if i % 40 == 0 else rain, humidity, lat, lon)
        )
    return spark.createDataFrame(
        rows,
        "weather_date date, location_id int, city_name string, max_temp_c double, "
        "precipitation_mm double, humidity_percent double, location_latitude double, "
        "location_longitude double",
    )


def test_least_squares(year):
    fitted = models.regress_precipitation(year)
    train, test = split(models.regression_rows(year), *models.SPLIT_KEYS)
    data = np.array(
        [(r.temperature, r.month, r.precipitation) for r in train.collect()], dtype=float
    )
    design = np.column_stack([np.ones(len(data)), data[:, :2]])
    expected = np.linalg.lstsq(design, data[:, 2], rcond=None)[0]
    got = [fitted.model.intercept, *fitted.model.coefficients.toArray()]
    assert got == pytest.approx(expected, rel=1e-8)
    assert fitted.predictions.count() == test.count()
    rows = fitted.predictions.collect()
    y = np.array([r.precipitation for r in rows])
    e = y - np.array([r.prediction for r in rows])
    metrics = models.regression_metrics(fitted.predictions).first()
    assert metrics.rmse == pytest.approx(np.sqrt((e**2).mean()))
    assert metrics.mae == pytest.approx(np.abs(e).mean())
    assert metrics.r2 == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())


def test_too_little_data(year):
    assert models.regress_precipitation(year.limit(10)) is None
    one_place = year.filter("location_id = 1").withColumn("weather_date", F.lit(dt.date(2020, 1, 1)))
    assert models.regress_precipitation(one_place) is None
    assert models.predict_temperature(one_place) is None


def elastic_net(x, y, strength, mix, rounds=4000):
    """Coordinate descent on standardised features and label, as the objective is defined."""
    scale = y.std(ddof=1)
    target = (y - y.mean()) / scale
    n, beta = len(y), np.zeros(x.shape[1])
    strength = strength / scale
    for _ in range(rounds):
        for j in range(x.shape[1]):
            rest = target - x @ beta + x[:, j] * beta[j]
            rho, norm = (x[:, j] * rest).sum() / n, (x[:, j] ** 2).sum() / n
            soft = np.sign(rho) * max(abs(rho) - strength * mix, 0)
            beta[j] = soft / (norm + strength * (1 - mix))
    return beta * scale


def test_elastic_net(year):
    fitted = models.predict_temperature(year)
    net = fitted.model.stages[-1]
    complete = models.temperature_rows(year)
    assert complete.count() == year.dropna(subset=["max_temp_c", "precipitation_mm"]).count()
    train, _ = split(complete, *models.SPLIT_KEYS)
    rows = fitted.model.transform(train).select("scaled_features", "max_temp_c").collect()
    x = np.array([r.scaled_features.toArray() for r in rows])
    y = np.array([r.max_temp_c for r in rows])
    assert net.coefficients.toArray() == pytest.approx(elastic_net(x, y, 0.1, 0.8), abs=1e-3)
    assert fitted.predictions.count() + len(rows) == complete.count()
    gaps = {r.feature: r for r in models.optimality_gap(fitted, train).collect()}
    assert set(gaps) == {*models.TEMPERATURE_FEATURES, "intercept"}
    assert all(r.gap < 1e-4 for r in gaps.values())
    assert {f for f, r in gaps.items() if r.coefficient == 0} and any(abs(r.coefficient) > 0.1 for r in gaps.values())
    shifted = train.withColumn("max_temp_c", F.col("max_temp_c") + F.col("humidity_percent"))
    assert max(r.gap for r in models.optimality_gap(fitted, shifted).collect()) > 0.1


@pytest.mark.parametrize("parts", [1, 3, 7, 40])
def test_a_constant_label_has_no_r2(spark, parts):
    pred = spark.range(0, 1113, 1, parts).select(
        F.lit(27.3).alias("precipitation"), (F.col("id") % 5).cast("double").alias("prediction")
    )
    found = models.regression_metrics(pred).first()
    assert found.r2 is None and found.rmse > 0


def test_extended_datasets(year):
    obs = year.withColumns(
        {
            "country": F.lit("X"),
            "min_temp_c": F.col("max_temp_c") - 5,
            "population": F.lit(1),
            "elevation": F.lit(1.0),
        }
    )
    built = batch.extended_datasets(obs)
    direct = {
        "monthly_analysis": reports.monthly_analysis(obs, extended=True),
        "extreme_cities": reports.extreme_cities(obs, scale="global"),
        "seasonal_analysis": reports.seasonal_analysis(obs, "temperate"),
        "correlations": reports.humidity_correlations(obs),
    }
    for name, df in direct.items():
        for one, other in zip(built[name].collect(), df.collect(), strict=True):
            assert one.asDict() == pytest.approx(other.asDict(), abs=0.011)
    features = reports.city_features(obs, geo=True)
    assert built["clustering_results"].count() == features.count() == 35
    assert built["temperature_predictions"].count() > 100
