import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from climagrid import functions as fn
from climagrid.functions.labels import CLIMATE_BANDS, HUMIDITY_BANDS
from climagrid.functions.stats import is_constant, sample_deviation


def values(df, col):
    return [row[col] for row in df.collect()]


def test_snap_ties_go_to_the_even_multiple(spark):
    given_values = [0.0625, 0.1875, -0.0625, 6.2214413, -75.55185, None]
    df = spark.createDataFrame([(v,) for v in given_values], "c double")
    snapped = values(df.select(fn.snap_to_grid("c").alias("s")), "s")
    assert snapped == [0.0, 0.25, -0.0, 6.25, -75.5, None]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-180, 180), min_size=1, max_size=50))
def test_snap_equals_numpy(spark, coordinates):
    df = spark.createDataFrame([(c,) for c in coordinates], "c double")
    snapped = [r.s for r in df.select("c", fn.snap_to_grid("c").alias("s")).collect()]
    assert sorted(snapped) == sorted(np.round(np.array(coordinates) / 0.125) * 0.125)


def test_bad_dates_are_null(spark):
    texts = ["2022-02-28", "2022-02-30", "soon", "", None, "2024-02-29"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert values(df.select(fn.parse_date("t").alias("d")), "d") == [
        dt.date(2022, 2, 28),
        None,
        None,
        None,
        None,
        dt.date(2024, 2, 29),
    ]


def test_calendar_and_phase(spark):
    days = ["2022-01-01", "2024-12-31", "1970-01-01", "1969-12-31"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "weather_date date")
    rows = fn.with_calendar(df).withColumn("phase", fn.epoch_phase("weather_date")).collect()
    assert [(r.year, r.month, r.day_of_year, r.phase) for r in rows] == [
        (2022, 1, 1, 13),
        (2024, 12, 366, 13),
        (1970, 1, 1, 0),
        (1969, 12, 365, -1),
    ]


@pytest.mark.parametrize(
    "scale,cases",
    [
        (
            "local",
            {25.0: "Caliente", 24.99: "Templado Cálido", 20.0: "Templado Cálido",
             15.0: "Templado", 10.0: "Fresco", 9.99: "Frío", None: "Frío"},
        ),
        (
            "global",
            {30.0: "Muy Caliente", 20.0: "Caliente", 10.0: "Templado", 0.0: "Frío",
             -0.01: "Muy Frío", None: "Muy Frío"},
        ),
    ],
)
def test_reached_bounds(spark, scale, cases):
    df = spark.createDataFrame([(v,) for v in cases], "v double")
    got = values(df.select(fn.classify("v", *CLIMATE_BANDS[scale]).alias("c")), "c")
    assert got == list(cases.values())


def test_passed_bounds(spark):
    cases = {5.01: "Clima Muy Húmedo", 5.0: "Clima Húmedo", 3.0: "Clima Moderadamente Húmedo",
             1.0: "Clima Seco", None: "Clima Seco"}
    df = spark.createDataFrame([(v,) for v in cases], "v double")
    got = values(df.select(fn.classify("v", *HUMIDITY_BANDS, op=">").alias("c")), "c")
    assert got == list(cases.values())


def test_seasons_of_a_missing_month(spark):
    df = spark.createDataFrame([(None,), (9,)], "m int").select(
        *[fn.season("m", c).alias(c) for c in ("dry_wet", "tropical", "temperate")]
    )
    assert [tuple(r) for r in df.collect()] == [
        ("Época Semi-lluviosa", None, "Otoño"),
        ("Época Semi-lluviosa", "Segunda Lluvia", "Otoño"),
    ]


def test_label_of(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert values(df.select(fn.label_of("c", {"a": "x"}, "y").alias("l")), "l") == ["x", "y", "y"]
    assert values(df.select(fn.label_of("c", {}, "y").alias("l")), "l") == ["y"] * 3


def test_correlation(spark):
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=50), rng.normal(size=50)
    rows = [("v", float(a), float(b)) for a, b in zip(x, y)] + [("v", None, 1.0), ("v", 1.0, None)]
    rows += [("c", float(i), 3.3) for i in range(40)] + [("one", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    got = dict(df.groupBy("g").agg(fn.correlation("x", "y")).collect())
    assert got["v"] == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert got["c"] is None and got["one"] is None


def test_z_score_without_spread(spark):
    rows = [(1.0, 1.0, 0.0), (3.0, 1.0, 2.0), (3.0, 1.0, None)]
    df = spark.createDataFrame(rows, "v double, m double, s double")
    assert values(df.select(fn.z_score("v", "m", "s").alias("z")), "z") == [None, 1.0, None]


def test_functions_accept_columns(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    assert df.select(fn.day_of_year(F.col("d")).alias("n")).first().n == 60


@pytest.mark.parametrize("parts", [2, 3, 7, 13, 40])
@pytest.mark.parametrize("constant", [240.0, 240.1, 27.3])
def test_a_constant_column_has_no_correlation_whatever_its_partitions(spark, parts, constant):
    """Constant, and constant only where the other is present; beside it a real correlation."""
    rows = spark.range(0, 1113, 1, parts).select(
        (F.col("id") % 17).cast("double").alias("x"),
        F.lit(constant).alias("c"),
        F.when(F.col("id") % 17 != 3, constant).otherwise(1.0).alias("d"),
        F.when(F.col("id") % 17 != 3, F.col("id") % 17).cast("double").alias("y"),
    )
    found = rows.agg(
        *[fn.correlation(a, b).alias(a + b) for a, b in ("xc", "cx", "dy", "cc", "xy", "xd")]
    ).first()
    assert (found.xc, found.cx, found.dy, found.cc) == (None, None, None, None)
    assert found.xy == pytest.approx(1.0) and found.xd is not None


def test_constancy(spark):
    nan = float("nan")
    cases = {(1.0, 1.0, None): True, (1.0, 2.0): False, (None, None): None, (nan, nan): False, (1.0, nan): False}
    for values_, expected in cases.items():
        df = spark.createDataFrame([(v,) for v in values_], "x double")
        assert df.agg(is_constant("x").alias("c")).first().c is expected
    deviations = {(1.0, 1.0, None): 0.0, (1.0, None): None, (): None, (2, 2): 0.0}
    for values_, expected in deviations.items():
        df = spark.createDataFrame([(v,) for v in values_], "x double" if not values_ or isinstance(values_[0], float) else "x int")
        assert df.agg(sample_deviation("x").alias("s")).first().s == expected
