import datetime as dt
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from climagrid.operators import anomalies as an
from climagrid.operators import joins, ordering, quality
from climagrid.operators import transforms as tr
from climagrid.operators.rollup import rollup
from climagrid.plans import batch
from climagrid.sources import scratch
from climagrid.sources.schemas import LOCATION_CSV, WEATHER_DOCUMENT
from climagrid.sources.scratch import materialize, scratch_path


def document(lat, lon, daily):
    return (lat, lon, 0.1, 0, "UTC", "UTC", 10.0, None, daily)


def test_explode_pads_short_arrays(spark):
    docs = spark.createDataFrame(
        [
            document(1.0, 2.0, (["2022-01-01", "2022-01-02", "bad"], [1.0, None], [0.5])),
            document(3.0, 4.0, (["2022-01-01"], [9.0], None)),
            document(5.0, 6.0, None),
        ],
        WEATHER_DOCUMENT,
    )
    rows = tr.explode_daily(docs.select("latitude", "daily")).collect()
    assert [tuple(r) for r in rows] == [
        (1.0, dt.date(2022, 1, 1), 1.0, 0.5),
        (1.0, dt.date(2022, 1, 2), None, None),
        (1.0, None, None, None),
    ]


def test_prepare_locations_casts(spark):
    rows = [("7", "A", "B", "6.22", "-75.55", "many", "x", "1"), (None,) * 8]
    prepared = tr.prepare_locations(spark.createDataFrame(rows, LOCATION_CSV)).collect()
    assert tuple(prepared[0]) == (7, "A", "B", 6.25, -75.5, None, None)
    assert tuple(prepared[1]) == (None,) * 7


def test_two_locations_in_a_cell_both_get_its_weather(spark):
    docs = spark.createDataFrame(
        [
            document(6.24, -75.5, (["2022-01-01", "2022-01-02"], [1.0, 2.0], [0.0, 3.0])),
            document(0.01, 0.01, (["2022-01-01"], [5.0], [5.0])),
        ],
        WEATHER_DOCUMENT,
    )
    locations = spark.createDataFrame(
        [
            ("1", "North", "C", "6.22", "-75.55", "10", "1500", "0"),
            ("2", "South", "C", "6.26", "-75.51", "20", "1400", "0"),
            ("3", "Away", "C", "50", "50", "30", "0", "0"),
            ("4", "Nowhere", "C", None, "50", "30", "0", "0"),
        ],
        LOCATION_CSV,
    )
    got = Counter(map(tuple, batch.trusted_observations(docs, locations).collect()))
    day = dt.date(2022, 1, 1), dt.date(2022, 1, 2)
    assert got == Counter(
        (d, i, name, "C", temp, rain, population, height)
        for i, name, population, height in ((1, "North", 10, 1500.0), (2, "South", 20, 1400.0))
        for d, temp, rain in ((day[0], 1.0, 0.0), (day[1], 2.0, 3.0))
    )


@pytest.mark.parametrize("broadcast_bytes,key_rows", [(joins.BROADCAST_BYTES, 200), (0, 200), (0, 5000)])
def test_grid_join_with_a_heavy_cell(spark, broadcast_bytes, key_rows):
    weather = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0.125).otherwise(F.col("id") * 0.125).alias("latitude"),
        F.lit(0.0).alias("longitude"),
    )
    places = spark.range(3000).select(
        F.col("id").cast("int").alias("location_id"),
        (F.col("id") * 0.125).alias("location_latitude"),
        F.lit(-0.0).alias("location_longitude"),
    )
    joined = joins.join_on_grid(weather, places, broadcast_bytes, key_rows)
    assert joined.count() == 3000
    assert joined.filter("location_id = 1").count() == 1001
    assert not [c for c in joined.columns if c.startswith("__")]


def test_only_heavy_keys_are_copied(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") < 1500, 7).when(F.col("id") < 1550, 8).otherwise(F.col("id")).alias("k"), "id"
    )
    found = {r["k"]: r["__parts"] for r in joins.heavy_keys(rows, ["k"], 100).collect()}
    assert found == {7: 15}
    lookup = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    lookup = lookup.withColumn("n", F.when(F.col("k") == 7, 1500).otherwise(1)).unionAll(
        spark.createDataFrame([(7, 15, 1500), (None, 1, 1)], "k bigint, w bigint, n int")
    )
    expected = sorted((r.k, r.id, w) for r in rows.collect() for w in {r.k * 2} | ({15} if r.k == 7 else set()))
    for weight in (None, "n"):
        joined = joins.lookup_join(rows, lookup, ["k"], broadcast_bytes=0, key_rows=100, weight=weight)
        assert sorted(map(tuple, joined.select("k", "id", "w").collect())) == expected
        text = joined._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("Generate") == 1  # lookup rows are copied, rows are not


def test_copies_of_a_row_spread_over_the_salted_join(spark):
    rows = spark.range(0, 16000, 1, 32).select(F.lit("a").alias("k"), F.lit(1.0).alias("v"))
    lookup = spark.createDataFrame([("a", 2.0), ("b", 3.0)], "k string, w double")
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = joins.lookup_join(rows, lookup, ["k"], broadcast_bytes=0, key_rows=500)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sum(s["count"] for s in sizes) == 16000
    assert len(sizes) > 3 and max(s["count"] for s in sizes) < 8000


def test_table_bytes(spark):
    df = spark.createDataFrame([("é" * 50, 1), (None, 2)], "t string, n int")
    assert joins.table_bytes(df) == 100 + 2 * (32 + 2 * 16)
    assert joins.table_bytes(df.filter("false")) == 0


def test_null_filters(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (None, 1.0), (1.0, None), (float("nan"), 1.0)], "a double, b double"
    )
    assert tr.require_not_null(df, ["a", "b"]).count() == 2
    assert tr.require_not_null(df, ["b"]).count() == 3
    assert tr.drop_null(df, ["a", "b"]).count() == 1


def test_select_series(make_obs):
    obs = make_obs(
        [
            ("2022-01-02", "B", 1.0, 0.0),
            ("2022-01-02", "A", 2.0, 0.0),
            ("2022-01-01", "B", 3.0, 0.0),
            ("2022-01-03", "A", 4.0, 0.0),
            ("2022-01-02", "C", 5.0, 0.0),
        ]
    )
    rows = tr.select_series(obs, ["A", "B"], "2022-01-01", "2022-01-02").collect()
    assert [(r.city_name, r.max_temp_c) for r in rows] == [("B", 3.0), ("A", 2.0), ("B", 1.0)]
    assert tr.select_series(obs, [], "2022-01-01", "2022-01-02").count() == 0


def test_split_is_a_partition_and_ignores_the_layout(spark):
    df = spark.range(20000).withColumn("k", F.col("id").cast("string"))
    train, test = tr.split(df, "k")
    ids = {r.id for r in train.collect()}
    assert ids == {r.id for r in tr.split(df.repartition(13), "k")[0].collect()}
    assert ids.isdisjoint({r.id for r in test.collect()})
    assert len(ids) + test.count() == 20000
    assert abs(len(ids) / 20000 - 0.8) < 0.01
    assert ids != {r.id for r in tr.split(df, "k", seed=43)[0].collect()}


def test_project_filter_error(spark):
    df = spark.createDataFrame([("x", 1.005, 2.0), ("y", None, 1.0)], "n string, a double, b double")
    assert tr.project(df, {"m": "n"}).columns == ["m"]
    assert tr.filter_result(df, "a < 2").count() == 1
    assert [r.error for r in tr.with_error(df, "a", "b").collect()] == [-1.0, None]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None]), st.sampled_from([0.5, None])),
        max_size=60,
    )
)
def test_sorted_rows_keeps_every_copy(spark, monkeypatch, rows):
    monkeypatch.setattr(ordering, "_COPIES_PER_CHUNK", 3)
    df = spark.createDataFrame(rows, "k int, c string, v double")
    got = [tuple(r) for r in ordering.sorted_rows(df, "k", fold_copies=True).collect()]
    assert Counter(got) == Counter(rows)
    assert [g[0] for g in got] == sorted(r[0] for r in rows)


@pytest.mark.parametrize("fold", [False, True])
def test_sorted_rows_leaves_values_as_they_are(spark, fold):
    rows = [(1, -0.0), (1, 0.0), (0, float("nan")), (1, -0.0), (0, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = [str(r.v) for r in ordering.sorted_rows(df, "k", fold_copies=fold).collect()]
    assert Counter(got) == Counter(str(v) for _, v in rows)


def test_sorted_rows_takes_one_shuffle(spark):
    df = spark.range(100).select(F.xxhash64("id").alias("v"), (F.col("id") % 3).alias("k"))
    plan = ordering.sorted_rows(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange") == 1


def test_large_values_with_a_small_spread_keep_it(spark):
    from climagrid.operators.joins import group_stats

    rows = spark.range(4000).selectExpr(
        "'a' AS city_name", "'X' AS country", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS weather_date",
        "1e6 + (id % 5) * 0.01 AS max_temp_c", "1.0 AS precipitation_mm",
    )
    merged = group_stats(rollup(rows), ["city_name"], {"max_temp_c": "temp"}).first().std_temp
    direct = group_stats(rows, ["city_name"], {"max_temp_c": "temp"}).first().std_temp
    assert merged == pytest.approx(direct, rel=1e-6)


def test_sorted_rows_descending(spark):
    df = spark.createDataFrame([(1, "x"), (3, "y"), (2, "z"), (3, "y")], "k int, c string")
    assert [r.k for r in ordering.sorted_rows(df, F.desc("k")).collect()] == [3, 3, 2, 1]


def test_copies_of_one_row_are_spread_by_the_sort(spark, monkeypatch):
    monkeypatch.setattr(ordering, "_COPIES_PER_CHUNK", 100)
    df = spark.range(20000).select(F.lit(1).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ordering.sorted_rows(df, "k", fold_copies=True).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(p["count"] for p in parts) == 20000
    assert len(parts) > 4 and max(p["count"] for p in parts) < 10000


def test_head(spark):
    df = spark.range(10)
    assert [r.id for r in ordering.head(df, 3, F.desc("id")).collect()] == [9, 8, 7]
    assert ordering.head(df, 0).count() == 10
    assert ordering.head(df, 3).count() == 3
    assert [r.id for r in ordering.sorted_by(df, F.desc("id")).take(1)] == [9]


def brute_anomalies(rows):
    cities = {}
    for day, city, temp, rain in rows:
        cities.setdefault(city, []).append((temp, rain))
    found = Counter()
    for day, city, temp, rain in rows:
        scores = []
        for i, value in enumerate((temp, rain)):
            known = [v[i] for v in cities[city] if v[i] is not None]
            std = np.std(known, ddof=1) if len(known) > 1 else 0.0
            score = (value - np.mean(known)) / std if value is not None and std > 0 else None
            scores.append(score)
        if any(s is not None and abs(s) > 2 for s in scores):
            found[day, city] += 1
    return found


@pytest.mark.parametrize("shared", [False, True])
@pytest.mark.parametrize("broadcast_bytes", [joins.BROADCAST_BYTES, 0])
def test_anomalies_against_brute_force(make_obs, broadcast_bytes, shared):
    rng = np.random.default_rng(3)
    rows = [("2022-01-01", "single", 5.0, 1.0), ("2022-02-02", None, 1.0, 1.0)]
    for city, n in (("heavy", 400), ("light", 40), ("flat", 30)):
        for i in range(n):
            day = str(dt.date(2022, 1, 1) + dt.timedelta(days=i % 300))
            temp = 20.1 if city == "flat" else float(rng.normal(20, 5))
            rain = None if i % 7 == 0 else float(rng.exponential(3))
            rows.append((day, city, None if i % 11 == 0 else temp, rain))
    expected = brute_anomalies([r for r in rows if r[1]])
    obs = make_obs(rows)
    source = rollup(obs) if shared else None
    got = an.anomalies(obs, source=source, broadcast_bytes=broadcast_bytes).collect()
    assert Counter((str(r.weather_date), r.city_name) for r in got) == expected
    assert [r.weather_date for r in got] == sorted(r.weather_date for r in got)
    assert all(r.temp_z_score is None for r in got if r.city_name == "flat")


@pytest.mark.parametrize("parts", [1, 2, 3, 7, 13, 40])
def test_a_constant_city_has_no_anomaly_whatever_its_partitions(make_obs, parts):
    rows = [
        (str(dt.date(2019, 1, 1) + dt.timedelta(days=i)), city, value, value)
        for city, value in (("a", 27.3), ("b", 240.1), ("c", 240.0), ("d", 0.1))
        for i in range(1113)
    ]
    rows += [("2022-12-31", "e", 20.0 + (i % 5), 100.0 if i == 7 else 1.0) for i in range(60)]
    obs = make_obs(rows).repartition(parts)
    found = [r for s in (None, rollup(obs)) for r in an.anomalies(obs, source=s).collect()]
    assert Counter(r.city_name for r in found) == {"e": 2}
    stats = joins.group_stats(obs, ["city_name"], {"max_temp_c": "temp", "precipitation_mm": "rain"}).collect()
    assert {r.city_name: (r.std_temp, r.std_rain) for r in stats if r.city_name != "e"} == {
        c: (0.0, 0.0) for c in "abcd"
    }


def test_group_stats_join_is_not_a_shuffle_of_the_facts(spark, make_obs):
    obs = make_obs([("2022-01-01", "A", 1.0, 0.0), ("2022-01-02", "A", 2.0, 0.0)])
    joined = joins.with_group_stats(obs, ["city_name"], {"max_temp_c": "temp"})
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_null_profile(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None), (None, float("nan"), dt.date(2022, 1, 1)), (3, None, None)],
        "i int, x double, d date",
    )
    got = {r.column_name: (r.column_type, r.total_rows, r.null_count, r.null_pct)
           for r in quality.null_profile(df).collect()}
    assert got == {
        "i": ("int", 3, 1, 33.33),
        "x": ("double", 3, 2, 66.67),
        "d": ("date", 3, 2, 66.67),
    }
    empty = quality.null_profile(df.filter("false"), ["i"]).collect()
    assert [(r.null_count, r.null_pct) for r in empty] == [(0, None)]


def test_quality_of_a_column(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    assert tuple(quality.column_stats(df, "x").first()) == (1.0, 4.0, 2.33, 1.53)
    same = spark.range(0, 1113, 1, 7).select(F.lit(27.3).alias("x"))
    assert quality.column_stats(same, "x", 30).first().stddev_value == 0.0
    assert quality.column_stats(df.where("x = 4"), "x").first().stddev_value is None
    assert quality.distinct_count(df, "x").first()[0] == 4
    assert quality.distinct_count(df, "x", approximate=True).first()[0] == 3
    assert [r.x for r in quality.available_values(df, "x").collect()] == [None, 1.0, 2.0, 4.0]


def test_row_distribution_order(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string")
    assert [tuple(r) for r in quality.row_distribution(df, "k").collect()] == [
        ("b", 2),
        ("a", 1),
        ("c", 1),
    ]


def test_materialize_lands_in_the_shared_folder(spark):
    kept = materialize(spark.range(5), "numbers")
    root = scratch_path(spark, "numbers").rsplit("/", 1)[0]
    assert kept.count() == 5
    assert all(root in path for path in kept.inputFiles())
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or root.startswith(named)


class Session:
    """As much of a session as the scratch area asks for."""

    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}


def test_scratch_folder_of_each_kind_of_session():
    cluster = Session(spark_master="yarn", spark_app_id="c")
    named = Session(spark_master="yarn", spark_app_id="n", spark_checkpoint_dir="s3://b/x/")
    local = Session(spark_master="local[2]", spark_app_id="l")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(cluster, "t")
    assert scratch_path(named, "t").startswith("s3://b/x/climagrid/t-")
    first, second = scratch_path(local, "t"), scratch_path(local, "t")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_a_job_removes_what_it_kept(spark):
    import os

    with scratch.job_scratch(spark):
        path = materialize(spark.range(3), "t").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)
