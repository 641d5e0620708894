import datetime as dt
import gzip
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from climagrid import sources as io
from climagrid.__main__ import main
from climagrid.operators import transforms as tr
from climagrid.plans import batch, catalog, reports
from climagrid.sources import readers, writers
from climagrid.sources.schemas import LOCATION_COLUMNS, OBSERVATION_COLUMNS

# A few cities with their coordinates.
CITIES = {
    "Medellin": (6.2214413, -75.55185),
    "Bogota": (4.711, -74.0721),
    "Cali": (3.4516, -76.532),
    "Cartagena": (10.391, -75.4794),
}


def document(lat, lon, days, temps, rain):
    return {
        "latitude": lat,
        "longitude": lon,
        "generationtime_ms": 0.2,
        "utc_offset_seconds": -18000,
        "timezone": "America/Bogota",
        "timezone_abbreviation": "-05",
        "elevation": 1500.0,
        "daily_units": {"time": "iso8601", "temperature_2m_max": "°C", "precipitation_sum": "mm"},
        "daily": {"time": days, "temperature_2m_max": temps, "precipitation_sum": rain},
    }


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """A year of pretty-printed documents with some broken ones, and a location file."""
    root = tmp_path_factory.mktemp("raw")
    weather = root / "weather" / "2022"
    weather.mkdir(parents=True)
    days = [str(dt.date(2022, 1, 1) + dt.timedelta(days=i)) for i in range(365)]
    for n, (city, (lat, lon)) in enumerate(CITIES.items()):
        temps = [15.0 + 3 * n + i % 7 for i in range(365)]
        rain = [None if i % 31 == 0 else float((i * (n + 1)) % 12) for i in range(365)]
        text = json.dumps(document(lat, lon, days, temps, rain), indent=2)
        (weather / f"{city.lower()}_2022.json").write_text(text)
    (weather / "empty_2022.json").write_text(json.dumps(document(1, 1, [], [], [])))
    (weather / "error_2022.json").write_text('{"error": true, "reason": "no data"}')
    (weather / "broken_2022.json").write_text('{"latitude": 1.0, "daily": {')
    lines = [",".join(LOCATION_COLUMNS)]
    for n, (city, (lat, lon)) in enumerate(CITIES.items()):
        lines.append(f"{n + 1},{city},Colombia,{lat},{lon},{100000 * (n + 1)},{500 * n},7")
    lines.append("9,Elsewhere,Nowhere,80,80,5,5,5")
    (root / "locations.csv").write_text("\n".join(lines) + "\n")
    return str(weather / "*.json"), str(root / "locations.csv")


def test_valid_documents(spark, raw):
    docs = io.read_weather_json(spark, raw[0])
    valid, rejected = io.split_valid_documents(docs)
    assert (valid.count(), rejected.count()) == (4, 3)
    assert tr.explode_daily(valid).count() == 4 * 365


@pytest.mark.parametrize("by_city", [False, True])
def test_landed_documents_read_back(spark, raw, tmp_path, by_city):
    valid, _ = io.split_valid_documents(io.read_weather_json(spark, raw[0]))
    root = str(tmp_path / "landed")
    io.write_raw_json(valid.withColumn("city", F.lit("San Juan")), root, by_city=by_city)
    assert (tmp_path / "landed" / "year=2022").is_dir()
    assert (tmp_path / "landed" / "year=2022" / "city=san_juan").is_dir() == by_city
    assert any((tmp_path / "landed" / "year=2022").glob("slot=*")) != by_city
    back = io.read_weather_json(spark, root, multi_line=False)
    assert Counter(map(str, back.select(*valid.columns).collect())) == Counter(
        map(str, valid.collect())
    )


@pytest.mark.parametrize("by_city", [False, True])
def test_landing_keeps_other_years_and_cities(spark, raw, tmp_path, by_city):
    valid, _ = io.split_valid_documents(io.read_weather_json(spark, raw[0]))
    one, root = valid.limit(1), str(tmp_path / "landed")
    day = lambda year: F.transform("daily.time", lambda t: F.concat(F.lit(year), F.substring(t, 5, 6)))

    def land(year, city, elevation):
        moved = one.withColumn("daily", F.col("daily").withField("time", day(year)))
        moved = moved.withColumn("elevation", F.lit(elevation)).withColumn("city", F.lit(city))
        io.write_raw_json(moved, root, by_city=by_city)

    for step in (("2021", "A", 1.0), ("2022", "A", 2.0), ("2022", "B", 3.0), ("2022", "A", 4.0)):
        land(*step)
    back = spark.read.json(root)
    found = sorted((r.year, r.city, r.elevation) for r in back.select("year", "city", "elevation").collect())
    assert found == [(2021, "a", 1.0), (2022, "a", 4.0), (2022, "b", 3.0)]


def test_a_late_city_rewrites_its_slot_alone(spark, raw, tmp_path):
    valid, _ = io.split_valid_documents(io.read_weather_json(spark, raw[0]))
    cities = F.explode(F.array(*[F.lit(f"Town {i}") for i in range(60)]))
    landed, root = valid.limit(1).withColumn("city", cities), tmp_path / "landed"
    io.write_raw_json(landed, str(root))
    slots = lambda: {p.name: sorted(f.name for f in p.iterdir()) for p in (root / "year=2022").glob("slot=*")}
    before = slots()
    late = landed.where("city = 'Town 7'").withColumn("elevation", F.lit(-1.0))
    io.write_raw_json(late.unionAll(late), str(root))
    changed = [name for name, files in slots().items() if before[name] != files]
    assert len(before) > 10 and len(changed) == 1
    back = spark.read.json(str(root)).select("city", "elevation").collect()
    assert Counter(r.city for r in back) == Counter({f"town_{i}": 1 for i in range(60)} | {"town_7": 2})
    assert {r.elevation for r in back if r.city == "town_7"} == {-1.0}
    # A landing may read the root that it lands in.
    io.write_raw_json(spark.read.json(str(root)).drop("year", "slot").withColumn("elevation", F.lit(5.0)), str(root))
    assert {r.elevation for r in spark.read.json(str(root)).collect()} == {5.0}


@pytest.mark.parametrize("by_city", [False, True])
def test_landed_files_are_small_and_sorted(spark, raw, tmp_path, by_city):
    valid, _ = io.split_valid_documents(io.read_weather_json(spark, raw[0]))
    cities = F.explode(F.array(*[F.lit(f"Town {i % 5}") for i in range(50)]))
    io.write_raw_json(valid.limit(1).withColumn("city", cities), str(tmp_path / "landed"), by_city)
    files = [p for p in (tmp_path / "landed").rglob("part-*")]
    lines = {p: gzip.decompress(p.read_bytes()).splitlines() for p in files}
    assert sum(map(len, lines.values())) == 50
    assert sum(p.stat().st_size for p in files) * 5 < sum(len(x) for found in lines.values() for x in found)
    for found in lines.values():
        names = [json.loads(line).get("city") for line in found]
        assert by_city or names == sorted(names)


def test_locations_csv(spark, raw, tmp_path):
    locations = io.read_locations_csv(spark, raw[1])
    path = str(tmp_path / "locations")
    io.write_locations_csv(locations, path)
    assert Counter(io.read_locations_csv(spark, path).collect()) == Counter(locations.collect())
    assert tr.snap_extract(locations).first().latitude == 6.25


def test_jdbc_options(monkeypatch):
    """The options handed to Spark; no database is started for it."""
    seen = {}

    class Read:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return self

        def select(self, *columns):
            return columns

    class Session:
        read = Read()

    columns = readers.read_locations_jdbc(
        Session(), "jdbc:x:y", "locations", {"user": "u"}, bounds=(1, 900), partitions=4
    )
    assert columns == LOCATION_COLUMNS
    assert seen["format"] == "jdbc" and seen["dbtable"] == "locations" and seen["user"] == "u"
    assert (seen["lowerBound"], seen["upperBound"], seen["numPartitions"]) == ("1", "900", "4")
    seen.clear()
    readers.read_locations_jdbc(Session(), "jdbc:x:y", "locations")
    assert "partitionColumn" not in seen


def rows(df):
    return Counter(map(tuple, df.select(*OBSERVATION_COLUMNS).collect()))


@pytest.fixture(scope="module")
def several_years(make_obs):
    days = [dt.date(2019, 12, 1) + dt.timedelta(days=i) for i in range(800)]
    return make_obs(
        [(str(d), c, float(i % 30), 1.0) for i, d in enumerate(days) for c in ("A", "B")]
        + [(None, "A", 1.0, 1.0)]
    )


def test_observations_by_year(spark, several_years, tmp_path):
    path = str(tmp_path / "trusted")
    io.write_observations(several_years, path)
    assert {p.name for p in (tmp_path / "trusted").glob("weather_year=*")} == {
        "weather_year=2019",
        "weather_year=2020",
        "weather_year=2021",
        "weather_year=2022",
        "weather_year=__HIVE_DEFAULT_PARTITION__",
    }
    assert rows(io.read_observations(spark, path)) == rows(several_years)
    for file in (tmp_path / "trusted" / "weather_year=2020").glob("*.parquet"):
        days = [r.weather_date for r in spark.read.parquet(str(file)).collect()]
        assert days == sorted(days)
    span = io.read_observations(spark, path, "2020-02-01", "2020-03-31")
    assert rows(span) == rows(
        several_years.filter("weather_date between '2020-02-01' and '2020-03-31'")
    )
    plan = span._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(weather_year" in plan
    assert "PushedFilters: [IsNotNull(weather_date)" in plan


def test_a_heavy_year_is_split_over_files(spark, make_obs, tmp_path):
    day = make_obs([("2022-05-05", "A", 1.0, 1.0)]).first().asDict()
    values = {c: F.lit(v) for c, v in day.items()} | {"max_temp_c": F.rand(1)}
    heavy = spark.range(0, 50000, 1, 16).select(*[v.alias(c) for c, v in values.items()])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    try:
        io.write_observations(heavy, str(tmp_path / "trusted"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "trusted" / "weather_year=2022").glob("*.parquet"))) > 3
    assert io.read_observations(spark, str(tmp_path / "trusted")).count() == 50000


def test_a_sorted_write_stays_within_memory(spark, make_obs, tmp_path):
    """Also of a year that one task has read, and whatever partitions the session asks for."""
    day = make_obs([("2022-05-05", "A", 1.0, 1.0)]).first().asDict()
    values = {c: F.lit(v) for c, v in day.items()}
    values |= {"weather_date": F.expr("date_add(date'2022-01-01', cast(id % 365 as int))"), "max_temp_c": F.rand(1)}
    values |= {"precipitation_mm": F.rand(2), "elevation": F.rand(3)}
    year = spark.range(0, 1_200_000, 1, 1).select(*[v.alias(c) for c, v in values.items()])
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for asked in ("512MB", None):
        spark.conf.unset(setting) if asked is None else spark.conf.set(setting, asked)
        try:
            io.write_observations(year, str(tmp_path / "trusted"))
            assert spark.conf.get(setting, None) == asked
        finally:
            spark.conf.unset(setting)
        files = list((tmp_path / "trusted" / "weather_year=2022").glob("*.parquet"))
        assert len(files) > 1 and spark.read.parquet(*map(str, files)).count() == 1_200_000


def test_sorted_partitions_give_the_setting_back(spark):
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for asked, meant in (("50KB", "50KB"), ("16m", "16m"), ("67108864b", str(16 << 20)), ("1g", str(16 << 20))):
        spark.conf.set(setting, asked)
        try:
            with writers.sorted_partitions(spark), pytest.raises(ValueError), writers.sorted_partitions(spark):
                assert spark.conf.get(setting) == meant
                raise ValueError
            assert spark.conf.get(setting) == asked
        finally:
            spark.conf.unset(setting)


def test_observations_in_global_order(spark, several_years, tmp_path):
    path = str(tmp_path / "trusted")
    io.write_observations(several_years, path, ordered=True)
    back = io.read_observations(spark, path, "2020-02-01")
    assert rows(back) == rows(several_years.filter("weather_date >= '2020-02-01'"))
    ranges = []
    for file in sorted(p for p in (tmp_path / "trusted").glob("*.parquet")):
        found = [(r.weather_date, r.city_name) for r in spark.read.parquet(str(file)).collect()]
        found = [(d or dt.date.min, c) for d, c in found]
        assert found == sorted(found)
        ranges += found[:1] + found[-1:]
    assert ranges == sorted(ranges)


def test_load_table_replaces(spark, several_years, tmp_path):
    assert io.load_table(several_years, "weather_obs") == 1601
    assert io.load_table(several_years.filter("city_name = 'B'"), "weather_obs") == 800
    assert io.read_table(spark, "weather_obs").count() == 800
    spark.sql("DROP TABLE weather_obs")


def failing(df, column="max_temp_c"):
    """Rows that raise half-way."""
    broken = F.when(F.col("weather_date") == "2021-06-01", F.raise_error(F.lit("half-way"))).otherwise(F.col(column))
    return df.withColumn(column, broken).repartition(8, "weather_date")


@pytest.mark.parametrize("placed", [False, True])
def test_a_failed_load_leaves_the_table(spark, several_years, tmp_path, placed):
    name, path = f"kept_{placed}".lower(), str(tmp_path / "table") if placed else None
    assert io.load_table(several_years, name, path) == 1601
    with pytest.raises(Exception, match="half-way"):
        io.load_table(failing(several_years), name, path)
    assert rows(io.read_table(spark, name)) == rows(several_years)
    reading = io.read_table(spark, name)  # begun before the next load, ended after it
    other = several_years.filter("city_name = 'B'")
    assert io.load_table(other, name, path) == 800
    assert rows(reading) == rows(several_years)
    assert rows(io.read_table(spark, name)) == rows(other)
    assert io.load_table(other.withColumn("more", F.lit(1)), name, path) == 800  # other columns
    assert io.read_table(spark, name).columns[-1] == "more"
    if placed:
        assert len(list((tmp_path / "table").glob("version-*.current"))) == 2
    spark.sql(f"DROP TABLE {name}")


def test_a_load_takes_over_a_table_of_others(spark, several_years):
    several_years.limit(5).write.saveAsTable("taken_over")
    with pytest.raises(Exception, match="half-way"):
        io.load_table(failing(several_years), "taken_over")
    assert io.read_table(spark, "taken_over").count() == 5
    assert io.load_table(several_years, "taken_over") == 1601
    spark.sql("DROP TABLE taken_over")


def test_a_failed_dataset_leaves_the_published_one(spark, several_years, tmp_path):
    root = str(tmp_path / "refined")
    place = tmp_path / "refined" / "ml_analytics_results" / "anomalies"
    save = lambda df: io.save_dataset(df, root, "ml_analytics", "anomalies")
    get = lambda: rows(catalog.get_dataset(spark, root, "anomalies", 0))
    listed = lambda: [tuple(r) for r in catalog.list_datasets(spark, root).collect()]
    with pytest.raises(Exception, match="half-way"):
        save(failing(several_years))
    with pytest.raises(ValueError, match="no data"):
        catalog.get_dataset(spark, root, "anomalies")
    several_years.limit(7).coalesce(1).write.parquet(str(place), mode="append")  # flat files, as others write
    assert catalog.get_dataset(spark, root, "anomalies", 0).count() == 7
    assert listed() == [("anomalies", "ml_analytics", 1)]
    save(several_years.repartition(3))
    reading = catalog.get_dataset(spark, root, "anomalies", 0)
    with pytest.raises(Exception, match="half-way"):
        save(failing(several_years))
    assert get() == rows(several_years)
    save(several_years.filter("city_name = 'B'").repartition(2))
    assert rows(reading) == rows(several_years)  # its version stays for one more
    assert listed() == [("anomalies", "ml_analytics", 2)]
    save(several_years.repartition(4))
    assert get() == rows(several_years) and listed() == [("anomalies", "ml_analytics", 4)]
    versions = sorted(p.name for p in place.iterdir() if not p.name.startswith("."))
    assert len(versions) == 4 and sum(v.endswith(".current") for v in versions) == 2


def test_an_unfinished_version_is_not_read(spark, several_years, tmp_path):
    """As left by a job that was killed: a folder without its pointer."""
    root = str(tmp_path / "refined")
    path = io.save_dataset(several_years.limit(3), root, "ml_analytics", "anomalies")
    unfinished = path.rsplit("/", 1)[0] + "/version-" + "9" * 20 + "-x"
    several_years.write.parquet(unfinished)
    assert catalog.get_dataset(spark, root, "anomalies", 0).count() == 3
    assert [r.file_count for r in catalog.list_datasets(spark, root).collect()] == [1]


def test_export(spark, several_years, tmp_path):
    report = reports.precipitation_patterns(several_years)
    io.export_dataset(report, str(tmp_path / "j"))
    lines = [
        json.loads(line)
        for file in (tmp_path / "j").glob("*.json")
        for line in file.read_text().splitlines()
    ]
    assert {line["city_name"] for line in lines} == {"A", "B"}
    io.export_dataset(report, str(tmp_path / "c"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == report.columns
    with pytest.raises(ValueError):
        io.export_dataset(report, str(tmp_path / "x"), "xml")


@pytest.fixture(scope="module")
def refined(spark, raw, tmp_path_factory):
    root = tmp_path_factory.mktemp("zones")
    folders = main([*raw, str(root / "trusted"), str(root / "refined"), "--table", "batch_obs"])
    return str(root / "trusted"), str(root / "refined"), folders


def test_batch_writes_all_datasets(spark, refined):
    trusted, root, folders = refined
    obs = io.read_observations(spark, trusted)
    assert obs.columns == OBSERVATION_COLUMNS and obs.count() == 4 * 365
    assert io.read_table(spark, "batch_obs").count() == 4 * 365
    assert set(folders) == set(catalog.DATASETS) - {"temperature_predictions"}
    assert spark.read.json(f"{trusted}_rejected").count() == 3
    monthly = catalog.get_dataset(spark, root, "monthly_analysis", 0)
    assert monthly.count() == 48
    assert Counter(monthly.collect()) == Counter(reports.monthly_analysis(obs).collect())
    assert catalog.get_dataset(spark, root, "clustering_results").count() == 4
    predicted = catalog.get_dataset(spark, root, "regression_results", 0)
    assert set(predicted.columns) == {
        "temperature", "precipitation", "city_name", "month", "year", "features", "prediction"
    }


@pytest.mark.parametrize("broken", [0, 2])
def test_documents_are_parsed_again_only_for_rejected_ones(spark, tmp_path, monkeypatch, broken):
    parsed = spark.sparkContext.accumulator(0)
    days = [str(dt.date(2022, 1, 1) + dt.timedelta(days=i)) for i in range(30)]
    docs = [document(*place, days, [20.0 + i % 7 for i in range(30)], [float(i % 5) for i in range(30)]) for place in CITIES.values()]
    docs += [document(1, 1, [], [], [])] * broken
    (tmp_path / "docs.json").write_text("\n".join(map(json.dumps, docs)))
    lines = [",".join(LOCATION_COLUMNS), *[f"{n},{c},Colombia,{x},{y},1,2,3" for n, (c, (x, y)) in enumerate(CITIES.items())]]
    (tmp_path / "locations.csv").write_text("\n".join(lines))
    seen = F.udf(lambda x: (parsed.add(1), x)[1], "double").asNondeterministic()
    read = readers.read_weather_json
    monkeypatch.setattr(batch, "read_weather_json", lambda *a: read(*a).withColumn("latitude", seen("latitude")))
    monkeypatch.setattr(batch, "refine", lambda *a: {})
    trusted = str(tmp_path / "trusted")
    batch.run_batch(spark, str(tmp_path / "docs.json"), str(tmp_path / "locations.csv"), trusted, "unused", multi_line=False)
    assert io.read_observations(spark, trusted).count() == 4 * 30
    kept = spark.read.schema("elevation DOUBLE, daily STRUCT<time: ARRAY<STRING>>").json(batch.rejected_path(trusted))
    assert [(r.elevation, r.daily.time) for r in kept.collect()] == [(1500.0, [])] * broken
    assert parsed.value == (12 if broken else 4)


def test_the_raw_zone_of_the_batch_is_small(spark, tmp_path):
    """The landed documents were three quarters of what the batch wrote and shuffled."""
    from climagrid.checks.queries import _town, retail

    valid, _ = io.split_valid_documents(retail.weather_documents(spark, "/root/testdata/sf0.001"))
    io.write_raw_json(valid.withColumn("city", _town()), str(tmp_path / "landed"))
    size = sum(p.stat().st_size for p in (tmp_path / "landed").rglob("part-*"))
    assert size < 120 * valid.count()  # plain lines have 400 bytes


def test_the_older_set_of_datasets(spark, tmp_path):
    from climagrid.checks.queries import retail

    trusted, root = str(tmp_path / "trusted"), str(tmp_path / "refined")
    retail.extended_observations(spark, "/root/testdata/sf0.001").write.parquet(trusted)
    folders = main(["-", "-", trusted, root, "--older"])
    assert "temperature_predictions" in folders and "humidity" not in folders
    monthly = catalog.get_dataset(spark, root, "monthly_analysis", 0)
    assert "avg_humidity" in monthly.columns
    assert catalog.get_dataset(spark, root, "temperature_predictions").count() == 100


def test_catalog(spark, refined, tmp_path):
    _, root, _ = refined
    listed = catalog.list_datasets(spark, root).collect()
    expected = {k: v for k, v in catalog.DATASETS.items() if k != "temperature_predictions"}
    assert {r.name: r.category for r in listed} == expected
    assert all(r.file_count >= 1 for r in listed)
    assert [(r.category, r.name) for r in listed] == sorted((r.category, r.name) for r in listed)


def test_get_dataset(spark, refined, tmp_path):
    _, root, _ = refined
    assert catalog.get_dataset(spark, root, "monthly_analysis", 5).count() == 5
    spark.range(3).write.parquet(str(tmp_path / "loose"))
    assert catalog.get_dataset(spark, str(tmp_path), "loose").count() == 3
    with pytest.raises(ValueError, match="no data"):
        catalog.get_dataset(spark, root, "nothing")
    with pytest.raises(ValueError, match="available"):
        catalog.get_dataset(spark, root, "")
