import datetime as dt

import numpy as np
import pytest

from climagrid.operators.rollup import rollup
from climagrid.plans import reports

FROM_ROLLUP = {
    "monthly_analysis": reports.monthly_analysis,
    "extreme_cities": reports.extreme_cities,
    "extreme_cities_global": lambda s: reports.extreme_cities(s, scale="global"),
    "seasonal_analysis": reports.seasonal_analysis,
    "seasonal_temperate": lambda s: reports.seasonal_analysis(s, "temperate"),
    "tropical_analysis": reports.tropical_analysis,
    "precipitation_patterns": reports.precipitation_patterns,
    "cities_comparison": reports.cities_comparison,
    "temporal_patterns": reports.temporal_patterns,
    "city_features": reports.city_features,
    "correlations": reports.correlations,
}


@pytest.fixture(scope="module")
def mixed(make_obs):
    rng = np.random.default_rng(11)
    rows = []
    for city, country, n in (("A", "X", 900), ("A", "Y", 40), ("B", "X", 29), ("C", "X", 30)):
        for i in range(n):
            day = str(dt.date(2020, 1, 1) + dt.timedelta(days=i))
            temp = None if i % 13 == 5 else round(float(rng.normal(22, 4)), 1)
            rain = None if i % 17 == 3 else round(float(max(0, rng.normal(2, 8))), 1)
            rows.append((day, city, temp, rain, country))
    rows += [("2021-05-05", "dry", 20.0, None)] * 35
    rows += [("2021-05-05", "unknown", None, 3.0)] * 35
    rows += [(None, "undated", 18.0, 1.0)] * 30
    return make_obs(rows)


@pytest.mark.parametrize("name", FROM_ROLLUP)
def test_a_shared_rollup_gives_the_same_report(mixed, name):
    report = FROM_ROLLUP[name]
    direct = [r.asDict() for r in report(mixed).collect()]
    shared = [r.asDict() for r in report(rollup(mixed)).collect()]
    key = lambda r: str([v for v in r.values() if not isinstance(v, float)])
    for one, other in zip(sorted(direct, key=key), sorted(shared, key=key), strict=True):
        assert one == pytest.approx(other, abs=1e-9)


def test_reports_against_plain_python(mixed):
    rows = [r for r in mixed.collect() if r.city_name == "A" and r.country == "X"]
    warm = [r for r in rows if r.max_temp_c is not None]
    rain = [r.precipitation_mm for r in warm if r.precipitation_mm is not None]
    pick = {
        (r.city_name, r.country): r for r in reports.precipitation_patterns(mixed).collect()
    }
    got = pick["A", "X"]
    assert got.total_dias == len(warm)
    assert got.dias_con_lluvia == sum(v > 0 for v in rain)
    assert got.dias_lluvia_fuerte == sum(v > 10 for v in rain)
    assert got.dias_lluvia_intensa == sum(v > 20 for v in rain)
    assert got.precipitacion_maxima == max(rain)
    assert got.precipitacion_total_anual == pytest.approx(sum(rain), abs=0.006)
    assert got.porcentaje_dias_lluvia == pytest.approx(
        100 * sum(v > 0 for v in rain) / len(warm), abs=0.051
    )
    dry = pick["dry", "Colombia"]
    assert (dry.precipitacion_total_anual, dry.dias_con_lluvia) == (None, 0)
    assert dry.clasificacion_humedad == "Clima Seco"
    assert ("unknown", "Colombia") not in pick
    spread = {(r.city_name, r.country): r for r in reports.cities_comparison(mixed).collect()}
    temps = [r.max_temp_c for r in warm]
    assert spread["A", "X"].variabilidad_temp == pytest.approx(np.std(temps, ddof=1), abs=0.006)


def test_minimum_rows(mixed):
    extreme = {(r.city_name, r.country) for r in reports.extreme_cities(mixed).collect()}
    assert ("B", "X") not in extreme and ("C", "X") not in extreme
    assert ("undated", "Colombia") in extreme
    features = {(r.city_name, r.country): r for r in reports.city_features(mixed).collect()}
    assert ("B", "X") not in features and ("C", "X") in features
    assert features["unknown", "Colombia"].avg_max_temp is None
    assert features["unknown", "Colombia"].temp_variability is None
    assert features["unknown", "Colombia"].total_precipitation == 105.0


def test_rounded_and_unrounded_classes(make_obs):
    half = [("2022-01-01", "edge", 24.996, 3.001)] * 40
    obs = make_obs(half)
    assert reports.extreme_cities(obs).first().climate_category == "Caliente"
    assert reports.precipitation_patterns(obs).first().clasificacion_humedad == "Clima Húmedo"
    assert reports.precipitation_patterns(obs).first().precipitacion_promedio_diaria == 3.0
    tropical = make_obs([("2022-01-01", "edge", 20.0, 2.004)] * 3)
    assert reports.tropical_analysis(tropical).first().clasificacion_lluvia == "Moderado"


def test_rounding_is_half_up(make_obs):
    obs = make_obs([("2022-01-01", "c", 48.5, 0.0)] + [("2022-01-02", "c", 0.0, 0.0)] * 19)
    assert reports.monthly_analysis(obs).first().avg_max_temp == 2.43


def test_constant_elevation_has_no_correlation(make_obs):
    rows = [(f"2022-01-{i % 28 + 1:02d}", "c", float(i), float(i % 5)) for i in range(60)]
    got = reports.correlations(make_obs(rows)).first()
    expected = np.corrcoef(np.arange(60), np.arange(60) % 5)[0, 1]
    assert got.temp_precipitation_corr == pytest.approx(expected, abs=0.0006)
    assert got.temp_elevation_corr is None and got.precip_elevation_corr is None
    assert reports.correlations(make_obs(rows[:29])).count() == 0
    assert reports.correlations(make_obs(rows[:30])).count() == 1


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_correlations_from_a_rollup(make_obs, parts):
    """Over months, presence groups and partitions: as from the rows, and as numpy has it."""
    rng = np.random.default_rng(4)
    rows, expected = [], {}
    for city, base in (("a", 20.0), ("b", 1e6), ("flat", 240.1)):
        kept = []
        for i in range(400):
            day = f"20{19 + i % 3}-{i % 12 + 1:02d}-{i % 28 + 1:02d}"
            temp = base if city == "flat" else base + round(float(rng.normal()), 2)
            rain = None if i % 9 == 0 else round(max(0.0, (temp - base) + float(rng.normal())), 1)
            height = None if i % 13 == 0 else 100.0 + i % 4
            rows.append((day, city, None if i % 17 == 0 else temp, rain, "Colombia", height))
            if i % 9 and i % 13 and i % 17:
                kept.append((temp, rain, height))
        expected[city] = np.array(kept)
    rows += [("2020-01-01", "few", 1.0, 1.0, "Colombia", 1.0)] * 29
    obs = make_obs(rows).repartition(parts)
    for source in (obs, rollup(obs), rollup(obs, ("city_name", "country"))):
        found = {r.city_name: r for r in reports.correlations(source).collect()}
        assert set(found) == {"a", "b", "flat"}
        for city, values in expected.items():
            r, n = found[city], len(values)
            pairs = ((0, 1, r.temp_precipitation_corr), (0, 2, r.temp_elevation_corr), (1, 2, r.precip_elevation_corr))
            for i, j, got in pairs:
                if city == "flat" and i == 0:
                    assert got is None
                else:
                    assert got == pytest.approx(np.corrcoef(values[:, i], values[:, j])[0, 1], abs=0.0006)
            assert r.total_records == n and r.avg_elevation == round(values[:, 2].mean())
            assert r.rainy_days_ratio == pytest.approx((values[:, 1] > 0).mean(), abs=0.0006)


def test_undated_rows_fall_to_the_last_season(mixed):
    seasons = {
        r.epoca for r in reports.seasonal_analysis(mixed).collect() if r.city_name == "undated"
    }
    assert seasons == {"Época Semi-lluviosa"}
    months = [r for r in reports.tropical_analysis(mixed).collect() if r.city_name == "undated"]
    assert [(r.month, r.periodo_climatico) for r in months] == [(None, None)]


def test_default_city_notes(make_obs):
    obs = make_obs([("2022-01-01", c, 20.0, 1.0) for c in ("Medellin", "Bogota", "Cali")])
    notes = {r.city_name: r.caracteristicas_geograficas
             for r in reports.cities_comparison(obs).collect()}
    assert notes["Cali"] == "Otro"
    assert notes["Medellin"].startswith("Valle") and notes["Bogota"].startswith("Altiplano")


def test_compare_cities(make_obs):
    obs = make_obs(
        [
            ("2022-01-01", "A", 10.0, 1.0),
            ("2022-01-01", "A", 20.0, 2.0),
            ("2022-01-02", "B", 5.0, None),
            ("2022-01-03", "A", 1.0, 1.0),
        ]
    )
    rows = reports.compare_cities(obs, "A", "B", "2022-01-01", "2022-01-02").collect()
    assert [tuple(r)[1:] for r in rows] == [(15.0, 3.0, None, None), (None, None, 5.0, None)]


def test_reports_read_only_what_they_need(spark, tmp_path, mixed):
    path = str(tmp_path / "obs")
    mixed.write.parquet(path)
    report = reports.extreme_cities(spark.read.parquet(path), scale="global")
    plan = report._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"city_name", "country", "max_temp_c"}
    assert "IsNotNull(max_temp_c)" in plan
    assert plan.count("hashpartitioning") == 1


def test_large_populations_do_not_overflow(spark, make_obs):
    obs = make_obs([("2022-01-01", "c", 1.0, 1.0)] * 40, population=2_000_000_000)
    assert reports.city_features(obs).first().avg_population == 2_000_000_000.0
    part = rollup(obs).select("population__sum")
    assert part.dtypes == [("population__sum", "double")]
