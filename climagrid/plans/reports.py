"""Descriptive reports.

Each takes observations, or (but for the correlations with humidity) the result of ``rollup``. Column names
and labels are those of the published datasets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.functions.labels import (
    CITY_NOTES,
    CLIMATE_BANDS,
    HUMIDITY_BANDS,
    OTHER_CITY,
    RAIN_BANDS,
    classify,
    label_of,
    season,
)
from climagrid.functions.stats import correlation
from climagrid.operators import rollup as r
from climagrid.operators.ordering import sorted_by
from climagrid.operators.rollup import MONTHLY_GRAIN, PLACE, rolled
from climagrid.operators.transforms import require_not_null

TEMP, RAIN = "max_temp_c", "precipitation_mm"
LOW_TEMP, HUMIDITY = "min_temp_c", "humidity_percent"

# Result column -> pair of measures.
CORRELATION_PAIRS = {
    "temp_precipitation_corr": (TEMP, RAIN),
    "temp_elevation_corr": (TEMP, "elevation"),
    "precip_elevation_corr": (RAIN, "elevation"),
}
HUMIDITY_PAIRS = {
    "temp_humidity_corr": (TEMP, HUMIDITY),
    "temp_precipitation_corr": (TEMP, RAIN),
}


def monthly_analysis(source: DataFrame, extended: bool = False) -> DataFrame:
    """Temperature and rain by city, year and month.

    ``extended`` reports lowest temperature, humidity and variability in place of mean rain.
    """
    if extended:
        measures = {
            "avg_max_temp": r.mean(TEMP),
            "avg_min_temp": r.mean(LOW_TEMP),
            "total_precipitation": r.total(RAIN),
            "avg_humidity": r.mean(HUMIDITY),
            "days_with_data": r.rows(),
            "temp_variability": r.deviation(TEMP),
        }
    else:
        measures = {
            "avg_max_temp": r.mean(TEMP),
            "total_precipitation": r.total(RAIN),
            "avg_precipitation": r.mean(RAIN),
            "days_with_data": r.rows(),
        }
    groups = rolled(source, MONTHLY_GRAIN, need=[TEMP]).groupBy(*MONTHLY_GRAIN)
    return sorted_by(groups.agg(*_named(measures)), "city_name", "year", "month", "country")


def extreme_cities(source: DataFrame, min_rows: int = 30, scale: str = "local") -> DataFrame:
    """Temperature extremes per city and a class taken from the rounded mean.

    ``scale`` picks the bounds; the ``global`` form reports no rain.
    """
    measures = {
        "avg_temp": r.mean(TEMP),
        "max_temp_recorded": r.highest(TEMP),
        "min_temp_recorded": r.lowest(TEMP),
    }
    if scale == "local":
        measures["avg_precipitation"] = r.mean(RAIN)
    measures["total_records"] = r.rows()
    bands, default = CLIMATE_BANDS[scale]
    cities = rolled(source, PLACE, need=[TEMP]).groupBy(*PLACE).agg(*_named(measures))
    enough = cities.filter(F.col("total_records") >= min_rows)
    return sorted_by(
        enough.withColumn("climate_category", classify("avg_temp", bands, default)),
        F.desc("avg_temp"),
        *PLACE,
    )


def seasonal_analysis(source: DataFrame, calendar: str = "dry_wet") -> DataFrame:
    """Temperature and rain by city and season, years pooled.

    The ``dry_wet`` calendar also reports daily rain and the share of rainy days; a NULL
    rain value counts as a dry day.
    """
    if calendar == "dry_wet":
        label = "epoca"
        measures = {
            "avg_temp": r.mean(TEMP),
            "total_precipitation": r.total(RAIN),
            "avg_daily_precipitation": r.mean(RAIN),
            "days_count": r.rows(),
            "rainy_days_ratio": r.rain_share(),
        }
    else:
        label = "season"
        measures = {
            "avg_temp": r.mean(TEMP),
            "total_precipitation": r.total(RAIN),
            "days_count": r.rows(),
        }
    parts = rolled(source, (*PLACE, "month"), need=[TEMP])
    groups = parts.withColumn(label, season("month", calendar)).groupBy(*PLACE, label)
    return sorted_by(groups.agg(*_named(measures)), "city_name", label, "country")


def tropical_analysis(source: DataFrame) -> DataFrame:
    """Typical month per city, years pooled, with its period and a class of the rounded rain."""
    measures = {
        "avg_temp": r.mean(TEMP),
        "total_precip": r.total(RAIN),
        "avg_daily_precip": r.mean(RAIN),
        "days_count": r.rows(),
    }
    keys = (*PLACE, "month")
    months = rolled(source, keys, need=[TEMP]).groupBy(*keys).agg(*_named(measures))
    bands, default = RAIN_BANDS
    labelled = months.withColumns(
        {
            "periodo_climatico": season("month", "tropical"),
            "clasificacion_lluvia": classify("avg_daily_precip", bands, default, ">"),
        }
    )
    return sorted_by(labelled, "city_name", "month", "country")


def precipitation_patterns(source: DataFrame) -> DataFrame:
    """Rain profile per city, with a class taken from the mean before rounding.

    ``precipitacion_total_anual`` is the sum of all data, however many years it spans.
    """
    bands, default = HUMIDITY_BANDS
    measures = {
        "temperatura_promedio": r.mean(TEMP),
        "precipitacion_total_anual": r.total(RAIN),
        "precipitacion_promedio_diaria": r.mean(RAIN),
        "dias_con_lluvia": r.rain_days("rainy"),
        "dias_lluvia_fuerte": r.rain_days("heavy"),
        "dias_lluvia_intensa": r.rain_days("intense"),
        "porcentaje_dias_lluvia": r.rain_share(scale=100.0, digits=1),
        "precipitacion_maxima": r.highest(RAIN),
        "total_dias": r.rows(),
        "clasificacion_humedad": classify(r.exact_mean(RAIN), bands, default, ">"),
    }
    cities = rolled(source, PLACE, need=[TEMP]).groupBy(*PLACE).agg(*_named(measures))
    return sorted_by(cities, F.desc("precipitacion_total_anual"), *PLACE)


def cities_comparison(
    source: DataFrame, labels: Mapping[str, str] = CITY_NOTES, other: str = OTHER_CITY
) -> DataFrame:
    """Temperature spread and rain per city, with a geographic note."""
    measures = {
        "temp_promedio": r.mean(TEMP),
        "temp_minima": r.lowest(TEMP),
        "temp_maxima": r.highest(TEMP),
        "variabilidad_temp": r.deviation(TEMP),
        "lluvia_total": r.total(RAIN),
        "lluvia_promedio": r.mean(RAIN),
        "dias_lluvia": r.rain_days("rainy"),
        "pct_dias_lluvia": r.rain_share(scale=100.0, digits=1),
    }
    cities = rolled(source, PLACE, need=[TEMP]).groupBy(*PLACE).agg(*_named(measures))
    noted = cities.withColumn(
        "caracteristicas_geograficas", label_of("city_name", labels, other)
    )
    return sorted_by(noted, F.desc("temp_promedio"), *PLACE)


def temporal_patterns(source: DataFrame) -> DataFrame:
    """Mean temperature and rain by city name and month, from days with both."""
    keys = ("city_name", "month")
    measures = {"avg_temp": r.mean(TEMP), "avg_precip": r.mean(RAIN), "days_count": r.rows()}
    groups = rolled(source, keys, need=[TEMP, RAIN]).groupBy(*keys)
    return sorted_by(groups.agg(*_named(measures)), *keys)


def city_features(source: DataFrame, geo: bool = False, min_rows: int = 30) -> DataFrame:
    """One row of features per city, for clustering.

    ``geo`` also tells cities apart by coordinates and uses lowest temperature and humidity;
    it needs observations, or a rollup that has the coordinates among its keys.
    """
    if geo:
        keys = (*PLACE, "location_latitude", "location_longitude")
        measures = {
            "avg_max_temp": r.mean(TEMP),
            "avg_min_temp": r.mean(LOW_TEMP),
            "total_precipitation": r.total(RAIN),
            "avg_humidity": r.mean(HUMIDITY),
            "data_points": r.rows(),
            "temp_variability": r.deviation(TEMP),
        }
    else:
        keys = PLACE
        measures = {
            "avg_max_temp": r.mean(TEMP),
            "total_precipitation": r.total(RAIN),
            "avg_precipitation": r.mean(RAIN),
            "data_points": r.rows(),
            "temp_variability": r.deviation(TEMP),
            "max_temp_recorded": r.highest(TEMP),
            "min_temp_recorded": r.lowest(TEMP),
            "avg_elevation": r.mean("elevation"),
            "avg_population": r.mean("population"),
        }
    cities = rolled(source, keys).groupBy(*keys).agg(*_named(measures))
    return cities.filter(F.col("data_points") >= min_rows)


def correlations(
    source: DataFrame,
    pairs: Mapping[str, tuple[str, str]] = CORRELATION_PAIRS,
    min_rows: int = 30,
) -> DataFrame:
    """Pairwise correlations, means and rainy share per city with enough rows.

    A constant column has none, in whatever parts its rows were aggregated.
    """
    need = [TEMP, RAIN, "elevation"]
    measures = {name: F.round(r.exact_correlation(x, y), 3) for name, (x, y) in pairs.items()}
    measures |= {
        "rainy_days_ratio": r.rain_share(),
        "avg_temperature": r.mean(TEMP),
        "avg_precipitation": r.mean(RAIN),
        "avg_elevation": r.mean("elevation", 0),
        "total_records": r.rows(),
    }
    cities = rolled(source, PLACE, need).groupBy(*PLACE).agg(*_named(measures))
    return sorted_by(
        cities.filter(F.col("total_records") >= min_rows), F.desc(next(iter(pairs))), *PLACE
    )


def humidity_correlations(
    obs: DataFrame,
    pairs: Mapping[str, tuple[str, str]] = HUMIDITY_PAIRS,
    min_rows: int = 50,
) -> DataFrame:
    """Correlations of temperature with humidity and rain per city with enough rows.

    Each over the rows that have both, rain or not: from observations, in one aggregate.
    """
    measures = {name: F.round(correlation(x, y), 3) for name, (x, y) in pairs.items()}
    measures["rainy_days_ratio"] = F.round(
        F.count_if(F.col(RAIN) > 0) / F.count(F.lit(1)), 3
    )
    cities = (
        require_not_null(obs, (TEMP, HUMIDITY))
        .groupBy(*PLACE)
        .agg(*_named(measures), F.count(F.lit(1)).alias("__rows"))
        .filter(F.col("__rows") >= min_rows)
        .drop("__rows")
    )
    return sorted_by(cities, F.desc(next(iter(pairs))), *PLACE)


def cluster_summary(
    pred: DataFrame,
    means: Mapping[str, str] | None = None,
) -> DataFrame:
    """Size and mean features per cluster; ``means`` maps result name to feature."""
    # Result column -> feature.
    means = means or {
        "cluster_avg_temp": "avg_max_temp",
        "cluster_avg_precip": "total_precipitation",
        "cluster_temp_variability": "temp_variability",
    }
    sizes = pred.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("cities_count"),
        *[F.round(F.avg(feature), 2).alias(name) for name, feature in means.items()],
    )
    return sorted_by(sizes, "prediction")


def compare_cities(
    obs: DataFrame, first: str, second: str, start: str, end: str
) -> DataFrame:
    """Two cities side by side: mean temperature and total rain per day of a date range.

    Conditional aggregates give both cities in one pass over the filtered days.
    """
    days = obs.filter(
        F.col("city_name").isin(first, second)
        & F.col("weather_date").between(
            F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
        )
    )
    sides = []
    for side, city in (("first", first), ("second", second)):
        here = F.col("city_name") == F.lit(city)
        sides += [
            F.round(F.avg(F.when(here, F.col(TEMP))), 2).alias(f"{side}_max_temp_c"),
            F.round(F.sum(F.when(here, F.col(RAIN))), 2).alias(f"{side}_precipitation_mm"),
        ]
    return sorted_by(days.groupBy("weather_date").agg(*sides), "weather_date")


def _named(measures: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in measures.items()]
