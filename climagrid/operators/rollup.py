"""Mergeable partial aggregates that all climate reports finish from.

A report over raw observations rolls them up at its own grain in one shuffle. A batch run
rolls them up once per city and month, keeps that small table and finishes every report from
it, so the facts are scanned once instead of once per report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from climagrid.functions.dates import with_calendar
from climagrid.operators.transforms import require_not_null

PLACE = ("city_name", "country")
MONTHLY_GRAIN = (*PLACE, "year", "month")

# Daily rain above each bound, in mm.
RAIN_DAY_BOUNDS = {"rainy": 0, "heavy": 10, "intense": 20}

# Measured columns; those that a table lacks are left out.
MEASURES = (
    "max_temp_c",
    "precipitation_mm",
    "elevation",
    "population",
    "min_temp_c",
    "humidity_percent",
)

# Measures whose absence reports filter on, and that have a spread.
PRESENCE_FLAGS = {
    "max_temp_c": "has_temp",
    "precipitation_mm": "has_rain",
    "elevation": "has_elevation",
}

# Pairs of them that vary together: the centred sum of products is a part too.
PAIRS = (
    ("max_temp_c", "precipitation_mm"),
    ("max_temp_c", "elevation"),
    ("precipitation_mm", "elevation"),
)

_MARK = "n_rows"


def _measure_parts(column: str, spread: bool) -> list[Column]:
    # Sums run in double, as avg does: an integer sum could overflow in a heavy group.
    parts = {"n": F.count(column), "sum": F.sum(F.col(column).cast("double"))}
    if spread:
        parts |= {
            "min": F.min(column),
            "max": F.max(column),
            "m2": F.var_pop(column) * F.count(column),
        }
    return [part.alias(f"{column}__{name}") for name, part in parts.items()]


def rollup(
    obs: DataFrame, keys: Sequence[str] = MONTHLY_GRAIN, presence: bool = True
) -> DataFrame:
    """Partial aggregates per group of ``keys``.

    ``keys`` may name columns of ``obs`` or the calendar fields ``year`` and ``month``. With
    ``presence`` the groups are also told apart by whether temperature, rain and elevation are
    there, so that reports with different NULL filters can share one rollup.
    """
    measures = [c for c in MEASURES if c in obs.columns]
    flags = {f: F.col(column).isNotNull() for column, f in PRESENCE_FLAGS.items() if column in measures}
    dated = with_calendar(obs) if {"year", "month"} & set(keys) else obs
    grouped = dated.withColumns(flags).groupBy(*keys, *(flags if presence else ()))
    parts = [part for c in measures for part in _measure_parts(c, spread=c in PRESENCE_FLAGS)]
    parts += [
        (F.covar_pop(x, y) * F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull())).alias(f"{x}__with__{y}")
        for x, y in PAIRS
        if x in measures and y in measures
    ]
    rain_days = [
        F.count_if(F.col("precipitation_mm") > bound).alias(f"{name}_days")
        for name, bound in RAIN_DAY_BOUNDS.items()
    ]
    return grouped.agg(F.count(F.lit(1)).alias(_MARK), *parts, *rain_days)


def is_rollup(source: DataFrame) -> bool:
    """Whether ``source`` holds partials instead of observations."""
    return _MARK in source.columns


def rolled(source: DataFrame, keys: Sequence[str], need: Sequence[str] = ()) -> DataFrame:
    """Partials for a report: from observations at grain ``keys``, or from a rollup as is.

    ``need`` names the measures (of ``PRESENCE_FLAGS``) that must be present in a row.
    """
    if is_rollup(source):
        for column in need:
            source = source.filter(PRESENCE_FLAGS[column])
        return with_origins(source)
    parts = rollup(require_not_null(source, need) if need else source, keys, presence=False)
    # One part per group: its own mean is the origin, and nothing lies between parts.
    own = {
        f"{c}__origin": F.try_divide(F.col(f"{c}__sum"), F.col(f"{c}__n"))
        for c in PRESENCE_FLAGS
        if f"{c}__m2" in parts.columns
    }
    return parts.withColumns(own)


def rows() -> Column:
    """Row count of the finished group."""
    return F.sum(_MARK)


def total(column: str, digits: int = 2) -> Column:
    """Sum, NULL if nothing was measured."""
    return F.round(F.sum(f"{column}__sum"), digits)


def exact_mean(column: str) -> Column:
    """Mean, not rounded."""
    return F.try_divide(F.sum(f"{column}__sum"), F.sum(f"{column}__n"))


def mean(column: str, digits: int = 2) -> Column:
    """Mean."""
    return F.round(exact_mean(column), digits)


def lowest(column: str, digits: int = 2) -> Column:
    """Minimum."""
    return F.round(F.min(f"{column}__min"), digits)


def highest(column: str, digits: int = 2) -> Column:
    """Maximum."""
    return F.round(F.max(f"{column}__max"), digits)


def with_origins(source: DataFrame) -> DataFrame:
    """A rollup whose parts know a value near the mean of their city, ``<column>__origin``.

    The mean of all parts of one city name, so parts of a group that has one share it exactly.
    A city has a bounded number of parts, however many observations.
    """
    columns = [c for c in PRESENCE_FLAGS if f"{c}__m2" in source.columns]
    if "city_name" not in source.columns:
        return source
    city = Window.partitionBy("city_name")
    origins = {
        f"{c}__origin": F.try_divide(F.sum(f"{c}__sum").over(city), F.sum(f"{c}__n").over(city))
        for c in columns
    }
    return source.withColumns(origins)


def _products(x: str, y: str, within: str) -> Column:
    """Sum of products of ``x`` and ``y``, both centred at their means, over rows that have both.

    Products ``within`` the parts plus products between their means. The means are taken from the
    parts' common origin, so that large values with a small spread do not cancel; where the parts of a
    group have different origins, their spread is itself large and plain sums will do.
    """
    n, sums = F.col(f"{x}__n"), [F.col(f"{c}__sum") for c in (x, y)]
    origins = [F.col(f"{c}__origin") for c in (x, y)]
    dx, dy = (F.try_divide(s, n) - origin for s, origin in zip(sums, origins, strict=True))
    count = F.sum(n)
    near = F.sum(n * dx * dy) - F.try_divide(F.sum(n * dx) * F.sum(n * dy), count)
    far = F.sum(F.try_divide(sums[0] * sums[1], n)) - F.try_divide(F.sum(sums[0]) * F.sum(sums[1]), count)
    same = (F.min(origins[0]) == F.max(origins[0])) & (F.min(origins[1]) == F.max(origins[1]))
    return F.sum(within) + F.coalesce(F.when(same, near).otherwise(far), F.lit(0.0))


def _squares(column: str) -> Column:
    return F.greatest(_products(column, column, f"{column}__m2"), F.lit(0.0))


def _constant(column: str) -> Column:
    return F.min(f"{column}__min") == F.max(f"{column}__max")


def exact_deviation(column: str) -> Column:
    """Sample standard deviation, not rounded; NULL below two values, 0 for equal values."""
    count = F.sum(f"{column}__n")
    spread = F.when(_constant(column), F.lit(0.0)).otherwise(
        F.sqrt(F.try_divide(_squares(column), count - F.lit(1)))
    )
    return F.when(count > 1, spread)


def exact_correlation(x: str, y: str) -> Column:
    """Pearson r, not rounded, of two measures of ``PAIRS`` in parts that have both throughout
    (see ``rolled``); NULL if either is constant."""
    together = _products(x, y, f"{x}__with__{y}")
    r = F.try_divide(together, F.sqrt(_squares(x) * _squares(y)))
    return F.when(~_constant(x) & ~_constant(y), r)


def deviation(column: str, digits: int = 2) -> Column:
    """Sample standard deviation."""
    return F.round(exact_deviation(column), digits)


def rain_days(kind: str) -> Column:
    """Days with rain above a bound of ``RAIN_DAY_BOUNDS``."""
    return F.sum(f"{kind}_days")


def rain_share(kind: str = "rainy", scale: float = 1.0, digits: int = 3) -> Column:
    """Share of all rows with such rain; a row without a rain value counts as dry."""
    return F.round(F.try_divide(rain_days(kind) * F.lit(scale), rows()), digits)
