"""Row-level operators: shaping, filters, projection, split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.functions.dates import parse_date
from climagrid.functions.grid import as_column, snap_to_grid
from climagrid.operators.ordering import sorted_rows

# Columns of a time series for display.
SERIES_COLUMNS = (
    "weather_date",
    "city_name",
    "max_temp_c",
    "precipitation_mm",
    "population",
    "elevation",
)


def explode_daily(docs: DataFrame) -> DataFrame:
    """One row per day of each document, next to the document's other columns.

    Arrays shorter than the longest are filled with NULL. A document in which one of the
    three arrays is missing altogether yields no rows.
    """
    others = [c for c in docs.columns if c not in ("daily", "daily_units")]
    days = F.arrays_zip("daily.time", "daily.temperature_2m_max", "daily.precipitation_sum")
    return docs.select(*others, F.explode(days).alias("day")).select(
        *others,
        parse_date("day.time").alias("weather_date"),
        F.col("day.temperature_2m_max").alias("max_temp_c"),
        F.col("day.precipitation_sum").alias("precipitation_mm"),
    )


def snap_documents(docs: DataFrame) -> DataFrame:
    """Documents with latitude and longitude on the grid."""
    return docs.withColumns({c: snap_to_grid(c) for c in ("latitude", "longitude")})


def prepare_locations(locations: DataFrame) -> DataFrame:
    """Typed locations with grid coordinates; text that does not cast gives NULL."""
    as_double = {
        c: F.col(c).try_cast("double") for c in ("latitude", "longitude", "elevation")
    }
    return locations.select(
        F.col("location_id").try_cast("int").alias("location_id"),
        "city_name",
        "country",
        snap_to_grid(as_double["latitude"]).alias("location_latitude"),
        snap_to_grid(as_double["longitude"]).alias("location_longitude"),
        F.col("population").try_cast("int").alias("population"),
        as_double["elevation"].alias("elevation"),
    )


def snap_extract(locations: DataFrame) -> DataFrame:
    """Extracted locations with coordinates on the grid, other columns untouched."""
    return locations.withColumns(
        {c: snap_to_grid(F.col(c).try_cast("double")) for c in ("latitude", "longitude")}
    )


def require_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Rows in which all ``cols`` are present (NaN counts as present)."""
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in cols]))


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in which all ``cols`` are neither NULL nor NaN."""
    return df.na.drop(subset=list(cols))


def select_series(
    obs: DataFrame, cities: Sequence[str], start: str, end: str
) -> DataFrame:
    """Daily series of some cities over a closed date range, by date and city.

    No city selects nothing.
    """
    chosen = obs.filter(
        F.col("city_name").isin(*cities)
        & F.col("weather_date").between(
            F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
        )
    )
    return sorted_rows(chosen.select(*SERIES_COLUMNS), "weather_date", "city_name")


def with_error(
    pred: DataFrame, label: str = "max_temp_c", prediction: str = "prediction"
) -> DataFrame:
    """Add ``error``, the label minus the prediction at two decimals."""
    return pred.withColumn("error", F.round(F.col(label) - F.col(prediction), 2))


def filter_result(df: DataFrame, cond: Column | str) -> DataFrame:
    """Rows of a result that meet a condition."""
    return df.filter(cond)


def project(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Selected fields, ``{new name: source column}``."""
    return df.select(*[F.col(source).alias(name) for name, source in mapping.items()])


def split_digest(*keys: str | Column, seed: int = 42) -> Column:
    """Eight hexadecimal digits that depend on the row's keys and the seed alone."""
    text = F.concat_ws("|", F.lit(seed), *[as_column(k).cast("string") for k in keys])
    return F.substring(F.md5(text.cast("binary")), 1, 8)


def split(
    df: DataFrame, *keys: str | Column, frac: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """About ``frac`` of the rows and the others; rows with equal keys stay together.

    A retried or repartitioned job splits the same way, which ``randomSplit`` does not promise.
    """
    if not 0 <= frac < 1:
        raise ValueError(f"frac must be at least 0 and below 1, not {frac}")
    inside = split_digest(*keys, seed=seed) < F.lit(f"{round(frac * 16**8):08x}")
    return df.filter(inside), df.filter(~inside)
