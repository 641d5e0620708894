"""Date parsing and calendar features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.functions.grid import as_column


def parse_date(col: str | Column) -> Column:
    """ISO text to date; text that is no date gives NULL also under ANSI mode."""
    return as_column(col).try_cast("date")


def day_of_year(col: str | Column) -> Column:
    """1 on January 1st, up to 366."""
    return F.dayofyear(as_column(col))


def with_calendar(df: DataFrame, date_col: str = "weather_date") -> DataFrame:
    """Add ``year``, ``month`` and ``day_of_year``."""
    return df.withColumns(
        {
            "year": F.year(date_col),
            "month": F.month(date_col),
            "day_of_year": F.dayofyear(date_col),
        }
    )


def epoch_phase(col: str | Column, period: int = 365) -> Column:
    """Days since 1970-01-01 modulo ``period``.

    A phase, not a day of the year: leap days shift it by one each (2022-01-01 gives 13).
    The sign follows the day number, so dates before 1970 give values from -364 to 0.
    """
    return F.datediff(as_column(col), F.lit("1970-01-01").cast("date")) % F.lit(period)
