"""Aggregate and row statistics that give NULL where Spark's ANSI mode would raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from climagrid.functions.grid import as_column


def is_constant(value: str | Column) -> Column:
    """Aggregate: whether all present values are equal; NULL if there are none.

    Moments of a constant merge to a tiny deviation instead of 0 if its rows lie in several
    tasks. The smallest and largest value merge exactly. NaN is no value to be constant at.
    """
    column = as_column(value)
    least = F.min(column)
    return (least == F.max(column)) & ~F.isnan(least.cast("double"))


def sample_deviation(value: str | Column) -> Column:
    """Aggregate: sample standard deviation, exactly 0 for equal values, NULL below two."""
    column = as_column(value)
    spread = F.when(is_constant(column), F.lit(0.0)).otherwise(F.stddev(column))
    return F.when(F.count(column) > 1, spread)


def correlation(x: str | Column, y: str | Column) -> Column:
    """Pearson r over the rows where both are present; NULL if either is constant there.

    ``corr`` raises DIVIDE_BY_ZERO on a constant column, even behind a CASE, so r is taken
    from its mergeable parts, which still aggregate map-side.
    """
    a, b = as_column(x), as_column(y)
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.when(~is_constant(a) & ~is_constant(b), r)


def z_score(value: str | Column, mean: str | Column, std: str | Column) -> Column:
    """Distance from the mean in standard deviations; NULL for a zero or missing deviation."""
    return F.try_divide(as_column(value) - as_column(mean), as_column(std))
