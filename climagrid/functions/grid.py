"""Coordinate grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID_STEP = 0.125


def as_column(col: str | Column) -> Column:
    """Accept a column name or a Column."""
    return F.col(col) if isinstance(col, str) else col


def snap_to_grid(col: str | Column, step: float = GRID_STEP) -> Column:
    """Nearest multiple of ``step``, ties to the even multiple; NULL stays NULL.

    ``rint`` is the half-to-even rounding; ``round`` would send ties away from zero.
    Multiples of 0.125 are exact doubles, so snapped values can be compared with ``==``.
    """
    return F.rint(as_column(col) / F.lit(step)) * F.lit(step)
