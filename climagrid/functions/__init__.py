"""Column expressions: grid, dates, classes and pairwise statistics."""

from climagrid.functions.dates import day_of_year, epoch_phase, parse_date, with_calendar
from climagrid.functions.grid import snap_to_grid
from climagrid.functions.labels import classify, label_of, season
from climagrid.functions.stats import correlation, z_score

__all__ = [
    "classify",
    "correlation",
    "day_of_year",
    "epoch_phase",
    "label_of",
    "parse_date",
    "season",
    "snap_to_grid",
    "with_calendar",
    "z_score",
]
