"""Z-score anomalies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.functions.stats import z_score
from climagrid.operators.joins import BROADCAST_BYTES, with_group_stats
from climagrid.operators.ordering import sorted_rows

# Measured columns and the prefix of their statistics.
ANOMALY_MEASURES = {"max_temp_c": "temp", "precipitation_mm": "precip"}


def anomalies(
    obs: DataFrame,
    measures: Mapping[str, str] = ANOMALY_MEASURES,
    keys: Sequence[str] = ("city_name",),
    threshold: float = 2.0,
    source: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Days on which a measure is more than ``threshold`` deviations from its city's mean.

    Statistics are per city name over all years. A measure that is missing, or constant in
    its city, has no score; the other may still mark the day. ``source`` may give a rollup to
    take the statistics from, which saves a scan of the observations.
    """
    rows = obs.select("weather_date", *keys, *measures)
    scores = {
        f"{label}_z_score": z_score(column, f"mean_{label}", f"std_{label}")
        for column, label in measures.items()
    }
    placed = with_group_stats(rows, keys, measures, source, broadcast_bytes)
    scored = placed.withColumns(scores)
    marked = reduce(Column.__or__, [F.abs(F.col(s)) > F.lit(threshold) for s in scores])
    return sorted_rows(
        scored.filter(marked).select("weather_date", *keys, *measures, *scores), "weather_date"
    )
