"""Joins of observations with smaller tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.functions.stats import sample_deviation
from climagrid.operators.rollup import exact_deviation, exact_mean, is_rollup, with_origins
from climagrid.sources.scratch import materialize

BROADCAST_BYTES = 32 << 20
#: Rows of one key that a task may get; keys with more are dealt to as many tasks as that takes.
KEY_ROWS = 1 << 20
#: Keys that are dealt out at most: those with the most rows. The others hold a smaller share each.
HEAVY_KEYS = 1 << 16

_ROW_BYTES, _FIELD_BYTES = 32, 16


def table_bytes(df: DataFrame) -> int:
    """Size of a flat table in memory: text by its length, the rest by an upper bound.

    One pass over ``df``, so for dimension and statistics tables.
    """
    fixed = F.lit(_ROW_BYTES + _FIELD_BYTES * len(df.columns))
    texts = [F.octet_length(name) for name, kind in df.dtypes if kind == "string"]
    row = reduce(Column.__add__, [F.coalesce(t, F.lit(0)) for t in texts], fixed)
    return df.agg(F.sum(row)).first()[0] or 0


def heavy_keys(rows: DataFrame, keys: Sequence[str], key_rows: int = KEY_ROWS) -> DataFrame:
    """``keys`` with more than ``key_rows`` rows, and the number of tasks to deal them to (``__parts``).

    Rows are counted before they are shuffled, keys alone; ``HEAVY_KEYS`` rows come back at most.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return _dealt(counts, keys, key_rows)


def _dealt(counts: DataFrame, keys: Sequence[str], key_rows: int) -> DataFrame:
    heavy = counts.where(F.col("__rows") > key_rows).orderBy(F.desc("__rows")).limit(HEAVY_KEYS)
    parts = F.ceil(F.col("__rows") / key_rows).cast("int")
    return materialize(heavy.select(*keys, parts.alias("__parts")), "heavy-keys")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    key_rows: int = KEY_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Inner join of many rows with a lookup table, fit for a key that holds most rows.

    The lookup table's size is measured. Up to ``broadcast_bytes`` it is broadcast and the
    rows stay where they are. Above, both sides are shuffled once by the keys, and only the heavy
    keys' lookup rows are copied: a key's rows are dealt to parts of about ``key_rows``, and its
    lookup rows go to each part. How many rows the keys have is counted, or taken from the lookup's
    column ``weight``. Adaptive execution remains free to split the shuffle further.
    """
    if table_bytes(lookup) <= broadcast_bytes:
        return rows.join(F.broadcast(lookup), list(keys), "inner")
    if weight is None:
        heavy = heavy_keys(rows, keys, key_rows)
    else:
        heavy = _dealt(lookup.groupBy(*keys).agg(F.max(weight).alias("__rows")), keys, key_rows)
    if heavy.isEmpty():
        return rows.join(lookup, list(keys), "inner")
    heavy = F.broadcast(heavy)  # HEAVY_KEYS rows at most
    # The partition number also spreads copies of one row; a retried task finds it unchanged.
    spread = F.xxhash64(*rows.columns) + F.spark_partition_id()
    parts = F.coalesce("__parts", F.lit(1))
    dealt = rows.withColumn("__spread", spread).join(heavy, list(keys), "left")
    dealt = dealt.withColumn("__part", F.pmod("__spread", parts).cast("int")).drop("__spread", "__parts")
    copies = lookup.join(heavy, list(keys), "left").withColumn(
        "__part", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return dealt.join(copies.drop("__parts"), [*keys, "__part"], "inner").drop("__part")


def join_on_grid(
    weather: DataFrame,
    locations: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    key_rows: int = KEY_ROWS,
) -> DataFrame:
    """Weather rows with the location(s) of their grid cell.

    Several locations in a cell each get the cell's weather. ``elevation`` is that of the
    location.
    """
    cells = locations.withColumns(
        {"latitude": F.col("location_latitude"), "longitude": F.col("location_longitude")}
    )
    return lookup_join(
        weather.drop("elevation"), cells, ["latitude", "longitude"], broadcast_bytes, key_rows
    )


def group_stats(
    source: DataFrame, keys: Sequence[str], measures: Mapping[str, str]
) -> DataFrame:
    """Mean and sample deviation per group, named ``mean_<label>`` and ``std_<label>``.

    ``measures`` maps a column to its label. A rollup will do as ``source`` if it has the
    keys and the measures.
    """
    aggregates, merging = [], is_rollup(source)
    if merging:
        source = with_origins(source)
    for column, label in measures.items():
        if merging:
            mean, std = exact_mean(column), exact_deviation(column)
        else:
            mean, std = F.avg(column), sample_deviation(column)
        aggregates += [mean.alias(f"mean_{label}"), std.alias(f"std_{label}")]
    return source.groupBy(*keys).agg(*aggregates)


def with_group_stats(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    source: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows with the statistics of their group; rows with a NULL key drop out.

    The statistics (a row per group, from ``source`` or else from the rows) are kept in the
    shared folder and joined back. A window would instead send each whole group to one task.
    """
    stats = materialize(
        group_stats(df if source is None else source, keys, measures), "group-stats"
    )
    return lookup_join(df, stats, keys, broadcast_bytes)
