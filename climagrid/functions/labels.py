"""Threshold, month and equality classifiers."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from climagrid.functions.grid import as_column

_COMPARE = {">=": operator.ge, ">": operator.gt}

# Bounds and labels of the published datasets.
CLIMATE_BANDS = {
    "local": (
        [(25, "Caliente"), (20, "Templado Cálido"), (15, "Templado"), (10, "Fresco")],
        "Frío",
    ),
    "global": (
        [(30, "Muy Caliente"), (20, "Caliente"), (10, "Templado"), (0, "Frío")],
        "Muy Frío",
    ),
}
RAIN_BANDS = ([(5, "Muy Lluvioso"), (2, "Lluvioso"), (0.5, "Moderado")], "Seco")
HUMIDITY_BANDS = (
    [(5, "Clima Muy Húmedo"), (3, "Clima Húmedo"), (1, "Clima Moderadamente Húmedo")],
    "Clima Seco",
)
CITY_NOTES = {
    "Medellin": "Valle de Aburrá - Clima tropical de montaña",
    "Bogota": "Altiplano Cundiboyacense - Clima de montaña",
}
OTHER_CITY = "Otro"

# Months of each season and the label of any other month.
SEASONS = {
    "dry_wet": (
        {
            "Época Seca": (12, 1, 2, 3),
            "Época Lluviosa": (4, 5, 10, 11),
            "Época Semi-seca": (6, 7, 8),
        },
        "Época Semi-lluviosa",
    ),
    "tropical": (
        {
            "Verano (Seco)": (12, 1, 2, 3),
            "Primera Lluvia": (4, 5),
            "Veranillo de San Juan": (6, 7, 8),
            "Segunda Lluvia": (9, 10, 11),
        },
        None,
    ),
    "temperate": (
        {
            "Invierno": (12, 1, 2),
            "Primavera": (3, 4, 5),
            "Verano": (6, 7, 8),
        },
        "Otoño",
    ),
}


def _first_match(branches: Sequence[tuple[Column, str]], default: str | None) -> Column:
    (condition, label), *others = branches
    chain = F.when(condition, F.lit(label))
    for condition, label in others:
        chain = chain.when(condition, F.lit(label))
    return chain if default is None else chain.otherwise(F.lit(default))


def classify(
    col: str | Column,
    bands: Sequence[tuple[float, str]],
    default: str,
    op: str = ">=",
) -> Column:
    """Label of the first bound that ``col`` reaches (``>=``) or passes (``>``).

    A NULL compares with nothing and so takes ``default``, like any value below all bounds.
    """
    value, test = as_column(col), _COMPARE[op]
    return _first_match([(test(value, F.lit(bound)), label) for bound, label in bands], default)


def season(month: str | Column, calendar: str = "dry_wet") -> Column:
    """Season label of a month number in one of the calendars of ``SEASONS``."""
    months_of, default = SEASONS[calendar]
    number = as_column(month)
    return _first_match([(number.isin(*ms), label) for label, ms in months_of.items()], default)


def label_of(col: str | Column, mapping: Mapping[str, str], default: str) -> Column:
    """Label looked up by equality, ``default`` for all else.

    For a handful of labels written in code; join a table for a long list.
    """
    value = as_column(col)
    if not mapping:
        return F.lit(default)
    return _first_match([(value == F.lit(k), label) for k, label in mapping.items()], default)
