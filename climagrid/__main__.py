"""Run the batch job, as in ``python -m climagrid WEATHER LOCATIONS TRUSTED REFINED``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from climagrid.plans.batch import refine, run_batch


def main(arguments: Sequence[str] | None = None) -> dict[str, str]:
    parser = argparse.ArgumentParser(prog="climagrid", description="raw files to refined datasets")
    parser.add_argument("weather", help="path or glob of the weather documents")
    parser.add_argument("locations", help="path or glob of the location CSV files")
    parser.add_argument("trusted", help="folder for the observations")
    parser.add_argument("refined", help="folder for the result datasets")
    parser.add_argument("--table", help="catalog table to load the observations into")
    parser.add_argument(
        "--json-lines", action="store_true", help="documents are one per line, not one per file"
    )
    parser.add_argument(
        "--older", action="store_true", help="make the older set of datasets from TRUSTED alone"
    )
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("climagrid").getOrCreate()
    if given.older:
        return refine(spark, given.trusted, given.refined, table=given.table, older=True)
    return run_batch(
        spark,
        given.weather,
        given.locations,
        given.trusted,
        given.refined,
        table=given.table,
        multi_line=not given.json_lines,
    )


if __name__ == "__main__":
    main()
