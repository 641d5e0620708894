import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("climagrid-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_obs(spark):
    """Observations from (date, city, temp, rain) tuples and optional further columns."""
    from climagrid.sources.schemas import OBSERVATION

    def build(rows, country="Colombia", population=1000, elevation=100.0):
        import datetime as dt

        full = []
        for row in rows:
            day, city, temp, rain, *rest = row
            day = dt.date.fromisoformat(day) if day else None
            place = rest[0] if rest else country
            height = rest[1] if len(rest) > 1 else elevation
            full.append((day, 1, city, place, temp, rain, population, height))
        return spark.createDataFrame(full, OBSERVATION)

    return build
