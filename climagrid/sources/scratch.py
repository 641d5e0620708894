"""Intermediate results kept in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}
_job_paths: list[list[str]] = []


def _shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="climagrid-")
        atexit.register(shutil.rmtree, _own_folder[app], ignore_errors=True)
    return _own_folder[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder.

    A local session without ``spark.checkpoint.dir`` gets a folder of its own, which goes when
    Python ends. A cluster session must name one, since a machine-local folder would not be seen
    by all executors.
    """
    path = f"{_shared_folder(spark)}/climagrid/{label}-{uuid.uuid4().hex}"
    if _job_paths:
        _job_paths[-1].append(path)
    return path


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, what was kept within it: for jobs whose results are written elsewhere.

    Of nested or concurrent jobs, paths belong to the one that was opened last.
    """
    paths: list[str] = []
    _job_paths.append(paths)
    try:
        yield
    finally:
        _job_paths.remove(paths)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            place = hadoop.Path(path)
            place.getFileSystem(conf).delete(place, True)


def materialize(df: DataFrame, label: str, row_group: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage, so that neither a second use nor a lost executor costs another scan
    of the facts. ``row_group`` bounds the bytes that a task's writer holds, for wide rows.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write if row_group is None else df.write.option("parquet.block.size", row_group)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
