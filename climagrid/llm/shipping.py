"""The package's own modules for Python workers on other machines."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame

_shipped: set[str] = set()


def with_modules(df: DataFrame) -> DataFrame:
    """``df``, after its session has sent this package to its workers (once per application).

    Python workers import the functions of an operator by module name, and they need not share the
    driver's module path.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).resolve().parent.parent
        handle, path = tempfile.mkstemp(prefix="climagrid-", suffix=".zip")
        with os.fdopen(handle, "wb") as target, zipfile.ZipFile(target, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(path)
        atexit.register(os.unlink, path)  # executors that start later still fetch it
    return df
