"""Folders that are replaced as a whole: a reader sees the old files or the new ones, never a part.

Each write goes to a fresh folder ``version-...`` inside the named one. Only when it is complete, a
small file ``version-....current`` is made, whose name appears in one step on every file system; the
newest such file is the pointer that readers follow. A write that fails leaves no pointer and so changes nothing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER = ".current"
#: Published versions that stay: the newest, and the one that running readers may still be reading.
KEPT = 2


class _Folder:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._kind = context._jvm.org.apache.hadoop.fs.Path
        self._folder = self._kind(path)
        self._system = self._folder.getFileSystem(context._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        if not self._system.exists(self._folder):
            return []
        return [entry.getPath().getName() for entry in self._system.listStatus(self._folder)]

    def point_to(self, version: str) -> None:
        """Makes the pointer; what it says is for people, and lets listings that skip empty files see it."""
        out = self._system.create(self._kind(self._folder, version + POINTER), False)
        out.write(bytearray(version.encode()))
        out.close()

    def delete(self, name: str) -> None:
        self._system.delete(self._kind(self._folder, name), True)


def _published(names: list[str]) -> list[str]:
    return sorted(n.removesuffix(POINTER) for n in names if n.endswith(POINTER))


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder that readers of ``path`` follow to; None if no version was published there."""
    published = _published(_Folder(spark, path).names())
    return f"{path.rstrip('/')}/{published[-1]}" if published else None


def publish(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    announce: Callable[[str], None] | None = None,
) -> str:
    """Let ``write`` fill a fresh folder, then make it the current one and return it.

    ``announce`` is called with the complete folder before it becomes current. The version before it
    stays for readers that have begun; older ones go, also what failed writes have left and flat files
    from before versions. One writer at a time per ``path``; if two publish, the one that began later
    wins.
    """
    version = f"version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    place = f"{path.rstrip('/')}/{version}"
    folder = _Folder(spark, path)
    try:
        write(place)
        if announce is not None:
            announce(place)
        folder.point_to(version)
    except BaseException:
        folder.delete(version)
        raise
    names = folder.names()
    kept = set(_published(names)[-KEPT:])
    for name in sorted(names, key=lambda n: not n.endswith(POINTER)):  # a pointer goes before its folder
        if name.removesuffix(POINTER) not in kept and not name.removesuffix(POINTER) > version:
            folder.delete(name)
    return place
