"""Tables and models that are replaced as a whole.

Every write goes to a folder of its own, ``data-<name>``, and is published last, by an empty file ``_versions/<number>-<name>``.
The file of the highest number names what readers get.  A run that ends before that leaves the earlier version as
it was; a folder that no file names is never read.  Creating an empty file is atomic on every store that Spark writes
to, which renaming is not.  The version before the current one is kept for readers that have begun; older ones are deleted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

KEPT = 2


def hadoop_path(spark: SparkSession, path: str):
    """File system and path objects."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    system, found = hadoop_path(spark, path)
    return system.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if there is one."""
    system, folder = hadoop_path(spark, path)
    system.delete(folder, True)


def published(spark: SparkSession, path: str) -> list[str]:
    """Names of the published versions, the current one last."""
    system, folder = hadoop_path(spark, f"{path.rstrip('/')}/_versions")
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version."""
    names = published(spark, path)
    return _folder(path, names[-1]) if names else None


def _folder(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/data-{version.split('-', 1)[1]}"


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new folder, then make it the current version."""
    path, name = path.rstrip("/"), uuid.uuid4().hex
    write(f"{path}/data-{name}")
    before = published(spark, path)
    number = int(before[-1].split("-", 1)[0]) + 1 if before else 1
    _announce(spark, f"{path}/_versions/{number:012d}-{name}")
    for old in published(spark, path)[:-KEPT]:
        remove(spark, f"{path}/_versions/{old}")
        remove(spark, _folder(path, old))
    return f"{path}/data-{name}"


def _announce(spark: SparkSession, marker: str) -> None:
    system, found = hadoop_path(spark, marker)
    system.mkdirs(found.getParent())
    if not system.createNewFile(found):
        raise FileExistsError(marker)
