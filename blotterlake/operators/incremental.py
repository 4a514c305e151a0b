"""Counts of a partitioned table that grow with it: only partitions that are new or have changed are read.

A stored table of counts holds, for each partition of the source, the counts of its rows and the version of its files they were
made of.  Counts of different partitions add up, so a refresh counts the changed partitions, takes the others' rows
over, and publishes both as one new version.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from blotterlake.sources.tables import publish_table, read_table, table_exists
from blotterlake.sources.versions import current, hadoop_path

PARTITION, VERSION = "source_partition", "source_version"


def partition_versions(spark: SparkSession, source: str, column: str) -> dict[str, str]:
    """Value (as in the folder's name) to a digest of the names, sizes and times of the files, for each partition folder."""
    system, root = hadoop_path(spark, current(spark, source) or source)
    found = {}
    for folder in system.listStatus(root):
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith(f"{column}="):
            files = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in system.listStatus(folder.getPath())]
            found[name.split("=", 1)[1]] = hashlib.md5(repr(sorted(files)).encode()).hexdigest()
    return found


def refresh_counts(
    spark: SparkSession, source: str, store: str, count: Callable[[DataFrame], DataFrame], *, column: str = "arrest_year"
) -> DataFrame:
    """The counts of all partitions of ``source``, up to date and stored at ``store``.

    ``count`` groups rows of the source by ``column`` and other keys.  Rows without a value of ``column`` are a
    partition like others.  The driver sees one row for each partition.
    """
    found = partition_versions(spark, source, column)
    stored = read_table(spark, store) if table_exists(spark, store) else None
    known = {} if stored is None else {r[PARTITION]: r[VERSION] for r in stored.select(PARTITION, VERSION).distinct().collect()}
    changed = sorted(p for p, version in found.items() if known.get(p) != version)
    gone = sorted(set(known) - set(found))
    if stored is None and not changed:
        raise FileNotFoundError(f"no partitions by {column} at {source}")
    parts = [stored.where(~F.col(PARTITION).isin(changed + gone))] if stored is not None else []
    if changed:
        name = F.coalesce(F.col(column).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        version = F.create_map(*[F.lit(x) for p in changed for x in (p, found[p])])
        fresh = count(read_table(spark, source).where(name.isin(changed)))
        parts.append(fresh.withColumn(PARTITION, name).withColumn(VERSION, F.try_element_at(version, F.col(PARTITION))))
    if changed or gone:
        publish_table(reduce(DataFrame.unionByName, parts), store)
    return read_table(spark, store).drop(PARTITION, VERSION)
