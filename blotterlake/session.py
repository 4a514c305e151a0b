"""Session helpers: local test session and durable intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", **conf: str) -> SparkSession:
    """A session for tests and the local bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("blotterlake")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's checkpoint directory."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="blotterlake-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/blotterlake/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Run ``df`` once into a Parquet table in the shared folder and read that back.

    This cuts lineage, survives the loss of executors, and gives later joins the table's true
    size to choose their strategy by.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Spark's estimate of a table's size; for a stored table the size of its files.  No job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Size of the tables a plan reads; sources that cannot tell count as nothing.  No job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 1 << 60)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (the same as ``spark-submit --py-files``)."""
    archive_name = "blotterlake-src"
    if any(archive_name in name for name in spark.sparkContext.listFiles):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="blotterlake-")
    archive = shutil.make_archive(
        f"{folder}/{archive_name}", "zip", root_dir=package.parent, base_dir=package.name
    )
    spark.sparkContext.addPyFile(archive)
