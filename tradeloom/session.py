"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Only runtime settings, so they can also be applied to a session somebody else built.
# forceOptimizeSkewedJoin lets AQE split a hot key even where the rows must be
# shuffled once more afterwards, which is cheaper than one task holding that key.
# Timestamps are written as microseconds: the default form of Parquet files has no min/max
# statistics, so that no filter on a date would skip anything.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# A shuffle is cut finely and then coalesced to this many bytes a task, so that what a task sorts and
# groups does not grow with the tables (up to 2000 partitions, 32 GB a shuffle). 2000 is also the most
# for which Spark keeps the exact size of each partition. Scans hold their partial groups and the rows
# they deal out, so they are cut as well.
TASK_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def tune(spark: SparkSession, **more: str) -> SparkSession:
    for name, value in {**RUNTIME_SETTINGS, **more}.items():
        spark.conf.set(name, value)
    return spark


def tune_tables(spark: SparkSession) -> SparkSession:
    """For work on tables. The text operators deal their own chunks and take the partitions that are set."""
    return tune(spark, **TASK_SETTINGS)


def local_session(cpus: int | str = 8, name: str = "tradeloom", **settings: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tradeloom-wh-"))
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local-mode session without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tradeloom-work-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once for each application."""
    context, package = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if not getattr(context, "_tradeloom_shipped", False):
        archive = os.path.join(tempfile.mkdtemp(prefix="tradeloom-py-"), "tradeloom.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(archive)
        context._tradeloom_shipped = True
    return spark


def small_frame(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A DataFrame of a few driver-side rows, such as a load summary.

    Coming in through Arrow it is a local relation: its size is known to the planner and no
    job is needed to read it back.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(fields)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    table = pa.table([pa.array(values, field.type) for values, field in zip(columns, arrow, strict=True)], schema=arrow)
    return spark.createDataFrame(table, fields)
