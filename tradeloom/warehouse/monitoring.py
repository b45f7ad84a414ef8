"""Append-only monitoring tables: load history and quality metrics, and the rule table.

Appends are safe beside each other and when repeated. Ids come from numbered lots: a writer owns a lot once
it has made the lot's marker file, which the file system lets one writer do only. The rows are
written to a folder of their own and then moved into the table as one file named after the run, so that
writers share no unfinished files and a run that is repeated finds its file there.
"""

from __future__ import annotations

import hashlib
import uuid

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.quality import Rule, rules_frame
from .catalog import quoted

#: Ids of one lot. A writer takes as many lots as its rows need.
LOT = 1024
#: Names that begin with an underscore are no data to a reader of the table.
LOTS_FOLDER = "_lots"


class Ledger:
    """The folder of an append-only table."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table
        schema, name = table.split(".")
        self.root = f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{name}"
        self.name = quoted(schema, name)
        self.files = self.path().getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def path(self, *parts: str) -> JavaObject:
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def open(self, rows: DataFrame) -> None:
        """Make the table if it is not there, over files that an earlier session may have left."""
        if not self.spark.catalog.tableExists(self.table):
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in rows.schema)
            where = self.root.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet LOCATION '{where}'")

    def claim(self, lots: int, id_column: str) -> list[int]:
        """Lots that this writer alone owns, ascending; a lot of a writer that fails later stays unused."""
        folder = self.path(LOTS_FOLDER)
        self.files.mkdirs(folder)
        taken = [int(status.getPath().getName()) for status in self.files.listStatus(folder)]
        if taken:
            number = max(taken) + 1
        else:
            last = self.spark.table(self.name).agg(F.max(id_column)).first()[0]
            number = 0 if last is None else -(-last // LOT)
        owned: list[int] = []
        while len(owned) < lots:
            if self._made(self.path(LOTS_FOLDER, f"{number:015d}")):
                owned.append(number)
            number += 1
        return owned

    def _made(self, marker: JavaObject) -> bool:
        try:
            self.files.create(marker, False).close()
        except Py4JJavaError:
            if self.files.exists(marker):
                return False  # another writer was first
            raise
        return True

    def append(self, rows: DataFrame, id_column: str, run_key: str | None) -> bool:
        """Append rows with ids of this table in front; False if the run had been appended before."""
        self.open(rows.select(F.lit(0).cast("bigint").alias(id_column), "*"))
        run = hashlib.sha256((run_key or uuid.uuid4().hex).encode()).hexdigest()
        target, staged = self.path(f"run-{run}.parquet"), f"_staged-{uuid.uuid4().hex}"
        if self.files.exists(target):
            return False
        try:
            # Written once without ids, so that the rows that are counted are the rows that are kept.
            plain = f"{self.root}/{staged}/plain"
            rows.write.parquet(plain)
            kept = self.spark.read.schema(rows.schema).parquet(plain).coalesce(1)
            lots = self.claim(-(-kept.count() // LOT), id_column)
            number = F.monotonically_increasing_id()  # in one partition: from 0, without gaps
            owned = F.array(*map(F.lit, lots)).cast("array<bigint>")
            ids = F.element_at(owned, (F.floor(number / LOT) + 1).cast("int")) * LOT + number % LOT + 1
            kept.select(ids.alias(id_column), "*").write.parquet(f"{self.root}/{staged}/numbered")
            parts = self.files.globStatus(self.path(staged, "numbered", "part-*"))
            for part in list(parts)[:1]:
                if not self.files.rename(part.getPath(), target) and not self.files.exists(target):
                    raise RuntimeError(f"{self.table}: run {run_key} could not be moved into the table")
        finally:
            self.files.delete(self.path(staged), True)
        self.spark.sql(f"REFRESH TABLE {self.name}")
        return True


def append_load_history(
    spark: SparkSession, summary: DataFrame, table: str = "data_quality.load_history", run_key: str | None = None
) -> bool:
    """Append a load summary. With ``run_key``, a second append of the same run adds nothing and returns False."""
    rows = summary.select(
        "table_name",
        "schema_name",
        F.current_timestamp().alias("load_timestamp"),
        F.col("rows").alias("rows_loaded"),
        F.col("status").alias("load_status"),
        F.col("error").alias("error_message"),
        F.col("seconds").cast("decimal(10,2)").alias("load_duration_seconds"),
    )
    return Ledger(spark, table).append(rows, "load_id", run_key)


def append_metrics(
    spark: SparkSession, metrics: DataFrame, table: str = "data_quality.quality_metrics", run_key: str | None = None
) -> bool:
    """Append (table_name, metric_name, metric_value, metric_status, details as JSON text); ``run_key`` as above."""
    rows = metrics.select(
        F.current_timestamp().alias("check_timestamp"),
        "table_name",
        "metric_name",
        F.col("metric_value").cast("decimal(38,18)").alias("metric_value"),
        "metric_status",
        "details",
    )
    return Ledger(spark, table).append(rows, "metric_id", run_key)


def store_rules(spark: SparkSession, rules: list[Rule], table: str = "data_quality.validation_rules") -> None:
    """Write the rule table."""
    rules_frame(spark, rules).coalesce(1).write.mode("overwrite").format("parquet").saveAsTable(table)
