"""Loading jobs: all nine files, or the entries of a manifest."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import small_frame
from ..sources.files import BAD_ROW, Manifest, discover, locate, read_entry, read_table
from ..sources.specs import TABLES, Layout, TableSpec
from .catalog import quoted, write_table
from .monitoring import append_load_history

PARALLEL_LOADS = 4
SUMMARY_SCHEMA = (
    "table_name string, schema_name string, status string, rows bigint, error string, seconds double, bad_rows bigint"
)


def _attempt(spark: SparkSession, schema: str, table: str, load: Callable[[], int | None]) -> tuple:
    """Run one load, which returns its number of bad rows. A failure is recorded and does not stop the others."""
    start, bad = time.monotonic(), None
    try:
        bad = load()
        rows, status, error = spark.table(quoted(schema, table)).count(), "SUCCESS", None
    except Exception as problem:  # noqa: BLE001 - whatever went wrong belongs in the summary
        rows, status, error = None, "FAILED", str(problem)
    return (table, schema, status, rows, error, round(time.monotonic() - start, 2), bad)


def _store(df: DataFrame, schema: str, table: str, layout: Layout | None = None) -> int | None:
    """Write a table; the number of its bad rows, counted while it is written, if the source can have any."""
    if BAD_ROW not in df.columns:
        return write_table(df, schema, table, layout)
    seen = Observation()
    df = df.observe(seen, F.count_if(F.col(BAD_ROW).isNotNull()).alias("bad"))
    write_table(df.drop(BAD_ROW), schema, table, layout)
    return seen.get["bad"]


def load_all(
    spark: SparkSession,
    folder: str,
    schema: str = "raw_data",
    specs: dict[str, TableSpec] = TABLES,
    history: str | None = None,
) -> DataFrame:
    """Load every table whose file is in the folder; one summary row per table.

    With ``history`` the summary is also appended to that load-history table.
    """
    paths = discover(spark, folder)

    def load(spec: TableSpec) -> int:
        own = locate(paths, spec)
        if not own:
            raise FileNotFoundError(f"no file like {spec.file_pattern}")
        # Every matching file, by column name.
        parts = [read_table(spark, path, spec, keep_bad_rows=True) for path in own]
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return _store(df, schema, spec.name, spec.layout)

    # Loads are independent jobs; running a few at a time fills the executors a small table leaves idle.
    with ThreadPoolExecutor(PARALLEL_LOADS) as pool:
        rows = list(pool.map(lambda spec: _attempt(spark, schema, spec.name, lambda: load(spec)), specs.values()))
    summary = small_frame(spark, rows, SUMMARY_SCHEMA)
    if history:
        append_load_history(spark, summary, history)
    return summary


def loaded_any(summary: DataFrame) -> bool:
    """A load counts as successful when at least one table came through."""
    return not summary.where("status = 'SUCCESS'").isEmpty()


def load_manifest(spark: SparkSession, manifest: Manifest, root: str = "", schema: str | None = None) -> DataFrame:
    """Full refresh of every manifest entry into its target database; one summary row each."""
    target = schema or manifest.target_schema
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(target)}")
    load = lambda e: _attempt(spark, target, e.table, lambda: _store(read_entry(spark, e, root), target, e.table))
    with ThreadPoolExecutor(PARALLEL_LOADS) as pool:
        rows = list(pool.map(load, manifest.entries))
    return small_frame(spark, rows, SUMMARY_SCHEMA)
