"""Layers, table writes, comments, views, refresh and statistics."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import pretty_size
from ..operators.clustering import unused, with_zorder_key
from ..plans.marts import MATERIALIZED, VIEWS
from ..session import small_frame
from ..sources.specs import TABLES, Layout, TableSpec

LAYERS = {
    "raw_data": "Source data with declared types, otherwise unchanged",
    "staging": "Cleaned and standardized data",
    "analytics": "Marts and other aggregated datasets",
    "data_quality": "Checks, rules and load monitoring",
}
ANALYZED = "tradeloom.last_analyzed"


def quoted(*parts: str) -> str:
    """An identifier safe to put into SQL text."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_layers(spark: SparkSession, prefix: str = "", location: str | None = None) -> DataFrame:
    """Create the four databases with their comments; (layer, comment) of each."""
    for name, comment in LAYERS.items():
        where = f" LOCATION {_literal(f'{location}/{prefix}{name}')}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(prefix + name)} COMMENT {_literal(comment)}{where}")
    made = [spark.catalog.getDatabase(prefix + name) for name in LAYERS]
    return small_frame(spark, [(d.name, d.description) for d in made], "layer string, comment string")


#: Where the generation before the current one lies; it can be restored.
PREVIOUS = "tradeloom.previous"


def _staged(df: DataFrame, schema: str, table: str, layout: Layout, folder: str) -> None:
    """Write a new table over a fresh folder, and check that it holds every row that was written."""
    spark = df.sparkSession
    ordered = [c for c in (*layout.partition_by, *layout.sort_by) if c in df.columns]
    seen = Observation()
    place = unused(df, "_place")
    if layout.zorder_by:
        df = with_zorder_key(df, layout.zorder_by, place)
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if place in df.columns:
        # Rows alike in all of the columns have one key; the hash of the row spreads them over files.
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        df = df.repartitionByRange(place, spread).sortWithinPartitions(place).drop(place)
    elif ordered and not layout.bucket_by:
        if layout.range_clustered:
            df = df.repartitionByRange(*ordered, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        df = df.sortWithinPartitions(*ordered)
    writer = df.write.format("parquet").option("path", folder)
    for column in layout.bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if layout.bloom:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    if layout.bucket_by:
        writer = writer.bucketBy(layout.buckets, *layout.bucket_by).sortBy(*(layout.sort_by or layout.bucket_by))
    writer.saveAsTable(quoted(schema, table))
    # A range layout computes its input twice, so the observed rows are those or twice as many.
    stored, wrote = spark.table(quoted(schema, table)).count(), seen.get["rows"]
    if wrote not in (stored, 2 * stored):
        raise RuntimeError(f"{table}: {stored} rows stored of {wrote}")


def _described(spark: SparkSession, schema: str, table: str) -> dict[str, str]:
    """Location, type, and bucketing of a stored table."""
    wanted = ("Location", "Type", "Num Buckets", "Bucket Columns", "Sort Columns", "Provider")
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(schema, table)}").collect()
    return {r.col_name: r.data_type for r in rows if r.col_name in wanted}


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def write_table(df: DataFrame, schema: str, table: str, layout: Layout | None = None) -> None:
    """Replace a Parquet table as a whole, or not at all.

    The rows go to a fresh folder under the table's and are counted there. Only then does the catalog
    switch: to the new location in one statement if columns and layout are the same, otherwise by names,
    which are put back if the switch fails. A write that fails leaves the old rows readable, and may read
    the table it replaces. The generation before stays on disk until the next write (see
    ``restore_previous``); what is older is deleted.

    Sorting happens inside each task: no shuffle, and the row groups of a file cover narrow
    ranges of the lookup columns, so their min/max statistics let scans skip most of them.
    ``range_clustered`` also shuffles by range, which makes whole files skippable but reads the
    input twice. A hash of the row is its last range column, so the rows of one hot value are
    spread over several files.
    """
    spark, layout = df.sparkSession, layout or Layout()
    run = uuid.uuid4().hex
    root = f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{table}"
    folder, fresh, target = f"{root}/generation-{run}", f"{table}__new_{run}", quoted(schema, table)
    try:
        _staged(df, schema, fresh, layout, folder)
        if not spark.catalog.tableExists(f"{schema}.{table}"):
            spark.sql(f"ALTER TABLE {quoted(schema, fresh)} RENAME TO {target}")
            return
        old, new = _described(spark, schema, table), _described(spark, schema, fresh)
        earlier = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}.get(PREVIOUS)
        place = ("Location", "Type")
        alike = {k: v for k, v in old.items() if k not in place} == {k: v for k, v in new.items() if k not in place}
        fields = [[(f.name, f.dataType) for f in spark.table(x).schema] for x in (target, quoted(schema, fresh))]
        if alike and old["Type"] == "EXTERNAL" and fields[0] == fields[1] and not layout.partition_by:
            spark.sql(f"ALTER TABLE {target} SET LOCATION {_literal(folder)}")
            spark.sql(f"DROP TABLE {quoted(schema, fresh)}")
        else:
            _swap(spark, schema, table, fresh)
        spark.sql(f"REFRESH TABLE {target}")
        if old["Type"] == "EXTERNAL":
            spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({_literal(PREVIOUS)} = {_literal(old['Location'])})")
        if earlier and earlier.rstrip("/").rsplit("/", 1)[0].endswith(f"/{table}"):
            _delete(spark, earlier)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(schema, fresh)}")
        if not spark.catalog.tableExists(f"{schema}.{table}") or folder not in _described(spark, schema, table)["Location"]:
            _delete(spark, folder)
        raise


def _swap(spark: SparkSession, schema: str, table: str, fresh: str) -> None:
    """Give a new table the name of an old one, whose entry goes; the old name comes back if that fails."""
    target, aside = quoted(schema, table), quoted(schema, f"{fresh}_old")
    spark.sql(f"ALTER TABLE {target} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {quoted(schema, fresh)} RENAME TO {target}")
    except BaseException:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {target}")
        raise
    spark.sql(f"DROP TABLE {aside}")


def restore_previous(spark: SparkSession, schema: str, table: str) -> None:
    """Bring back the rows that the last write replaced; a second call undoes the first."""
    target = quoted(schema, table)
    earlier = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}.get(PREVIOUS)
    if not earlier:
        raise ValueError(f"{schema}.{table} has no earlier generation")
    now = _described(spark, schema, table)["Location"]
    kept = [(f.name, f.dataType) for f in spark.read.parquet(earlier).schema]
    if kept != [(f.name, f.dataType) for f in spark.table(target).schema]:
        raise ValueError(f"the earlier generation of {schema}.{table} has other columns; read it from {earlier}")
    spark.sql(f"ALTER TABLE {target} SET LOCATION {_literal(earlier)}")
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({_literal(PREVIOUS)} = {_literal(now)})")
    spark.sql(f"REFRESH TABLE {target}")


def cluster_table(spark: SparkSession, schema: str, table: str, columns: tuple[str, ...] | None = None) -> None:
    """Rewrite a stored table in Z-order of its lookup columns, with Bloom filters for those that are ids.

    Loads order rows inside their tasks, which costs no shuffle but serves one column. This serves all
    of ``columns`` (by default those of the table's specification) alike, at the price of one shuffle.
    """
    columns = columns or (TABLES[table].lookup if table in TABLES else ())
    df = spark.table(quoted(schema, table))
    columns = tuple(c for c in columns if c in df.columns)
    if not columns:
        raise ValueError(f"{schema}.{table} has no lookup columns")
    write_table(df, schema, table, Layout(zorder_by=columns, bloom=tuple(c for c in columns if c.endswith("_id"))))


def add_comments(spark: SparkSession, schema: str, specs: dict[str, TableSpec] = TABLES) -> int:
    """Document the tables and columns that exist; returns how many comments were set."""
    done = 0
    for spec in specs.values():
        if not spark.catalog.tableExists(f"{schema}.{spec.name}"):
            continue
        table = quoted(schema, spec.name)
        spark.sql(f"COMMENT ON TABLE {table} IS {_literal(spec.comment)}")
        done += 1
        present = set(spark.table(table).columns)
        for column, comment in spec.column_comments.items():
            if column in present:
                spark.sql(f"ALTER TABLE {table} ALTER COLUMN {quoted(column)} COMMENT {_literal(comment)}")
                done += 1
    return done


def load_tables(spark: SparkSession, schema: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The canonical tables of a database."""
    return {n: spark.table(quoted(schema, n)) for n in names or TABLES if spark.catalog.tableExists(f"{schema}.{n}")}


def create_views(spark: SparkSession, t: dict[str, DataFrame], views: dict[str, Callable] = VIEWS) -> list[str]:
    """(Re)register the summary views; each stays a lazy plan until queried."""
    for name, build in views.items():
        build(t).createOrReplaceTempView(name)
    return list(views)


def refresh_all(
    spark: SparkSession,
    t: dict[str, DataFrame],
    schema: str = "analytics",
    names: list[str] | None = None,
    builds: dict[str, Callable] = MATERIALIZED,
) -> DataFrame:
    """Rebuild the materialized datasets; (name, row_count, error) of each.

    A build that fails keeps the rows it had, is reported with its error, and does not stop the others.
    """
    done = []
    for name in names or builds:
        try:
            write_table(builds[name](t), schema, name)
            done.append((name, spark.table(quoted(schema, name)).count(), None))
        except Exception as problem:  # noqa: BLE001 - whatever went wrong belongs in the report
            done.append((name, None, str(problem)))
    return small_frame(spark, done, "name string, row_count bigint, error string")


def _tables(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema) if t.tableType != "VIEW" and not t.isTemporary)


def analyze_schema(spark: SparkSession, schema: str) -> DataFrame:
    """Collect column statistics for every table of a database; (table_name, row_count, columns) of each,
    as Spark holds them afterwards: stored rows, and columns with statistics.
    """
    names, done = _tables(spark, schema), []
    for name in names:
        table = quoted(schema, name)
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
        now = spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_literal(ANALYZED)} = {_literal(now)})")
        held = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'").first()
        rows = int(held.data_type.split(", ")[1].split(" ")[0])
        counted = [
            {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {table} {quoted(c)}").collect()}
            for c in spark.table(table).columns
        ]
        done.append((name, rows, sum(c.get("distinct_count") not in (None, "NULL") for c in counted)))
    return small_frame(spark, done, "table_name string, row_count bigint, columns bigint")


def table_stats(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """(row_count, column_count, table_size, last_analyzed) of a table."""
    name = quoted(schema, table)
    df = spark.table(name)
    # The planner's size: stored statistics, or the length of the files before any were collected.
    size = str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(pretty_size(int(size))).alias("table_size"),
        F.lit(properties.get(ANALYZED)).cast("timestamp").alias("last_analyzed"),
    )
