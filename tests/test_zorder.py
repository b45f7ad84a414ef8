"""Z-ordered tables: whole, and with row groups that filters on any lookup column skip."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tradeloom.operators.clustering import place_of
from tradeloom.sources.specs import TABLES, Layout
from tradeloom.warehouse import catalog


@pytest.fixture(scope="module")
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS zorder_db")
    yield "zorder_db"
    spark.sql("DROP DATABASE zorder_db CASCADE")


def orders(spark, rows=16000):
    return spark.range(rows, numPartitions=4).select(
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
        F.sha2((F.col("id") % 4000).cast("string"), 256).alias("customer_id"),
        F.when(F.hash("id") % 3 == 0, None).otherwise(F.concat(F.lit("s"), F.pmod(F.hash("id"), F.lit(8)))).alias("order_status"),
        (F.lit("2017-01-01").cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, 0, pmod(hash(id, 1), 9000000))")).alias("order_purchase_timestamp"),
    )


def groups(spark, table):
    """(min, max) of each row group for a column, over the files that the table reads."""
    files = [f.removeprefix("file://").removeprefix("file:") for f in spark.table(table).inputFiles()]
    return [pq.ParquetFile(f).metadata.row_group(g) for f in files for g in range(pq.ParquetFile(f).metadata.num_row_groups)]


def share_read(found, column, value):
    def may_hold(group):
        stats = next(group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema == column).statistics
        if stats is None or not stats.has_min_max:
            return False
        return stats.min <= value <= stats.max

    return sum(map(may_hold, found)) / len(found)


def test_every_lookup_column_skips_row_groups(spark, db):
    df = orders(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        catalog.write_table(df, db, "orders")
        plain = groups(spark, f"{db}.orders")
        catalog.cluster_table(spark, db, "orders")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.table(f"{db}.orders")
    assert stored.exceptAll(df).isEmpty() and stored.count() == df.count()
    found = groups(spark, f"{db}.orders")
    assert len(found) >= 32
    row = df.where("order_status IS NOT NULL").first()
    for column in TABLES["orders"].lookup:
        value = row[column]
        value = value.astimezone(dt.timezone.utc) if isinstance(value, dt.datetime) else value
        assert share_read(found, column, value) <= 0.5, column
        assert share_read(plain, column, value) == 1, column


def test_ids_have_bloom_filters(spark, db):
    catalog.write_table(orders(spark, 500), db, "blooms", Layout(zorder_by=("customer_id", "order_status"), bloom=("customer_id",)))
    jvm, path = spark._jvm, spark.table(f"{db}.blooms").inputFiles()[0]
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    try:
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        held = {columns.get(i).getPath().toDotString(): columns.get(i).getBloomFilterOffset() for i in range(columns.size())}
    finally:
        reader.close()
    assert held["customer_id"] > 0 and held["order_status"] < 0


def test_places(spark):
    cuts = [3, 5, 9]
    rows = spark.createDataFrame([(v,) for v in [None, 1, 3, 4, 5, 8, 9, 100]], "v int")
    got = {r.v: r.at for r in rows.select("v", place_of(F.col("v"), F.array(*map(F.lit, cuts)), 4).alias("at")).collect()}
    assert got == {None: 0, 1: 0, 3: 1, 4: 1, 5: 2, 8: 2, 9: 3, 100: 3}


def test_edges(spark, db):
    """Empty tables, columns of NULLs and NaN, one value only; a table without lookup columns is refused."""
    schema = "a double, b string, `c d` int"
    for rows in ([], [(None, None, None)] * 3, [(float("nan"), "x", 1), (1.0, "x", 1), (-0.0, None, 1)]):
        df = spark.createDataFrame(rows, schema)
        catalog.write_table(df, db, "edges", Layout(zorder_by=("a", "b", "c d")))
        assert sorted(map(str, spark.table(f"{db}.edges").collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError, match="lookup"):
        catalog.cluster_table(spark, db, "edges")


def test_every_index_column_has_a_home():
    assert sum(len(spec.lookup) for spec in TABLES.values()) == 19
    assert all(set(spec.lookup) <= set(spec.columns) for spec in TABLES.values())
