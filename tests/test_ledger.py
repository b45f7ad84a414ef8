"""Appends to the monitoring tables: beside each other, repeated, failing, and over an earlier session's files."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tradeloom.warehouse.monitoring import LOT, Ledger, append_metrics


@pytest.fixture()
def db(spark, tmp_path):
    spark.sql(f"CREATE DATABASE ledger_db LOCATION '{tmp_path}/db'")
    yield "ledger_db"
    spark.sql("DROP DATABASE ledger_db CASCADE")


def metrics(spark, rows, name="m"):
    return spark.range(rows).select(
        F.lit("t").alias("table_name"), F.concat(F.lit(name), "id").alias("metric_name"), F.col("id").alias("metric_value"),
        F.lit("PASS").alias("metric_status"), F.lit("{}").alias("details"),
    )


def ids(spark, table):
    return [r.metric_id for r in spark.table(table).select("metric_id").collect()]


def test_writers_beside_each_other(spark, db):
    table = f"{db}.metrics"
    append_metrics(spark, metrics(spark, 1), table)

    def write(n):
        return append_metrics(spark.newSession(), metrics(spark, 5, f"w{n}-"), table)

    with ThreadPoolExecutor(4) as pool:
        assert all(pool.map(write, range(6)))
    spark.sql(f"REFRESH TABLE {table}")
    found = ids(spark, table)
    assert len(found) == len(set(found)) == 31
    assert spark.table(table).where("metric_name LIKE 'w%'").select("metric_name").distinct().count() == 30


def test_repeated_run_adds_nothing(spark, db):
    table = f"{db}.metrics"
    assert append_metrics(spark, metrics(spark, 3), table, run_key="2026-01-01")
    assert not append_metrics(spark, metrics(spark, 3), table, run_key="2026-01-01")
    assert append_metrics(spark, metrics(spark, 3), table, run_key="2026-01-02")
    assert sorted(ids(spark, table)) == [1, 2, 3, LOT + 1, LOT + 2, LOT + 3]


def test_more_rows_than_a_lot_and_none(spark, db):
    table = f"{db}.metrics"
    append_metrics(spark, metrics(spark, 2 * LOT + 7), table)
    append_metrics(spark, metrics(spark, 0), table)
    assert sorted(ids(spark, table)) == list(range(1, 2 * LOT + 8))


def test_failing_append_leaves_the_table(spark, db, tmp_path):
    table = f"{db}.metrics"
    append_metrics(spark, metrics(spark, 2), table)
    bad = metrics(spark, 2).withColumn("details", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        append_metrics(spark, bad, table, run_key="r")
    assert ids(spark, table) == [1, 2]
    assert not [n for n in os.listdir(tmp_path / "db" / "metrics") if n.startswith("_staged")]
    assert append_metrics(spark, metrics(spark, 2), table, run_key="r")


def test_files_of_an_earlier_session(spark, db):
    """The catalog entry goes, the files stay: rows, ids and run keys go on from there."""
    table = f"{db}.metrics"
    append_metrics(spark, metrics(spark, 2), table, run_key="a")
    spark.sql(f"DROP TABLE {table}")
    assert not append_metrics(spark, metrics(spark, 2), table, run_key="a")
    append_metrics(spark, metrics(spark, 2), table, run_key="b")
    assert sorted(ids(spark, table)) == [1, 2, LOT + 1, LOT + 2]


def test_ids_go_on_after_rows_without_lots(spark, db):
    table = f"{db}.old"
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{Ledger(spark, table).root}' AS SELECT 5000L AS metric_id, 'x' AS word")
    Ledger(spark, table).append(spark.createDataFrame([("y",)], "word string"), "metric_id", None)
    assert min(i for i in ids(spark, table) if i != 5000) > 5000
