"""Tables are replaced as a whole, or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from tradeloom.sources.specs import Layout
from tradeloom.warehouse import catalog, loading


@pytest.fixture
def db(spark, tmp_path):
    name = f"gen_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def failing(spark, n):
    return spark.range(n).select(F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("broken row")).cast("long")).alias("id"))


def ids(spark, table):
    return sorted(r[0] for r in spark.table(table).select("id").collect())


@pytest.mark.parametrize("layout", [Layout(), Layout(sort_by=("id",)), Layout(sort_by=("id",), range_clustered=True), Layout(bucket_by=("id",), buckets=2)])
def test_a_failed_write_keeps_the_old_rows(spark, db, tmp_path, layout):
    catalog.write_table(spark.range(5), db, "t", layout)
    with pytest.raises(Exception, match="broken row"):
        catalog.write_table(failing(spark, 50), db, "t", layout)
    assert ids(spark, f"{db}.t") == [0, 1, 2, 3, 4]
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]
    assert len([n for n in os.listdir(f"{tmp_path}/{db}/t") if n.startswith("generation-")]) == 1
    catalog.write_table(spark.range(7), db, "t", layout)
    assert ids(spark, f"{db}.t") == list(range(7))


def test_a_first_write_that_fails_leaves_nothing(spark, db):
    with pytest.raises(Exception, match="broken row"):
        catalog.write_table(failing(spark, 50), db, "t")
    assert spark.catalog.listTables(db) == []


def test_generations_are_kept_and_restored(spark, db, tmp_path):
    for n in (1, 2, 3, 4):
        catalog.write_table(spark.range(n), db, "t")
    assert len(os.listdir(f"{tmp_path}/{db}/t")) == 2
    catalog.restore_previous(spark, db, "t")
    assert ids(spark, f"{db}.t") == [0, 1, 2]
    catalog.restore_previous(spark, db, "t")
    assert ids(spark, f"{db}.t") == [0, 1, 2, 3]


def test_a_table_may_replace_itself_and_change_its_columns(spark, db):
    catalog.write_table(spark.range(3), db, "t")
    catalog.write_table(spark.table(f"{db}.t").where("id > 0"), db, "t")
    assert ids(spark, f"{db}.t") == [1, 2]
    catalog.write_table(spark.table(f"{db}.t").select("id", F.lit("x").alias("more")), db, "t")
    assert spark.table(f"{db}.t").columns == ["id", "more"] and ids(spark, f"{db}.t") == [1, 2]
    catalog.write_table(spark.range(6).withColumn("p", F.col("id") % 2), db, "t", Layout(partition_by=("p",)))
    catalog.write_table(spark.range(8).withColumn("p", F.col("id") % 3), db, "t", Layout(partition_by=("p",)))
    assert ids(spark, f"{db}.t") == list(range(8)) and spark.table(f"{db}.t").where("p = 2").count() == 2
    with pytest.raises(ValueError, match="other columns"):
        catalog.write_table(spark.range(2), db, "t")
        catalog.restore_previous(spark, db, "t")


def test_comments_stay_and_statistics_go(spark, db):
    catalog.write_table(spark.range(3), db, "t")
    spark.sql(f"COMMENT ON TABLE {db}.t IS 'three'")
    catalog.analyze_schema(spark, db)
    catalog.write_table(spark.range(4), db, "t")
    assert spark.catalog.getTable(f"{db}.t").description == "three"
    assert catalog.table_stats(spark, db, "t").first()["row_count"] == 4
    assert spark.sql(f"DESCRIBE TABLE EXTENDED {db}.t").where("col_name = 'Statistics' AND data_type LIKE '%3 rows%'").isEmpty()


def test_a_failed_refresh_is_reported_and_the_others_are_built(spark, db):
    catalog.write_table(spark.range(2), db, "b")
    builds = {"a": lambda t: t["x"], "b": lambda t: failing(spark, 30), "c": lambda t: t["x"].where("id > 1"), "d": lambda t: t["none"]}
    got = {r["name"]: r for r in catalog.refresh_all(spark, {"x": spark.range(3)}, db, builds=builds).collect()}
    assert [got[n]["row_count"] for n in "abcd"] == [3, None, 1, None]
    assert "broken row" in got["b"]["error"] and got["a"]["error"] is None and got["d"]["error"]
    assert ids(spark, f"{db}.b") == [0, 1]


def test_a_failed_load_keeps_the_table(spark, db, tmp_path):
    source = tmp_path / "raw" / "shop_sellers_dataset.csv"
    source.mkdir(parents=True)
    (source / "part-0.csv").write_text("seller_id,seller_city\n1,a\n2,b\n")
    load = lambda: {r["table_name"]: r for r in loading.load_all(spark, str(tmp_path / "raw"), db).collect()}["sellers"]
    assert load()["rows"] == 2
    (source / "part-1.csv").write_text("seller_city,seller_id\nc,3\n")
    assert load()["status"] == "FAILED" and spark.table(f"{db}.sellers").count() == 2
