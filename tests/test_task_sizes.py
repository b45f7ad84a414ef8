"""What one task holds does not grow with the tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from tradeloom import session
from tradeloom.operators.rollups import reviewed_lines
from tradeloom.registry import warehouse_queries


def test_grouped_lines_are_cut_by_bytes_not_by_a_number_of_partitions(spark, monkeypatch):
    names = [*session.TASK_SETTINGS, *session.RUNTIME_SETTINGS, "spark.sql.shuffle.partitions"]
    before = {name: spark.conf.get(name, None) for name in names}
    monkeypatch.setitem(session.TASK_SETTINGS, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        session.tune_tables(spark)
        items = spark.range(200_000).select(
            F.expr("id DIV 4").alias("order_id"), F.expr("id % 1000").alias("product_id"), F.expr("id / 7D").alias("price"), F.lit(1.0).alias("freight_value")
        )
        reviews = spark.range(50_000).select(F.col("id").alias("order_id"), F.lit(5).cast("long").alias("review_score"))
        lines = reviewed_lines(items, reviews, "product_id")
        assert lines.count() == 200_000
        assert lines.groupBy(F.spark_partition_id()).count().count() > 2
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_csv_with_line_breaks_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    rows = [(i, "en", f'line "{i}"\nnext, line' if i % 3 else None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    seen, read = [], warehouse_queries.read_inferred
    monkeypatch.setattr(warehouse_queries, "read_inferred", lambda s, path, **more: seen.append(path) or read(s, path, **more))
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))  # a task for each file
    try:
        back = warehouse_queries.QUERIES["csv_line_breaks"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
    assert len(list(Path(seen[0].removeprefix("file:")).glob("part-*.csv"))) == 4
    assert {(r.doc_id, r.lang, r.n_chars) for r in back} == {(i, lang, len(text or "")) for i, lang, text in rows}
