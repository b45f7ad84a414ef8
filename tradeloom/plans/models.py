"""Models: functions that build a dataset from other datasets.

A model refers to another by calling it (or by taking its DataFrame), so Spark sees one plan.
``materialize`` stores the result as a table or a view of the target's database.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import test_not_null, test_unique, union

# Database of each target.
TARGET_SCHEMAS = {"dev": "dbt_dev", "prod": "analytics"}
DEFAULT_KIND = "view"


@dataclass(frozen=True)
class Model:
    """``build`` gets the session and the results of the models named in ``refs``.

    ``sql``, where given, is the same model as text over ``{schema}``, the target's database. A view of it
    can be stored there, which a view of a DataFrame cannot.
    """

    name: str
    build: Callable[..., DataFrame]
    refs: tuple[str, ...] = ()
    kind: str | None = None
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    sql: str | None = None


def with_null_id(rows: DataFrame, column: str) -> DataFrame:
    """The ids of a dataset followed by NULL ids: a UNION ALL of a column and a NULL literal."""
    return rows.select(F.col(column).alias("id")).unionAll(
        rows.sparkSession.range(1).select(F.lit(None).cast(rows.schema[column].dataType).alias("id"))
    )


def first_model(spark: SparkSession) -> DataFrame:
    """Two rows: id 1 and a NULL id."""
    return with_null_id(spark.range(1).select(F.lit(1).alias("one")), "one")


def second_model(first: DataFrame) -> DataFrame:
    """The rows of the first model whose id is 1."""
    return first.where(F.col("id") == 1)


MODELS = [
    Model("first_model", lambda spark: first_model(spark), kind="table", unique=("id",), not_null=("id",)),
    Model(
        "second_model", lambda spark, first: second_model(first), refs=("first_model",),
        unique=("id",), not_null=("id",), sql="SELECT id FROM {schema}.first_model WHERE id = 1",
    ),
]


def materialize(
    df: DataFrame, name: str, kind: str | None = None, target: str = "dev", sql: str | None = None
) -> DataFrame:
    """Store a model as a table, or register it as a view; the model's kind beats the default.

    A view with ``sql`` is stored in the target's database, for every session of the catalog.
    """
    spark, schema = df.sparkSession, TARGET_SCHEMAS[target]
    if (kind or DEFAULT_KIND) == "view":
        # A temporary view has no database; the target's name goes in front instead.
        df.createOrReplaceTempView(f"{schema}_{name}")
        if sql:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
            spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS {sql.replace('{schema}', schema)}")
            return spark.table(f"{schema}.{name}")
        return spark.table(f"{schema}_{name}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    df.write.mode("overwrite").format("parquet").saveAsTable(f"{schema}.{name}")
    return spark.table(f"{schema}.{name}")


def run_models(spark: SparkSession, models: list[Model] | None = None, target: str = "dev") -> dict[str, DataFrame]:
    """Build the models in their listed order."""
    done: dict[str, DataFrame] = {}
    for model in models or MODELS:
        df = model.build(spark, *[done[ref] for ref in model.refs])
        done[model.name] = materialize(df, model.name, model.kind, target, model.sql)
    return done


def failing_rows(df: DataFrame, model: Model) -> DataFrame:
    """(test, column_name, failures) for every generic test of a model."""
    tests = [(test_unique, "unique", c) for c in model.unique] + [(test_not_null, "not_null", c) for c in model.not_null]
    return union(
        test(df, column).agg(F.count("*").alias("failures")).select(
            F.lit(label).alias("test"), F.lit(column).alias("column_name"), "failures"
        )
        for test, label, column in tests
    )
