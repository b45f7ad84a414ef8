"""Views stored in a database, by their SQL text, with the order in which they depend on each other.

A stored view lasts as long as the catalog: every session on it reads the view. Its text is also kept in a
registry, a table of the same database, from which ``restore`` makes the views of a catalog that lost them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..plans.view_sql import STORED_VIEWS, View
from ..session import small_frame
from .catalog import _literal, quoted, write_table

REGISTRY = "view_registry"
COLUMNS = "name string, needs string, sql string, comment string"


def in_order(views: Iterable[View]) -> list[View]:
    """Every view after those that it needs; needs outside the list are taken to exist."""
    waiting = {v.name: v for v in views}
    done: list[View] = []
    while waiting:
        ready = [v for v in waiting.values() if not any(n in waiting for n in v.needs)]
        if not ready:
            raise ValueError(f"views need each other: {', '.join(sorted(waiting))}")
        for view in ready:
            done.append(waiting.pop(view.name))
    return done


def registered(spark: SparkSession, schema: str) -> dict[str, View]:
    """The registered views, their texts with the database names filled in."""
    if not spark.catalog.tableExists(f"{schema}.{REGISTRY}"):
        return {}
    rows = spark.table(quoted(schema, REGISTRY)).collect()
    return {r["name"]: View(r["name"], r["sql"], tuple(json.loads(r["needs"])), r["comment"]) for r in rows}


def _register(spark: SparkSession, schema: str, views: dict[str, View]) -> None:
    rows = [(v.name, json.dumps(v.needs), v.sql, v.comment) for v in views.values()]
    write_table(small_frame(spark, rows, COLUMNS).coalesce(1), schema, REGISTRY)


def _create(spark: SparkSession, schema: str, view: View) -> None:
    comment = f" COMMENT {_literal(view.comment)}" if view.comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(schema, view.name)}{comment} AS {view.sql}")


def store_views(spark: SparkSession, raw: str, schema: str = "analytics", views: Iterable[View] = STORED_VIEWS) -> list[str]:
    """Create or replace views over the tables of ``raw``, in the order of their needs, and register them.

    A text that Spark refuses raises, and its view stays as it was.
    """
    known, done = registered(spark, schema), []
    for view in in_order(views):
        text = view.sql.replace("{raw}", quoted(raw)).replace("{views}", quoted(schema))
        filled = View(view.name, text, view.needs, view.comment)
        _create(spark, schema, filled)
        known[view.name] = filled
        done.append(view.name)
    _register(spark, schema, known)
    return done


def drop_view(spark: SparkSession, schema: str, name: str) -> None:
    """Drop a stored view; one that another view needs is kept and raises."""
    known = registered(spark, schema)
    users = sorted(v.name for v in known.values() if name in v.needs)
    if users:
        raise ValueError(f"{schema}.{name} is needed by {', '.join(users)}")
    spark.sql(f"DROP VIEW IF EXISTS {quoted(schema, name)}")
    if known.pop(name, None):
        _register(spark, schema, known)


def restore(spark: SparkSession, schema: str = "analytics") -> list[str]:
    """Make every registered view again; returns their names in the order of their needs."""
    views = in_order(registered(spark, schema).values())
    for view in views:
        _create(spark, schema, view)
    return [v.name for v in views]


def list_views(spark: SparkSession, schema: str = "analytics") -> DataFrame:
    """(name, needs, comment, stored) of the registered views; ``stored`` tells whether the catalog has it."""
    rows = [(v.name, list(v.needs), v.comment, spark.catalog.tableExists(f"{schema}.{v.name}")) for v in registered(spark, schema).values()]
    return small_frame(spark, rows, "name string, needs array<string>, comment string, stored boolean")
