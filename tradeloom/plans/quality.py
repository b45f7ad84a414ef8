"""Data-quality operators: duplicates, date profiles, validation rules, generic tests, links,
outliers, freshness and metric trends. All return DataFrames; none loops over rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import percent
from ..operators.ordered import exact_quantiles, with_previous
from ..session import small_frame
from ..sources.specs import LINKS

Tables = Mapping[str, DataFrame]

RULE_SCHEMA = (
    "rule_id bigint, rule_name string, table_name string, rule_sql string, expected_result string, "
    "severity string, is_active boolean"
)


def union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


# Table checks


def check_duplicates(df: DataFrame, key: str | list[str]) -> DataFrame:
    """(duplicate_count, total_duplicates): repeated keys, and rows beyond the first of each.

    NULL is a key like any other. Without duplicates the second column is NULL.
    """
    repeated = df.groupBy(*_keys(key)).agg(F.count("*").alias("_copies")).where("_copies > 1")
    return repeated.agg(
        F.count("*").alias("duplicate_count"), F.sum(F.col("_copies") - 1).alias("total_duplicates")
    )


def profile_date_column(df: DataFrame, column: str) -> DataFrame:
    """(min_date, max_date, date_range_days, null_count, null_percentage) of a date or timestamp."""
    c = F.col(column)
    first, last = F.to_date(F.min(c)), F.to_date(F.max(c))
    nulls = F.count_if(c.isNull())
    return df.agg(
        first.alias("min_date"),
        last.alias("max_date"),
        F.datediff(last, first).alias("date_range_days"),
        nulls.alias("null_count"),
        percent(nulls, F.count("*"), 2).cast("decimal(5,2)").alias("null_percentage"),
    )


def null_audit(df: DataFrame) -> DataFrame:
    """(column, null_count, null_pct) of the columns that have NULLs."""
    return completeness(df).where("null_count > 0").select("column", "null_count", "null_pct")


def completeness(df: DataFrame) -> DataFrame:
    """(column, total_rows, null_count, null_pct) of every column, from one aggregate row."""
    names = df.columns
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{n}`").isNull()).alias(f"n{i}") for i, n in enumerate(names)]
    )
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"n{i}").alias("null_count")) for i, n in enumerate(names)])
    return counts.select(F.col("_rows").alias("total_rows"), F.inline(rows)).select(
        "column",
        "total_rows",
        "null_count",
        percent(F.col("null_count"), F.col("total_rows"), 1).cast("double").alias("null_pct"),
    )


def completeness_report(t: Tables) -> DataFrame:
    """Completeness of every table, with its name in front."""
    return union(completeness(df).select(F.lit(name).alias("table_name"), "*") for name, df in t.items())


# Generic column tests: the failing rows. An empty result is a pass.


def test_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULL is ignored."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which the column is NULL."""
    return df.where(F.col(column).isNull())


# Validation rules


@dataclass(frozen=True)
class Rule:
    """A rule counts violations: rows of a table for which a predicate is true (not NULL).

    Predicate rules of one table share a scan. A rule may instead carry any one-cell query.
    """

    name: str
    table: str
    predicate: str | None = None
    sql: str | None = None
    expected: str = "0"
    severity: str = "WARNING"
    active: bool = True

    def query(self, schema: str = "raw_data") -> str:
        return self.sql or f"SELECT COUNT(*) FROM {schema}.{self.table} WHERE {self.predicate}"


def date_range_predicate(low: str = "2016-01-01", high: str = "2020-12-31") -> str:
    """The upper bound is a midnight: later hours of that day are outside too."""
    c = "order_purchase_timestamp"
    return f"({c} < TIMESTAMP_NTZ '{low}' OR {c} > TIMESTAMP_NTZ '{high}')"


# Names, severities and expected results of the standard rules.
def standard_rules(low: str = "2016-01-01", high: str = "2020-12-31") -> list[Rule]:
    return [
        Rule("Orders should have valid customer_id", "orders", "customer_id IS NULL", severity="ERROR"),
        Rule("Order items should have positive prices", "order_items", "price <= 0", severity="ERROR"),
        Rule(
            "Review scores should be between 1 and 5", "order_reviews", "NOT (review_score BETWEEN 1 AND 5)",
            severity="ERROR",
        ),
        Rule("Order dates should be reasonable", "orders", date_range_predicate(low, high)),
        Rule(
            "Delivered orders should have delivery date", "orders",
            "order_status = 'delivered' AND order_delivered_customer_date IS NULL",
        ),
    ]


def rules_frame(spark: SparkSession, rules: list[Rule], schema: str = "raw_data") -> DataFrame:
    """The rules as a table, ready to be stored."""
    rows = [
        (i, r.name, r.table, r.query(schema), r.expected, r.severity, r.active) for i, r in enumerate(rules, start=1)
    ]
    return small_frame(spark, rows, RULE_SCHEMA).withColumn("created_at", F.current_timestamp())


def violations(df: DataFrame, predicate: str) -> DataFrame:
    """One row, one column: how many rows break the rule."""
    return df.agg(F.count_if(F.expr(predicate)).alias("violations"))


RESULT_SCHEMA = (
    "rule_id bigint, rule_name string, table_name string, actual string, expected string, passed boolean, severity string"
)


def _rule_row(rule_id: int, rule: Rule, actual: Column) -> Column:
    return F.struct(
        F.lit(rule_id).cast("bigint").alias("rule_id"),
        F.lit(rule.name).alias("rule_name"),
        F.lit(rule.table).alias("table_name"),
        actual.cast("string").alias("actual"),
        F.lit(rule.expected).alias("expected"),
        F.coalesce(actual.cast("string") == F.lit(rule.expected), F.lit(False)).alias("passed"),
        F.lit(rule.severity).alias("severity"),
    )


def run_rules(spark: SparkSession, t: Tables, rules: list[Rule], schema: str = "raw_data") -> DataFrame:
    """(rule_id, rule_name, table_name, actual, expected, passed, severity) of the active rules.

    A rule passes when its result equals the expected text.
    """
    numbered = [(i, r) for i, r in enumerate(rules, start=1) if r.active]
    parts = []
    for table in dict.fromkeys(r.table for _, r in numbered if r.predicate):
        mine = [(i, r) for i, r in numbered if r.predicate and r.table == table]
        counts = t[table].agg(*[F.count_if(F.expr(r.predicate)).alias(f"r{i}") for i, r in mine])
        parts.append(counts.select(F.inline(F.array(*[_rule_row(i, r, F.col(f"r{i}")) for i, r in mine]))))
    for i, r in numbered:
        if not r.predicate:
            cell = spark.sql(r.query(schema))
            parts.append(cell.limit(1).select(F.inline(F.array(_rule_row(i, r, F.col(f"`{cell.columns[0]}`"))))))
    return union(parts) if parts else small_frame(spark, [], RESULT_SCHEMA)


def run_stored_rules(spark: SparkSession, rules_table: str) -> DataFrame:
    """Run the active rules of a stored rule table by their own SQL. The table is a short list."""
    stored = spark.table(rules_table).orderBy("rule_id").collect()
    rules = [
        Rule(r.rule_name, r.table_name, None, r.rule_sql, r.expected_result, r.severity, r.is_active) for r in stored
    ]
    return run_rules(spark, {}, rules)


def rule_pass_rates(results: DataFrame) -> DataFrame:
    """(table_name, severity, rules, passed, pass_rate) over rule results."""
    passed = F.count_if("passed")
    return results.groupBy("table_name", "severity").agg(
        F.count("*").alias("rules"),
        passed.alias("passed_rules"),
        percent(passed, F.count("*"), 1).cast("double").alias("pass_rate"),
    )


def rule_metrics(results: DataFrame) -> DataFrame:
    """Rule results in the shape of quality metrics."""
    return results.select(
        "table_name",
        F.col("rule_name").alias("metric_name"),
        F.col("actual").try_cast("decimal(38,18)").alias("metric_value"),
        F.when(F.col("passed"), "PASS").otherwise(F.col("severity")).alias("metric_status"),
        F.to_json(F.struct("rule_id", "expected")).alias("details"),
    )


# Across tables


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row: child keys without a parent, and the child rows that hold them.

    Child keys are counted before the join, so a key held by a third of the rows is one row in
    it. NULL references nothing and is not an orphan.
    """
    held = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count("*").alias("_rows"))
    )
    known = parent.select(F.col(parent_column).alias("_key"))
    return held.join(known, "_key", "left_anti").agg(
        F.count("*").alias("orphan_keys"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows")
    )


def referential_integrity(t: Tables, links: list[tuple[str, str, str, str]] = LINKS) -> DataFrame:
    """(child_table, child_column, parent_table, orphan_keys, orphan_rows) of every link."""
    return union(
        orphans(t[child], column, t[parent], parent_column).select(
            F.lit(child).alias("child_table"),
            F.lit(column).alias("child_column"),
            F.lit(parent).alias("parent_table"),
            "orphan_keys",
            "orphan_rows",
        )
        for child, column, parent, parent_column in links
    )


def outlier_bounds(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """(q1, q3, lower_bound, upper_bound) by the interquartile-range rule, from exact quartiles."""
    spread = (F.col("q3") - F.col("q1")) * F.lit(factor)
    return exact_quantiles(df, column, {"q1": 0.25, "q3": 0.75}).select(
        "q1", "q3", (F.col("q1") - spread).alias("lower_bound"), (F.col("q3") + spread).alias("upper_bound")
    )


def outliers_iqr(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """The rows outside the bounds, with the bounds attached."""
    bounds = outlier_bounds(df, column, factor).select(F.struct("lower_bound", "upper_bound").alias("b")).scalar()
    held = df.withColumn("_b", bounds)
    low, high = F.col("_b.lower_bound"), F.col("_b.upper_bound")
    return (
        held.where((F.col(column) < low) | (F.col(column) > high))
        .withColumn("lower_bound", low)
        .withColumn("upper_bound", high)
        .drop("_b")
    )


def freshness(t: Tables, columns: dict[str, str], as_of: str) -> DataFrame:
    """(table_name, latest, lag_days): the newest timestamp of each table and its age."""
    return union(
        t[name].agg(F.max(column).alias("latest")).select(
            F.lit(name).alias("table_name"),
            "latest",
            F.datediff(F.to_date(F.lit(as_of)), F.to_date("latest")).alias("lag_days"),
        )
        for name, column in columns.items()
    )


def metric_trend(metrics: DataFrame) -> DataFrame:
    """Each metric value with the one before it and the change.

    A metric's history is cut by month, so one long history is not one task's work.
    """
    at = F.col("check_timestamp")
    month = F.year(at) * 12 + F.month(at)
    return with_previous(
        metrics, ["table_name", "metric_name"], "check_timestamp", "metric_value", "previous_value", month
    ).withColumn("change", F.col("metric_value") - F.col("previous_value"))


def daily_row_counts(df: DataFrame, table: str, timestamp: str, metric: str | Column = "row_count") -> DataFrame:
    """A metric history read off a table's own dates: rows per day."""
    label = F.lit(metric) if isinstance(metric, str) else metric
    day = F.date_trunc("day", timestamp).cast("timestamp_ntz")
    counts = df.groupBy(label.alias("metric_name"), day.alias("check_timestamp")).agg(F.count("*").alias("metric_value"))
    return counts.select(F.lit(table).alias("table_name"), "metric_name", "check_timestamp", "metric_value")
