"""Registering queries over the driver's tables, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` reads the orders table of a directory."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def query(name: str, sql: str | None):
    """Register ``func(tables)`` under a name."""

    def register(func: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, root: func(Tables(spark, root))
        if sql is not None:
            ORACLES[name] = sql
        return func

    return register


def cents(c: str | Column) -> Column:
    """Money as whole cents, so sums are exact in any order."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 100).cast("bigint")


def since(column: str, start: str, end: str) -> Column:
    """Half-open date range that reaches the file scan as a filter."""
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    return (F.col(column) >= day(start)) & (F.col(column) < day(end))


def flag(c: Column) -> Column:
    return c.cast("int")


def joined(c: str | Column) -> Column:
    return F.array_join(c, ",")


def severity_of(event_type: str = "event_type") -> Column:
    """Events read as findings; clicks are no finding."""
    c = F.col(event_type)
    return (
        F.when(c == "error", "error")
        .when(c == "purchase", "warn")
        .when(c == "signup", "info")
        .when(c == "view", "skipped")
    )


def user_days(events: DataFrame) -> DataFrame:
    """Events with ``day`` and ``subject`` (``user/day``)."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return events.withColumn("day", day).withColumn(
        "subject", F.concat_ws("/", F.col("user_id").cast("string"), "day")
    )


# -- SQL fragments ----------------------------------------------------------

SEVERITY_SQL = (
    "CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'warn' "
    "WHEN 'signup' THEN 'info' WHEN 'view' THEN 'skipped' END"
)
DAY_SQL = "strftime(ts, '%Y-%m-%d')"
SUBJECT_SQL = f"CAST(user_id AS VARCHAR) || '/' || {DAY_SQL}"


def described_sql(key: str, condition: str = "TRUE", limit: int = 5) -> str:
    """First names of a group and how many more there are."""
    names = f"list_sort(list({key}) FILTER (WHERE {condition}))"
    n = f"count(*) FILTER (WHERE {condition})"
    return (
        f"coalesce(array_to_string(list_slice({names}, 1, {limit}), ', '), '') || "
        f"CASE WHEN {n} > {limit} THEN ' (+' || ({n} - {limit}) || ' more)' ELSE '' END"
    )


def cents_sql(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"
