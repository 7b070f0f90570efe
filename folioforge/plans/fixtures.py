"""Load fixture views on Spark and compose them into oracle SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import read_table
from .fixture_sql import FIXTURE_SQL

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _base_tables_of(sql: str) -> list[str]:
    words = set(re.findall(r"\b[a-z_]+\b", sql))
    return [t for t in BASE_TABLES if t in words]


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named fixture view over the parquet tables in ``sf_dir``.

    Base tables are bound as temp views for the parse; the returned DataFrame
    holds the analysed plan, so later re-binding does not affect it.
    """
    sql = FIXTURE_SQL[name]
    if name == "items":
        return _items(spark, sf_dir, sql)
    for t in _base_tables_of(sql):
        read_table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(sql)


def _items(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The ``items`` view, orders and customers joined first: line items, the many rows, are shuffled once, not per join."""
    lineitem, orders, customer = (read_table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    known = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    lineitem.join(known, lineitem["l_orderkey"] == known["o_orderkey"]).createOrReplaceTempView("item_rows")
    return spark.sql(sql[:sql.rindex("FROM lineitem")] + "FROM item_rows")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a fixture view, by name."""
    if name in FIXTURE_SQL:
        return fixture(spark, sf_dir, name)
    return read_table(spark, sf_dir, name)


def oracle(fixtures: list[str], body: str, recursive: bool = False) -> str:
    """``WITH <fixture views>[, <body ctes>] <select>`` for DuckDB."""
    ctes = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in fixtures]
    body = body.strip()
    w = "WITH RECURSIVE " if recursive else "WITH "
    if body.upper().startswith("SELECT") or not ctes:
        return (w + ",\n".join(ctes) + "\n" + body) if ctes else body
    return w + ",\n".join(ctes) + ",\n" + body
