"""Where queries are registered together with their check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `check` is SQL over the views `products`, `products_raw`, `payloads`."""
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = with_views(check)
        return function

    return register


def with_views(sql: str) -> str:
    """The SQL, led by those catalogue views it mentions."""
    known = {"products_raw": views.PRODUCTS_RAW, "products": views.PRODUCTS, "payloads": views.PAYLOADS}
    used = [f"{name} AS ({views.in_check(text)})" for name, text in known.items() if _mentions(sql, name)]
    sql = sql.strip()
    if not used:
        return sql
    if sql[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(used) + ",\n" + sql[5:]
    return "WITH " + ",\n".join(used) + "\n" + sql


def _mentions(sql: str, name: str) -> bool:
    return f" {name} " in f" {' '.join(sql.replace(')', ' ) ').replace('(', ' ( ').replace(',', ' , ').split())} "


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, views.PRODUCTS)


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, views.PRODUCTS_RAW)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, views.PAYLOADS)
