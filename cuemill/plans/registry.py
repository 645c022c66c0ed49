"""All queries of the core by name, with their SQL counterparts where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cases, queries_align, queries_flow, queries_resolve, queries_text

Query = Callable[[SparkSession, str], DataFrame]


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return queries_text.QUERIES["boundary_classes"](spark, d)


def queries() -> dict[str, Query]:
    return {**queries_text.QUERIES, **queries_flow.QUERIES, **queries_align.QUERIES, **queries_resolve.QUERIES, **cases.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**queries_text.SQL, **queries_flow.SQL, **queries_align.SQL, **queries_resolve.SQL, **cases.SQL}
