"""Clauses between patterns: projection, grouping, order, paging, set union, UNWIND, CALL, FOREACH."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..graph import Graph


def returning(df: DataFrame, *keys: Column | str, distinct: bool = False, **aggs: Column) -> DataFrame:
    """RETURN / WITH: plain projection, or grouped by every non-aggregate item."""
    if aggs:
        out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    else:
        out = df.select(*keys)
    return out.distinct() if distinct else out


def order_by(df: DataFrame, *keys: str | tuple[str, str]) -> DataFrame:
    """ORDER BY with NULL as the smallest value."""
    cols = []
    for key in keys:
        name, direction = (key, "asc") if isinstance(key, str) else key
        cols.append(F.col(name).asc_nulls_first() if direction == "asc" else F.col(name).desc_nulls_last())
    return df.orderBy(*cols)


def page(df: DataFrame, skip: int = 0, limit: int | None = None) -> DataFrame:
    """SKIP n LIMIT m."""
    if skip:
        df = df.offset(skip)
    return df if limit is None else df.limit(limit)


def union_rows(first: DataFrame, *others: DataFrame, keep_all: bool = False) -> DataFrame:
    """UNION [ALL], columns by position, duplicates removed unless ``keep_all``."""
    for other in others:
        first = first.union(other)
    return first if keep_all else first.distinct()


def unwind(df: DataFrame, items: Column, name: str) -> DataFrame:
    """One row per list element; an empty or missing list gives no row."""
    return df.select("*", F.explode(items).alias(name))


def call(outer: DataFrame, inner: DataFrame, on: list[str], keep_empty: bool = False) -> DataFrame:
    """CALL { WITH keys … }: the subquery computed once for all outer rows, then joined (C11)."""
    return outer.join(inner, on, "left" if keep_empty else "inner")


def call_top(outer: DataFrame, inner: DataFrame, on: list[str], order: list[Column], limit: int, keep_empty: bool = False) -> DataFrame:
    """CALL { WITH keys … ORDER BY … LIMIT n }: the first rows of the subquery for every outer row (C11).

    Spark keeps ``limit`` rows per key and task before it shuffles.
    """
    rank = F.row_number().over(W.partitionBy(*on).orderBy(*order))
    return call(outer, inner.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank"), on, keep_empty)


def foreach(graph: Graph, rows: DataFrame, items: Column, name: str, update: Callable[[Graph, DataFrame], Graph]) -> Graph:
    """FOREACH (name IN items | update): all elements of all rows as one batch update."""
    return update(graph, unwind(rows, items, name))


def explain(df: DataFrame, mode: str = "formatted") -> str:
    """The plan Spark chose, as text (C14)."""
    jvm_mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(jvm_mode)
