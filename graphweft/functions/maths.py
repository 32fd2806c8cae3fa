"""Numeric functions (F10–F12) and conversions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Spark type name → type name of the query language.
TYPE_NAMES = {
    "tinyint": "INTEGER", "smallint": "INTEGER", "int": "INTEGER", "bigint": "INTEGER",
    "float": "FLOAT", "double": "FLOAT",
    "string": "STRING", "boolean": "BOOLEAN", "binary": "BLOB",
}


def ceil(x: Column) -> Column:
    return F.ceil(x).cast("long")


def floor(x: Column) -> Column:
    return F.floor(x).cast("long")


def sign(x: Column) -> Column:
    return F.signum(x).cast("long")


def haversin(x: Column) -> Column:
    return (1 - F.cos(x)) / 2


def coth(x: Column) -> Column:
    return 1 / F.tanh(x)


def square(x: Column) -> Column:
    """Keeps an integer an integer."""
    return x * x


def power(x: Column, y: Column) -> Column:
    return F.pow(x, y)


def to_string(x: Column) -> Column:
    return x.cast("string")


def to_float(x: Column) -> Column:
    """Plain decimal notation only; anything else gives NULL."""
    text = x.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def to_integer(x: Column) -> Column:
    """Integers exactly, decimals truncated, anything else NULL."""
    text = F.trim(x.cast("string"))
    return F.coalesce(text.try_cast("bigint"), to_float(x).try_cast("bigint"))


def to_boolean(x: Column) -> Column:
    text = F.lower(F.trim(x.cast("string")))
    return F.when(text == "true", True).when(text == "false", False)


def value_type(x: Column) -> Column:
    """INTEGER, FLOAT, STRING, BOOLEAN, BLOB, NULL or ANY."""
    kind = F.typeof(x)
    result = F.when(x.isNull(), F.lit("NULL"))
    for spark_name, name in TYPE_NAMES.items():
        result = result.when(kind == spark_name, F.lit(name))
    return result.otherwise("ANY")


def null_if(a: Column, b: Column) -> Column:
    return F.nullif(a, b)


# -- lists (F20) ------------------------------------------------------------------------------
def head(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def tail(items: Column) -> Column:
    return F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0)))


def int_range(start: Column, end: Column, step: int = 1) -> Column:
    """start, start + step, … not past end; empty when the step leads away from it."""
    if step == 0:
        raise ValueError("step must not be 0")
    reachable = (start <= end) if step > 0 else (start >= end)
    return F.when(reachable, F.sequence(start, end, F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))
