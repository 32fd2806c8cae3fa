"""Expression forms of the query language that are not plain Column operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def xor(a: Column, b: Column) -> Column:
    """Three-valued XOR."""
    return a != b


def int_divide(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero; NULL on a zero divisor."""
    a, b = a.cast("long"), b.cast("long")
    return F.when(b != 0, F.call_function("div", a, b))


def modulo(a: Column, b: Column) -> Column:
    """Remainder with the sign of the dividend; NULL on a zero divisor."""
    return F.when(b != 0, a % b)


def concat_text(*parts: Column) -> Column:
    """String + : NULL if any part is NULL."""
    return F.concat(*[p.cast("string") for p in parts])


def regex_match(text: Column, pattern: str) -> Column:
    """=~ : unanchored search, ``(?i)`` prefix allowed."""
    return text.rlike(pattern)


def list_item(items: Column, index: int) -> Column:
    """list[i], zero based, negative from the end, NULL when outside."""
    return F.try_element_at(items, F.lit(index + 1 if index >= 0 else index))


def list_slice(items: Column, start: int | None = None, end: int | None = None) -> Column:
    """list[a..b], half-open; negative bounds count from the end."""
    n = F.size(items)

    def bound(i: int | None, default: Column) -> Column:
        if i is None:
            return default
        return F.least(F.lit(i), n) if i >= 0 else F.greatest(n + i, F.lit(0))

    low, high = bound(start, F.lit(0)), bound(end, n)
    return F.slice(items, low + 1, F.greatest(high - low, F.lit(0)))


def comprehension(items: Column, where: Callable | None = None, value: Callable | None = None) -> Column:
    """[x IN items WHERE p | e]."""
    if where is not None:
        items = F.filter(items, where)
    return items if value is None else F.transform(items, value)


def all_of(items: Column, p: Callable) -> Column:
    return F.forall(items, p)


def any_of(items: Column, p: Callable) -> Column:
    return F.exists(items, p)


def none_of(items: Column, p: Callable) -> Column:
    return ~F.exists(items, p)


def single_of(items: Column, p: Callable) -> Column:
    return F.size(F.filter(items, p)) == 1


def reduce_list(items: Column, init: Column, step: Callable) -> Column:
    """reduce(acc = init, x IN items | step)."""
    return F.aggregate(items, init, step)


def map_literal(**items: Column) -> Column:
    """{k: expr, …} as a struct."""
    return F.struct(*[v.alias(k) for k, v in items.items()])


def map_projection(var: str, keys: list[str], **extra: Column) -> Column:
    """n{.k, …, a: expr} over the flat columns of a pattern variable."""
    return F.struct(*[F.col(f"{var}_{k}").alias(k) for k in keys], *[v.alias(k) for k, v in extra.items()])


def nested(json: Column, *path: str) -> Column:
    """n.a.b on a JSON property."""
    return F.get_json_object(json, "$." + ".".join(path))
