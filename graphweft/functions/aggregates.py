"""Aggregates beyond Spark's own."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import NumericType

from ..ordered import running_sum
from ..session import cut
from ..skew import MAX_HOT_KEYS, ROWS_PER_SALT

BINS = 1024  # of a histogram of a large group; two rounds divide a range by a million


def collect(x: Column) -> Column:
    """collect(x) without NULLs; sorted, so that reruns agree."""
    return F.array_sort(F.collect_list(x))


def stdev(x: Column) -> Column:
    """Sample deviation, 0.0 for one value or none."""
    return F.coalesce(F.when(F.count(x) > 1, F.stddev_samp(x)), F.lit(0.0))


def stdevp(x: Column) -> Column:
    return F.coalesce(F.stddev_pop(x), F.lit(0.0))


def variance(x: Column) -> Column:
    return F.coalesce(F.when(F.count(x) > 1, F.var_samp(x)), F.lit(0.0))


def mode(df: DataFrame, groups: list[str], x: str, out: str = "mode") -> DataFrame:
    """The most frequent value per group, NULL when several share the first place."""
    counts = df.where(F.col(x).isNotNull()).groupBy(*groups, x).agg(F.count("*").alias("_n"))
    largest = F.max(F.struct("_n", x))[x]
    smallest = F.min(F.struct((-F.col("_n")).alias("_m"), F.col(x)))[x]  # the other end of the same tie
    return counts.groupBy(*groups).agg(largest.alias("_a"), smallest.alias("_b")).select(
        *groups, F.when(F.col("_a") == F.col("_b"), F.col("_a")).alias(out)
    )


def quantiles(df: DataFrame, groups: list[str], x: str, _chunk: int | None = None, **wanted: tuple[str, float]) -> DataFrame:
    """Exact quantiles per group without gathering a large group in one task.

    ``wanted`` maps an output name to ``(kind, q)``; kinds are ``disc``
    (percentileDisc), ``cont`` (percentileCont, median) and ``step`` (mean of the
    values on both sides of n·q, the quartiles of the function library). Equal
    values are counted before the shuffle.

    Groups of up to a million rows are ranked by a window. Of a larger one no row is moved: a histogram finds the bin that
    holds a wanted rank, another one divides that bin, until few enough rows are left to rank. Other types than
    numbers have no bins; large groups of theirs are ranked by distributed running sums.
    """
    ranks, formulas = _ranks(wanted)
    keys = [f"_g{i}" for i in range(max(1, len(groups)))]
    named = [F.col(g).alias(k) for g, k in zip(groups, keys)] or [F.lit(0).alias(keys[0])]
    rows = df.where(F.col(x).isNotNull()).select(*named, F.col(x).alias("_x"))
    totals = cut(rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))
    total, largest = totals.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    # at most MAX_HOT_KEYS groups can be larger than this, so their table can be broadcast
    chunk = max(_chunk or ROWS_PER_SALT, -(-total // MAX_HOT_KEYS))
    picks = lambda upto, rank: [F.min(F.when(F.col(upto) >= rank(r), F.col("_x"))).alias(f"_v{i}") for i, r in enumerate(ranks)]
    big = totals.where(F.col("_n") > chunk)
    small = rows if largest <= chunk else _by_key(rows, big.select(*keys), keys, "left_anti")
    upto = F.sum("_c").over(W.partitionBy(*keys).orderBy("_x").rowsBetween(W.unboundedPreceding, 0))
    ranked = small.groupBy(*keys, "_x").agg(F.count("*").alias("_c")).withColumn("_upto", upto).withColumn("_n", F.sum("_c").over(W.partitionBy(*keys)))
    found = ranked.groupBy(*keys).agg(F.max("_n").alias("_n"), *picks("_upto", lambda r: r(F.col("_n"))))
    if largest > chunk:
        if isinstance(rows.schema["_x"].dataType, NumericType):
            found = found.unionByName(_narrowed(rows, big, keys, ranks, chunk))
        else:
            counts = _by_key(rows, big.select(*keys), keys, "left_semi").groupBy(*keys, "_x").agg(F.count("*").alias("_c"))
            summed = _by_key(running_sum(counts, keys, ["_x"], F.col("_c"), "_upto"), big.select(*keys, "_n"), keys)
            found = found.unionByName(summed.groupBy(*keys).agg(F.max("_n").alias("_n"), *picks("_upto", lambda r: r(F.col("_n")))))
    if not groups:
        found = found.agg(*[F.max(c).alias(c) for c in found.columns])  # one row, also over nothing
    return found.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], *[f(F.col("_n")).alias(name) for name, f in formulas.items()])


def _ranks(wanted: dict[str, tuple[str, float]]) -> tuple[list, dict]:
    """The ranks to find, as functions of the number of rows, and the result of each name from their values ``_v0, _v1, ...``."""
    ranks, formulas = [], {}

    def at(rank) -> Column:
        ranks.append(rank)
        return F.col(f"_v{len(ranks) - 1}")

    for name, (kind, q) in wanted.items():
        if kind == "disc":
            value = at(lambda n, q=q: F.greatest(F.ceil(n * q), F.lit(1)))
            formulas[name] = lambda n, value=value: value
        elif kind == "cont":
            low, high = at(lambda n, q=q: F.floor((n - 1) * q) + 1), at(lambda n, q=q: F.ceil((n - 1) * q) + 1)
            formulas[name] = lambda n, q=q, low=low, high=high: low + (high - low) * ((n - 1) * q - F.floor((n - 1) * q))
        elif kind == "step":
            low, high = at(lambda n, q=q: F.greatest(F.ceil(n * q), F.lit(1))), at(lambda n, q=q: F.least(F.floor(n * q) + 1, n))
            formulas[name] = lambda n, low=low, high=high: (low + high) / 2
        else:
            raise ValueError(f"unknown quantile kind {kind}")
    return ranks, formulas


def _by_key(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", condition: Column | None = None) -> DataFrame:
    """Join to a broadcast ``table`` of large groups, with null as a group like any other."""
    other = table.withColumnsRenamed({k: f"_t{k}" for k in keys})
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_t{k}")) for k in keys] + ([] if condition is None else [condition]))
    return rows.join(F.broadcast(other), on, how).drop(*[f"_t{k}" for k in keys])


def _bin() -> Column:
    """Bin of ``_x`` between ``_lo`` and ``_hi``; it never falls as ``_x`` grows and tells the two ends apart.

    Halves keep the width finite. Where an end is not finite, all between the ends is one bin.
    """
    half = lambda name: F.col(name).cast("double") / 2
    share = (half("_x") - half("_lo")) / (half("_hi") - half("_lo"))
    inside = F.when(F.isnan(share), BINS // 2).otherwise(F.least(F.floor(share * BINS), F.lit(BINS - 2)))
    return F.when(F.col("_x") == F.col("_hi"), BINS - 1).when(F.col("_x") == F.col("_lo"), 0).otherwise(inside).cast("int")


def _narrowed(rows: DataFrame, big: DataFrame, keys: list[str], ranks: list, chunk: int) -> DataFrame:
    """``keys, _n, _v0, _v1, ...`` of large groups, by brackets of values that hold a wanted rank."""
    wishes = F.explode(F.array(*[F.struct(F.lit(i).alias("w"), r(F.col("_n")).cast("long").alias("rank")) for i, r in enumerate(ranks)]))
    brackets = big.withColumn("_wish", wishes).select(*keys, F.col("_wish.w").alias("_w"), F.col("_wish.rank").alias("_rank"), F.col("_n").alias("_in"), "_lo", "_hi")
    inside = F.col("_x").between(F.col("_lo"), F.col("_hi"))
    while True:
        brackets = cut(brackets)
        wide = (F.col("_in") > chunk) & (F.col("_lo") < F.col("_hi"))
        if brackets.where(wide).isEmpty():
            break
        met = _by_key(rows, brackets.where(wide), keys, condition=inside).withColumn("_bin", _bin())
        bins = met.groupBy(*keys, "_w", "_rank", "_bin").agg(F.count("*").alias("_in"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        upto = F.sum("_in").over(W.partitionBy(*keys, "_w").orderBy("_bin").rowsBetween(W.unboundedPreceding, 0))  # at most BINS rows
        chosen = bins.withColumn("_upto", upto).where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_in") < F.col("_rank")))
        chosen = chosen.withColumn("_rank", F.col("_rank") - F.col("_upto") + F.col("_in"))
        brackets = brackets.where(~wide).unionByName(chosen.select(*brackets.columns))
    counts = _by_key(rows, brackets.where("_lo < _hi"), keys, condition=inside).groupBy(*keys, "_w", "_rank", "_x").agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(W.partitionBy(*keys, "_w").orderBy("_x").rowsBetween(W.unboundedPreceding, 0))
    last = counts.withColumn("_upto", upto).where("_upto >= _rank").groupBy(*keys, "_w").agg(F.min("_x").alias("_v"))
    values = last.unionByName(brackets.where("not (_lo < _hi)").select(*keys, "_w", F.col("_lo").alias("_v")))
    wide_form = values.groupBy(*keys).agg(*[F.max(F.when(F.col("_w") == i, F.col("_v"))).alias(f"_v{i}") for i in range(len(ranks))])
    return _by_key(wide_form, big.select(*keys, "_n"), keys)
