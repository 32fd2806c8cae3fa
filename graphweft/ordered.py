"""Global order without a global sort task.

A window without a partition key runs in one task. Here rows are range
partitioned by the order, each range is worked on by itself, and only one small
row per range crosses the borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .session import cut

#: Rows of a range where their number is known, so that no task sorts more the larger the table is.
ROWS_PER_RANGE = 250_000
_POSITION_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def sort_into_ranges(df: DataFrame, order: list[Column | str], ranges: int = 1) -> DataFrame:
    """Rows with ``_range`` (ascending in the order) and ``_pos`` within it.

    The order should be total, otherwise ties are numbered arbitrarily. The
    result is materialised: range borders are sampled and must not move later.
    Without ``ranges`` there are as many as shuffle partitions at most.
    """
    placed = (
        (df.repartitionByRange(ranges, *order) if ranges > 1 else df.repartitionByRange(*order))
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_mid", _POSITION_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_mid")
    )
    return cut(placed)


def running_sum(
    df: DataFrame, groups: list[str], order: list[Column | str], value: Column, out: str, inclusive: bool = True
) -> DataFrame:
    """Running sum of ``value`` in ``order`` within ``groups`` (none = over everything)."""
    placed = sort_into_ranges(df, [*groups, *order]).withColumn("_v", value)
    local = W.partitionBy("_range", *groups).orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    # One row per range and group; a group has at most as many rows here as there are ranges.
    per_range = placed.groupBy("_range", *groups).agg(F.sum("_v").alias("_sum"))
    before = W.partitionBy(*(groups or [F.lit(0)])).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        per_range.withColumn("_before", F.sum("_sum").over(before))
        .where("_before is not null")
        .select(F.col("_range").alias("_r"), *[F.col(g).alias(f"_g_{g}") for g in groups], "_before")
    )
    # Only the first group of a range can have begun in an earlier one: at most one row per range.
    match = F.col("_range") == F.col("_r")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    own = F.lit(0) if inclusive else F.col("_v")
    return (
        placed.withColumn("_local", F.sum("_v").over(local))
        .join(F.broadcast(carried), match, "left")
        .withColumn(out, F.col("_local") + F.coalesce("_before", F.lit(0)) - own)
        .select(*df.columns, out)
    )


def dense_number(df: DataFrame, order: list[Column | str], out: str, start: int = 1) -> DataFrame:
    """Consecutive numbers from ``start`` in ``order``."""
    placed = sort_into_ranges(df, order)
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = W.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), "_range").select(
        *df.columns, (F.col("_before") + F.col("_pos") + start).cast("long").alias(out)
    )


def with_next(df: DataFrame, order: list[Column | str], cols: list[str], out: str = "next") -> DataFrame:
    """Struct ``out`` of ``cols`` of the following row in ``order`` (NULL on the last row).

    The rows are counted first: large tables get as many ranges as keep each at about ``ROWS_PER_RANGE`` rows.
    """
    ranges = -(-df.count() // ROWS_PER_RANGE)
    placed = sort_into_ranges(df, order, ranges)
    if ranges > 1:
        placed = placed.repartition(ranges, "_range")  # as many tasks as ranges: adaptive execution would put them together
    picked = F.struct(*cols)
    inside = F.lead(picked).over(W.partitionBy("_range").orderBy("_pos"))
    heads = placed.where("_pos = 0").select("_range", picked.alias("_head"))  # one row per range
    border = heads.withColumn("_range", F.lag("_range").over(W.partitionBy(F.lit(0)).orderBy("_range")))
    return (
        placed.withColumn("_inside", inside)
        .join(F.broadcast(border.where("_range is not null")), "_range", "left")
        .withColumn(out, F.coalesce("_inside", "_head"))
        .select(*df.columns, out)
    )
