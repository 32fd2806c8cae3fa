"""The order in which the hops of a cyclic pattern are joined.

A chain is best left to Catalyst. A cycle is not: written as a path that closes last, it passes through every pair of
ends of its longest arc. Here the two smallest arcs are joined first, as measured, and the last join has both common
variables as its key, so that no step is larger than it must be.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# a selected part reduces another one before the joins if it leaves less than this share of its ids
WORTH_REDUCING = 0.25


@dataclass
class Part:
    """Some joined hops, their estimated rows and, by variable, their estimated different ids."""

    frame: DataFrame
    rows: float
    ids: dict[str, float]
    hops: list
    selected: bool = False

    def limit(self, var: str, ids: float) -> None:
        """The estimate after all but ``ids`` ids of ``var`` are gone."""
        before = self.ids[var]
        if ids < before:
            self.rows *= ids / before
            self.ids = {v: min(n, max(self.rows, 1.0)) for v, n in self.ids.items()} | {var: ids}


def sizes(frames: list[tuple[DataFrame, list[str]]]) -> list[tuple[int, list[int]]]:
    """Rows of every frame and approximate different values of its columns (none, one or two), all in one job."""
    def ends(cols: list[str]) -> list[Column]:
        nothing = F.lit(None).cast("long")
        return [F.col(cols[0]) if cols else nothing, F.col(cols[1]) if len(cols) > 1 else nothing]

    one = [df.select(F.lit(i).alias("part"), *[x.alias(n) for x, n in zip(ends(cols), "ab")]) for i, (df, cols) in enumerate(frames)]
    # a tree of unions: each step analyses its own branches only
    while len(one) > 1:
        one = [a.unionAll(b) for a, b in zip(one[::2], one[1::2])] + one[len(one) - len(one) % 2 :]
    found = one[0].groupBy("part").agg(F.count("*").alias("n"), F.approx_count_distinct("a").alias("da"), F.approx_count_distinct("b").alias("db")).collect()
    by_part = {r.part: (r.n, [r.da, r.db]) for r in found}  # one row a hop or node of the pattern
    return [(n, d[: len(cols)]) for (n, d), (_, cols) in zip((by_part.get(i, (0, [0, 0])) for i in range(len(frames))), frames)]


def estimate(a: Part, b: Part) -> float:
    """Rows of the join on all common variables; none if there are none."""
    shared = a.ids.keys() & b.ids.keys()
    if not shared:
        return float("inf")
    rows = a.rows * b.rows
    for v in shared:
        rows /= max(a.ids[v], b.ids[v], 1.0)
    return rows


def reduce_parts(parts: list[Part]) -> None:
    """Semi-joins that carry a selection to the other parts with the same variable."""
    for source in sorted((p for p in parts if p.selected), key=lambda p: p.rows):
        for target in parts:
            for v in source.ids.keys() & target.ids.keys() if target is not source else ():
                if source.ids[v] < WORTH_REDUCING * target.ids[v]:
                    target.frame = target.frame.join(source.frame.select(f"{v}_id").distinct(), f"{v}_id", "left_semi")
                    target.limit(v, source.ids[v])


def join_all(parts: list[Part], distinct_hops) -> DataFrame:
    """Join the two parts with the smallest result until one is left; ``distinct_hops(df, a, b)`` keeps edges apart."""
    parts = list(parts)
    while len(parts) > 1:
        pairs = [(estimate(a, b), i, j) for i, a in enumerate(parts) for j, b in enumerate(parts) if i < j]
        rows, i, j = min(pairs)
        a, b = parts[i], parts[j]
        shared = sorted(a.ids.keys() & b.ids.keys())
        frame = distinct_hops(a.frame.join(b.frame, [f"{v}_id" for v in shared]), a.hops, b.hops)
        ids = {v: max(1.0, min(rows, a.ids.get(v, rows), b.ids.get(v, rows))) for v in a.ids.keys() | b.ids.keys()}
        parts = [p for k, p in enumerate(parts) if k not in (i, j)] + [Part(frame, rows, ids, a.hops + b.hops)]
    return parts[0].frame
