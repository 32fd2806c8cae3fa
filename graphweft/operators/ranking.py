"""Rank-like scores computed by repeated sums over edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..graph import Graph
from ..session import cut
from ..skew import Fanout

CUT_EVERY = 5  # rounds between two materialisations when no convergence test needs one


def _at_least_one(name: str, n: int) -> int:
    if n < 1:
        raise ValueError(f"{name} must be at least 1")
    return n


def pagerank(
    graph: Graph,
    damping: float = 0.85,
    iterations: int = 20,
    tolerance: float | None = 1e-6,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """``id, score``. Mass of nodes without out-edges is dropped.

    Every round joins the scores to the out-edges and sums per target, one shuffle
    each. ``tolerance`` stops early (largest change below it); None runs all rounds.
    With ``seeds(id)`` the walk restarts there only (personalised form).
    """
    _at_least_one("iterations", iterations)
    fan = Fanout(graph.edges.select("src", "dst"), resident=True)
    nodes = graph.nodes.select("id")
    if seeds is None:
        weight = F.lit(1.0 / max(nodes.count(), 1))
        start = nodes.withColumn("start", weight)
    else:
        chosen = seeds.select("id").distinct().join(nodes, "id", "left_semi")
        share = 1.0 / max(chosen.count(), 1)
        start = nodes.join(chosen.withColumn("start", F.lit(share)), "id", "left").fillna(0.0, ["start"])
    base = cut(start.join(fan.out_degree, "id", "left").withColumn("restart", F.col("start") * (1.0 - damping)))
    state = base.withColumn("score", F.col("start"))
    empty = base.select("id", "out_degree", "restart", F.lit(0.0).alias("c"))
    for i in range(1, iterations + 1):
        send = state.where("out_degree is not null").select("id", (F.col("score") / F.col("out_degree")).alias("c"))
        got = fan.send(send).select(F.col("dst").alias("id"), "c")
        summed = empty.unionByName(got, allowMissingColumns=True).groupBy("id").agg(
            F.max("out_degree").alias("out_degree"), F.max("restart").alias("restart"), F.sum("c").alias("c")
        )
        new = summed.select("id", "out_degree", "restart", (F.col("restart") + damping * F.col("c")).alias("score"))
        if tolerance is not None:
            new = cut(new)
            change = new.join(state.select("id", F.col("score").alias("_old")), "id").agg(F.max(F.abs(F.col("score") - F.col("_old")))).first()[0]
            state = new
            if change is None or change < tolerance:
                break
        else:
            state = cut(new) if i % CUT_EVERY == 0 else new
    return state.select("id", "score")


def top_pagerank(graph: Graph, k: int = 10, damping: float = 0.85, iterations: int = 20, tolerance: float | None = 1e-6) -> DataFrame:
    """The k best, best first, ties by id."""
    return pagerank(graph, damping, iterations, tolerance).orderBy(F.desc("score"), "id").limit(_at_least_one("k", k))


def eigenvector(graph: Graph, iterations: int = 100, tolerance: float | None = 1e-10) -> DataFrame:
    """``id, score``: power iteration over in-edges with unit length after each round."""
    _at_least_one("iterations", iterations)
    fan = Fanout(graph.edges.select("src", "dst"), resident=True)
    nodes = cut(graph.nodes.select("id"))
    uniform = 1.0 / max(nodes.count(), 1) ** 0.5
    state = nodes.withColumn("score", F.lit(uniform))
    zero = nodes.select("id", F.lit(0.0).alias("c"))
    for _ in range(iterations):
        got = fan.send(state).select(F.col("dst").alias("id"), F.col("score").alias("c"))
        raw = cut(zero.unionByName(got).groupBy("id").agg(F.sum("c").alias("c")))
        norm = raw.agg(F.sqrt(F.sum(F.col("c") * F.col("c")))).first()[0] or 0.0
        new = raw.select("id", (F.lit(uniform) if norm < 1e-15 else F.col("c") / norm).alias("score"))
        if tolerance is not None:
            change = new.join(state.withColumnRenamed("score", "_old"), "id").agg(F.max(F.abs(F.col("score") - F.col("_old")))).first()[0]
            state = new
            if change is None or change < tolerance:
                break
        else:
            state = new
    return state
