"""Communities: label propagation with its lookups, and one-level Louvain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..graph import Graph
from ..session import cut
from ..skew import Fanout


def label_propagation(graph: Graph, iterations: int = 10) -> DataFrame:
    """``id, community``: every node takes the most frequent label around it, all at once.

    In- and out-neighbours count with multiplicity, ties go to the smallest label.
    Labels are node ids. Counting is partial before the shuffle, so a hub's
    neighbourhood is never gathered.
    """
    if iterations < 1:
        raise ValueError("iterations must be at least 1")
    both = graph.edges.select("src", "dst").unionAll(graph.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    fan = Fanout(both, resident=True)
    state = cut(graph.nodes.select("id", F.col("id").alias("community")))
    for _ in range(iterations):
        votes = fan.send(state).groupBy(F.col("dst").alias("id"), "community").agg(F.count("*").alias("n"))
        best = votes.groupBy("id").agg(F.max(F.struct("n", (-F.col("community")).alias("c")))["c"].alias("c")).select("id", (-F.col("c")).alias("new"))
        moved = cut(
            state.join(best, "id", "left").select(
                "id", F.coalesce("new", "community").alias("community"), (F.coalesce("new", "community") != F.col("community")).alias("moved")
            )
        )
        state = moved.select("id", "community")
        if moved.where("moved").isEmpty():
            break
    return state


def community_of(labels: DataFrame, node) -> DataFrame:
    return labels.where(F.col("id") == F.lit(node))


def community_members(labels: DataFrame, community) -> DataFrame:
    return labels.where(F.col("community") == F.lit(community)).select("id")


def community_count(labels: DataFrame) -> DataFrame:
    return labels.agg(F.count_distinct("community").alias("communities"))


def canonical(labels: DataFrame) -> DataFrame:
    """Rename each community to its smallest member."""
    names = labels.groupBy("community").agg(F.min("id").alias("name"))
    return labels.join(names, "community").select("id", F.col("name").alias("community"))


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Modularity of a partition of the undirected view; every edge row has weight 1."""
    both = edges.select("src", "dst").unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return _modularity(Fanout(both), labels, resolution)


def _modularity(fan: Fanout, labels: DataFrame, resolution: float) -> float:
    two_m = fan.edge_count
    if not two_m:
        return 0.0
    other = labels.select(F.col("id").alias("dst"), F.col("community").alias("_oc"))
    inside = fan.send(labels).join(other, "dst").where(F.col("community") == F.col("_oc")).agg((F.count("*") / two_m).alias("q"))
    degree = labels.join(fan.out_degree, "id").groupBy("community").agg(F.sum("out_degree").alias("d"))
    square = degree.agg((-resolution * F.sum(F.pow(F.col("d") / two_m, F.lit(2)))).alias("q"))
    return inside.unionAll(square).agg(F.sum("q")).first()[0]


def louvain(graph: Graph, resolution: float = 1.0, passes: int = 100) -> tuple[DataFrame, float]:
    """``(id, community)`` and its modularity: one level of local moves.

    All nodes of one half (by id hash) move at once to their best neighbouring
    community. If that does not raise modularity, only moves that touch disjoint
    communities are made: their gains add up exactly, so modularity must rise.
    Stops when no single move gains.
    """
    both = graph.edges.select("src", "dst").unionAll(graph.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    fan = Fanout(both, resident=True)
    two_m = fan.edge_count
    state = cut(graph.nodes.select("id", F.col("id").alias("community")))
    if not two_m:
        return state, 0.0
    m = two_m / 2.0
    degree = cut(graph.nodes.select("id").join(fan.out_degree, "id", "left").select("id", F.coalesce("out_degree", F.lit(0)).alias("k")))
    best_q = _modularity(fan, state, resolution)
    for turn in range(passes):
        moves = cut(_moves(fan, state, degree, m, resolution))
        if moves.isEmpty():
            break
        proposal = cut(_apply(state, moves.where(F.pmod(F.xxhash64("id"), F.lit(2)) == turn % 2)))
        q = _modularity(fan, proposal, resolution)
        if q <= best_q + 1e-12:
            safe = cut(_disjoint(moves))
            proposal = cut(_apply(state, safe))
            q = best_q + safe.agg(F.sum("gain")).first()[0]  # the gains of disjoint moves add up
        state, best_q = proposal, q
    return canonical(state), best_q


def _moves(fan: Fanout, state: DataFrame, degree: DataFrame, m: float, resolution: float) -> DataFrame:
    """``id, old, new, gain``: the best gaining move of every node that has one."""
    tagged = state.join(degree, "id")
    totals = tagged.groupBy("community").agg(F.sum("k").alias("total"))
    # links of every node into every neighbouring community, self-loops left out
    links = (
        fan.send(state.withColumnRenamed("community", "target")).where(F.col("id") != F.col("dst"))
        .groupBy(F.col("dst").alias("node"), "target").agg(F.count("*").alias("links"))
    )
    own = tagged.select(F.col("id").alias("node"), F.col("community").alias("old"), "k")
    scored = links.join(own, "node").join(totals.withColumnRenamed("community", "target"), "target")
    home = F.col("target") == F.col("old")
    rest = F.when(home, F.col("total") - F.col("k")).otherwise(F.col("total"))
    value = F.col("links") / m - resolution * rest * F.col("k") / (2.0 * m * m)
    per = scored.withColumn("value", value).groupBy("node", "old", "k").agg(
        F.max(F.when(home, F.col("value"))).alias("stay"),
        F.max(F.when(~home, F.struct(F.col("value"), (-F.col("target")).alias("t")))).alias("go"),
    )
    # a node without links at home still pays for the rest of its community
    alone = per.join(totals.withColumnRenamed("community", "old"), "old").withColumn(
        "stay", F.coalesce("stay", -resolution * (F.col("total") - F.col("k")) * F.col("k") / (2.0 * m * m))
    )
    return alone.where("go is not null").select(
        F.col("node").alias("id"), "old", (-F.col("go.t")).alias("new"), (F.col("go.value") - F.col("stay")).alias("gain")
    ).where("gain > 1e-10")


def _apply(state: DataFrame, moves: DataFrame) -> DataFrame:
    return state.join(moves.select("id", "new"), "id", "left").select("id", F.coalesce("new", "community").alias("community"))


def _disjoint(moves: DataFrame) -> DataFrame:
    """Moves that are the best one of both communities they touch."""
    order = F.struct("gain", (-F.col("id")).alias("i"))
    touched = moves.select(F.col("old").alias("c"), order.alias("o")).unionAll(moves.select(F.col("new").alias("c"), order.alias("o")))
    best = touched.groupBy("c").agg(F.max("o").alias("b"))
    a = best.select(F.col("c").alias("old"), F.col("b").alias("_b1"))
    b = best.select(F.col("c").alias("new"), F.col("b").alias("_b2"))
    mine = F.col("_b1.i") == -F.col("id")
    return moves.join(a, "old").join(b, "new").where(mine & (F.col("_b2.i") == -F.col("id"))).drop("_b1", "_b2")
