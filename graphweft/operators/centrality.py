"""Degree, betweenness and closeness centrality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..graph import Graph, symmetric
from ..session import cut
from ..skew import Fanout
from .counted import Counted, Tiled, shares_inside
from .resident import Held, resident
from .traversal import reach_levels

_COUNTED_BYTES = 48_000_000  # of a table with a double for each node and source of a block


def degrees(graph: Graph) -> DataFrame:
    """``id, in_degree, out_degree, degree`` with multiplicity: one aggregation over both edge ends."""
    one, zero = F.lit(1), F.lit(0)
    ends = graph.edges.select(F.col("src").alias("id"), zero.alias("i"), one.alias("o")).unionAll(
        graph.edges.select(F.col("dst").alias("id"), one.alias("i"), zero.alias("o"))
    )
    all_rows = ends.unionAll(graph.nodes.select("id", zero.alias("i"), zero.alias("o")))
    return all_rows.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree")).withColumn(
        "degree", F.col("in_degree") + F.col("out_degree")
    )


def betweenness(graph: Graph, sources: DataFrame | None = None) -> DataFrame:
    """``id, score``: directed, raw; shortest paths are counted with parallel edges.

    Search levels forward, dependencies level by level backward, both for all
    sources together. ``sources(id)`` restricts the sum to paths from there.
    Tasks hold the graph and the numbers of paths from some sources, and return sums; only for larger graphs do the numbers travel.
    """
    edges = cut(graph.edges.where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n")))
    sources = graph.nodes.select("id") if sources is None else sources
    held = resident(edges, sources, "n")
    if held is not None:
        shares = held.searched(shares_inside, "id long, score double", 8, _COUNTED_BYTES, 8)
        return graph.nodes.select("id", F.lit(0.0).alias("score")).unionAll(shares).groupBy("id").agg(F.sum("score").alias("score"))
    tiled = Tiled(edges)
    search = Counted(tiled, sources)
    # what a level owes the nodes before it is added up per node as soon as it is known
    total = graph.nodes.select("id", F.lit(0.0).alias("score"))
    for level in search.shares(tiled):
        total = cut(total.unionAll(level).groupBy("id").agg(F.sum("score").alias("score")))
    return total


def closeness(graph: Graph) -> DataFrame:
    """``id, score``: sum of 1/distance over the undirected view, divided by n − 1.

    A task returns one sum for each node that its searches come to. Only graphs too large for that are searched with rows that travel.
    """
    simple = cut(symmetric(graph.edges.where("src <> dst").select("src", "dst").distinct()).distinct())
    held = resident(simple, graph.nodes.select("id"))
    n = graph.nodes.count()
    # the view is undirected, so summing per reached node equals summing per source
    if held is None:
        search = reach_levels(Fanout(simple), graph.nodes.select("id"))
        reached = search.masks().where("depth > 0").select("id", (F.bit_count("mask") / F.col("depth")).alias("s"))
    else:
        reached = held.searched(_nearness, "id long, s double")
    return graph.nodes.select("id", F.lit(0.0).alias("s")).unionAll(reached).groupBy("id").agg((F.sum("s") / max(n - 1, 1)).alias("score"))


def _nearness(graph: Held, blocks: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """For every node the sum of 1/distance to the sources of a task."""
    total = np.zeros(graph.n)
    for own in blocks:
        for depth, fresh in graph.levels(own):
            total += np.bitwise_count(fresh).sum(axis=1, dtype="int64") / depth
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(graph.ids[met]), pa.array(total[met])], ["id", "s"])
