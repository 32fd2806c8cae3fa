"""The property graph: one node frame and one edge frame.

``nodes(id, labels, <properties>)`` and ``edges(id, src, dst, type, <properties>)``.
Both may be unions of many source tables whose label or type is a literal:
Catalyst folds the label filter of a pattern into each branch and drops the
branches that cannot match, so a scan for one label reads one source table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import dense_number

NODE_KEYS = ("id", "labels")
EDGE_KEYS = ("id", "src", "dst", "type")


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame
    name: str = "graph"

    # -- construction -------------------------------------------------------------------------
    @staticmethod
    def of(node_tables: list[DataFrame], edge_tables: list[DataFrame], name: str = "graph") -> "Graph":
        """Union the tables by name; properties a table lacks are NULL (A1)."""

        def union(frames):
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

        return Graph(union(node_tables), union(edge_tables), name)

    @property
    def node_props(self) -> list[str]:
        return [c for c in self.nodes.columns if c not in NODE_KEYS]

    @property
    def edge_props(self) -> list[str]:
        return [c for c in self.edges.columns if c not in EDGE_KEYS]

    def match(self, unique_edges: bool = True):
        from .operators.match import Match

        return Match(self, unique_edges)

    # -- cache control (A5) -------------------------------------------------------------------
    def cache(self) -> "Graph":
        return Graph(self.nodes.persist(), self.edges.persist(), self.name)

    def unpersist(self) -> "Graph":
        self.nodes.unpersist()
        self.edges.unpersist()
        return self

    def refresh(self) -> "Graph":
        """Drop the cached copy and cache again, reading the sources anew."""
        return self.unpersist().cache()

    def stats(self) -> DataFrame:
        """One row: graph name, node count, edge count and whether it is cached."""
        nodes = self.nodes.select(F.lit(1).alias("n"), F.lit(0).alias("e"))
        edges = self.edges.select(F.lit(0).alias("n"), F.lit(1).alias("e"))
        cached = self.nodes.is_cached and self.edges.is_cached
        return nodes.unionAll(edges).agg(
            F.lit(self.name).alias("graph"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("node_count"),
            F.coalesce(F.sum("e"), F.lit(0)).cast("long").alias("edge_count"),
            F.lit(cached).alias("cached"),
        )

    # -- materialisation (A9) -----------------------------------------------------------------
    def vertices(self) -> DataFrame:
        """``id`` and the full node as a struct."""
        props = F.struct(*self.node_props) if self.node_props else F.struct(F.lit(None).alias("none"))
        return self.nodes.select("id", F.struct("id", "labels", props.alias("properties")).alias("vertex"))

    def relationships(self) -> DataFrame:
        """``id`` and the full edge as a struct."""
        props = F.struct(*self.edge_props) if self.edge_props else F.struct(F.lit(None).alias("none"))
        return self.edges.select("id", F.struct("id", "src", "dst", "type", props.alias("properties")).alias("edge"))

    def materialise_paths(self, paths: DataFrame, key: str, node_ids: str = "node_ids") -> DataFrame:
        """Replace the id array of each path by its node structs in path order."""
        steps = paths.select(key, F.posexplode(node_ids).alias("_at", "id"))
        full = steps.join(self.vertices(), "id").groupBy(key).agg(F.collect_list(F.struct("_at", "vertex")).alias("_v"))
        return full.select(key, F.transform(F.array_sort("_v"), lambda s: s["vertex"]).alias("path"))


def node_table(df: DataFrame, key: Column, labels: str | list[str], **props: Column) -> DataFrame:
    """Node rows from a table: id expression, literal label(s), typed properties."""
    labels = [labels] if isinstance(labels, str) else labels
    return df.select(
        key.cast("long").alias("id"),
        F.array(*[F.lit(x) for x in labels]).alias("labels"),
        *[c.alias(n) for n, c in props.items()],
    )


def edge_table(df: DataFrame, key: Column, src: Column, dst: Column, type: str, **props: Column) -> DataFrame:
    """Edge rows from a table holding both ends, e.g. a foreign key."""
    return df.select(
        key.cast("long").alias("id"),
        src.cast("long").alias("src"),
        dst.cast("long").alias("dst"),
        F.lit(type).alias("type"),
        *[c.alias(n) for n, c in props.items()],
    )


def symmetric(edges: DataFrame) -> DataFrame:
    """Every edge in both directions; a self-loop stays one row."""
    back = edges.where("src <> dst").select(
        *[{"src": F.col("dst"), "dst": F.col("src")}.get(c, F.col(c)).alias(c) for c in edges.columns]
    )
    return edges.unionByName(back)


def number_edges(df: DataFrame, order: list[str]) -> DataFrame:
    """Edge ids 1..n in a total order, for sources without a key."""
    return dense_number(df, order, "id")
