"""Graph patterns, graph algorithms, vector search and table sync as Spark DataFrame operators."""

from .graph import Graph, edge_table, node_table

__all__ = ["Graph", "edge_table", "node_table"]
