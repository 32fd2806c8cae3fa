import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from graphweft.graph import Graph  # noqa: E402
from graphweft.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(8, 4, "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Graph from {name: (labels, props)} and [(from, type, to, props)]; ids follow the order given."""

    def build(nodes, edges=(), node_schema="", edge_schema=""):
        ids = {name: i + 1 for i, (name, *_ ) in enumerate(nodes)}
        props = [p.split()[0] for p in node_schema.split(",") if p.strip()]
        eprops = [p.split()[0] for p in edge_schema.split(",") if p.strip()]
        n = [(ids[name], [labels] if isinstance(labels, str) else labels, name, *[values.get(p) for p in props]) for name, labels, values in nodes]
        e = [(i + 1, ids[a], ids[b], kind, *[values.get(p) for p in eprops]) for i, (a, kind, b, values) in enumerate(edges)]
        node_df = spark.createDataFrame(n, "id long, labels array<string>, name string" + (", " + node_schema if node_schema else ""))
        edge_df = spark.createDataFrame(e, "id long, src long, dst long, type string" + (", " + edge_schema if edge_schema else ""))
        return Graph(node_df, edge_df)

    return build


@pytest.fixture(scope="session")
def plain(spark):
    """Graph of numbered nodes and (src, dst[, weight]) edges."""

    def build(nodes, edges):
        rows = [(i + 1, e[0], e[1], "E", float(e[2]) if len(e) > 2 else 1.0) for i, e in enumerate(edges)]
        return Graph(
            spark.createDataFrame([(x, ["N"]) for x in nodes], "id long, labels array<string>"),
            spark.createDataFrame(rows, "id long, src long, dst long, type string, w double"),
        )

    return build


def rows(df, *cols):
    """Sorted tuples of the given columns."""
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())
