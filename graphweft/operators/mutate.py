"""Batch graph updates; every function returns a new Graph (D)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..graph import Graph
from ..ordered import dense_number
from ..session import cut
from .sequence import StoredMarks


def _next_id(df: DataFrame) -> int:
    return (df.agg(F.max("id")).first()[0] or 0) + 1


def _label_array(labels: str | list[str]) -> Column:
    return F.array(*[F.lit(x) for x in ([labels] if isinstance(labels, str) else labels)])


def _has_labels(labels: str | list[str]) -> Column:
    condition = F.lit(True)
    for label in [labels] if isinstance(labels, str) else labels:
        condition = condition & F.array_contains("labels", label)
    return condition


def _append(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


# -- CREATE -----------------------------------------------------------------------------------
def _numbered(present: DataFrame, rows: DataFrame, order: list[str], marks: StoredMarks | None, name: str) -> DataFrame:
    """``rows`` with ``_id``: after the largest present one, or from the stored sequence ``name``, which scans nothing."""
    return dense_number(rows, order, "_id", start=_next_id(present)) if marks is None else marks.nextval(rows, name, order, "_id")


def create_nodes(graph: Graph, rows: DataFrame, labels: str | list[str], order: list[str], marks: StoredMarks | None = None, **props: Column) -> Graph:
    """One node per row, ids in ``order`` after the present maximum or, with ``marks``, from the sequence ``nodes``."""
    numbered = _numbered(graph.nodes, rows, order, marks, "nodes")
    new = numbered.select(F.col("_id").alias("id"), _label_array(labels).alias("labels"), *[c.alias(n) for n, c in props.items()])
    return Graph(_append(graph.nodes, new), graph.edges, graph.name)


def create_paths(
    graph: Graph,
    rows: DataFrame,
    nodes: dict[str, tuple[str | list[str], dict[str, Column]]],
    edges: list[tuple[str, str, str, dict[str, Column]]],
    order: list[str],
) -> Graph:
    """One whole pattern per row.

    ``nodes`` maps a variable to (labels, properties), ``edges`` lists (from, type, to,
    properties); a variable named by several edges is one node.
    """
    numbered = cut(dense_number(rows, order, "_n", start=0))
    first_node, first_edge = _next_id(graph.nodes), _next_id(graph.edges)
    ids = {var: F.col("_n") * len(nodes) + first_node + i for i, var in enumerate(nodes)}
    all_nodes, all_edges = graph.nodes, graph.edges
    for var, (labels, props) in nodes.items():
        new = numbered.select(ids[var].alias("id"), _label_array(labels).alias("labels"), *[c.alias(n) for n, c in props.items()])
        all_nodes = _append(all_nodes, new)
    for i, (a, kind, b, props) in enumerate(edges):
        new = numbered.select(
            (F.col("_n") * len(edges) + first_edge + i).alias("id"), ids[a].alias("src"), ids[b].alias("dst"), F.lit(kind).alias("type"),
            *[c.alias(n) for n, c in props.items()],
        )
        all_edges = _append(all_edges, new)
    return Graph(all_nodes, all_edges, graph.name)


def create_edges(graph: Graph, matched: DataFrame, src: str, dst: str, type: str, order: list[str], marks: StoredMarks | None = None, **props: Column) -> Graph:
    """One edge per matched row; no rows, no change (D2). Ids as in ``create_nodes``, from the sequence ``edges``."""
    numbered = _numbered(graph.edges, matched, order, marks, "edges")
    new = numbered.select(
        F.col("_id").alias("id"), F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst"), F.lit(type).alias("type"),
        *[c.alias(n) for n, c in props.items()],
    )
    return Graph(graph.nodes, _append(graph.edges, new), graph.name)


# -- MERGE ------------------------------------------------------------------------------------
def _one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with equal keys are one entity; the smallest row supplies the values."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    return rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")


def _merged(df: DataFrame, wanted: DataFrame, eligible: Column, keys: list[str], on_match: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Entities after ON MATCH, and the wanted rows that no ``eligible`` entity has the ``keys`` of.

    One outer join, written once: what is there already and what is missing are both read from it, so the
    entities are computed a single time whatever is merged. Entities that cannot match, most of them without the keys, are
    spread by their id; by the missing keys alone they would all meet in one task.
    """
    for k in keys:
        eligible = eligible & F.col(k).isNotNull()
    apart = F.when(F.coalesce(eligible, F.lit(False)), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("id"), F.lit(1 << 30)))
    # zero, but no literal: those the optimizer takes out of the join's keys
    here = F.xxhash64(*keys).bitwiseAND(F.lit(0))
    left = df.withColumn("_apart", apart.cast("long"))
    right = wanted.select(
        F.struct("*").alias("_w"), here.cast("long").alias("_here"), F.struct(F.lit(True).alias("_hit"), *[v.alias(n) for n, v in on_match.items()]).alias("_m")
    )
    on = F.col("_apart") == F.col("_here")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_w.{k}"))
    joined = cut(left.join(right, on, "full"))

    def pick(name: str) -> Column:
        old = F.col(name) if name in df.columns else F.lit(None)
        return F.when(F.col("_m").isNotNull(), F.col(f"_m.{name}")).otherwise(old).alias(name) if name in on_match else F.col(name)

    present = joined.where("id is not null").select(*[pick(n) for n in dict.fromkeys([*df.columns, *on_match])])
    return present, joined.where("id is null").select("_w.*")


def merge_nodes(
    graph: Graph,
    rows: DataFrame,
    labels: str | list[str],
    keys: list[str],
    on_create: dict[str, Column] | None = None,
    on_match: dict[str, Column] | None = None,
    marks: StoredMarks | None = None,
) -> Graph:
    """Find nodes by labels and key properties, else create them.

    ``rows`` carries the key columns; the expressions may use its other columns.
    """
    present, missing = _merged(graph.nodes, _one_per_key(rows, keys), _has_labels(labels), keys, on_match or {})
    props = {k: F.col(k) for k in keys} | (on_create or {})
    return create_nodes(Graph(present, graph.edges, graph.name), missing, labels, keys, marks, **props)


def merge_edges(
    graph: Graph, rows: DataFrame, type: str, on_create: dict[str, Column] | None = None, on_match: dict[str, Column] | None = None, marks: StoredMarks | None = None
) -> Graph:
    """The same for edges on (src, dst, type) (D4). ``rows(src, dst, …)``."""
    present, missing = _merged(graph.edges, _one_per_key(rows, ["src", "dst"]), F.col("type") == type, ["src", "dst"], on_match or {})
    return create_edges(Graph(graph.nodes, present, graph.name), missing, "src", "dst", type, ["src", "dst"], marks, **(on_create or {}))


def merge_then(graph: Graph, merge: Callable[[Graph], Graph], read: Callable[[Graph], DataFrame]) -> tuple[Graph, DataFrame]:
    """MERGE … WITH …: go on matching on the changed graph."""
    changed = merge(graph)
    return changed, read(changed)


# -- SET and REMOVE ---------------------------------------------------------------------------
def _set(df: DataFrame, matched: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``matched(id, …)`` supplies the new values; one row per entity."""
    new = _one_per_key(matched.select("id", *[v.alias(f"_v_{n}") for n, v in values.items()]), ["id"]).withColumn("_hit", F.lit(True))
    joined = df.join(new, "id", "left")
    columns = [*df.columns, *[n for n in values if n not in df.columns]]

    def pick(c: str) -> Column:
        if c not in values:
            return F.col(c)
        old = F.col(c) if c in df.columns else F.lit(None)
        return F.when(F.col("_hit"), F.col(f"_v_{c}")).otherwise(old).alias(c)

    return joined.select(*[pick(c) for c in columns])


def set_props(graph: Graph, matched: DataFrame, **values: Column) -> Graph:
    """SET n.k = expr for the matched ids; NULL removes the property."""
    return Graph(_set(graph.nodes, matched, values), graph.edges, graph.name)


def set_edge_props(graph: Graph, matched: DataFrame, **values: Column) -> Graph:
    return Graph(graph.nodes, _set(graph.edges, matched, values), graph.name)


def set_map(graph: Graph, matched: DataFrame, values: dict[str, Column], replace: bool) -> Graph:
    """SET n = {…} (``replace``: all other properties go) or SET n += {…}."""
    full = dict(values)
    if replace:
        types = dict(graph.nodes.dtypes)
        full = {p: F.lit(None).cast(types[p]) for p in graph.node_props} | full
    return set_props(graph, matched, **full)


def set_edge_map(graph: Graph, matched: DataFrame, values: dict[str, Column], replace: bool) -> Graph:
    """SET r = {…} or SET r += {…} on the matched edges."""
    full = dict(values)
    if replace:
        types = dict(graph.edges.dtypes)
        full = {p: F.lit(None).cast(types[p]) for p in graph.edge_props} | full
    return set_edge_props(graph, matched, **full)


def _mark(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("id").distinct().withColumn("_hit", F.lit(True)), "id", "left")


def add_label(graph: Graph, ids: DataFrame, label: str) -> Graph:
    """SET n:Label."""
    labels = F.when(F.col("_hit"), F.array_union("labels", F.array(F.lit(label)))).otherwise(F.col("labels"))
    return Graph(_mark(graph.nodes, ids).withColumn("labels", labels).select(*graph.nodes.columns), graph.edges, graph.name)


def remove_label(graph: Graph, ids: DataFrame, label: str) -> Graph:
    """REMOVE n:Label."""
    labels = F.when(F.col("_hit"), F.array_remove("labels", label)).otherwise(F.col("labels"))
    return Graph(_mark(graph.nodes, ids).withColumn("labels", labels).select(*graph.nodes.columns), graph.edges, graph.name)


def remove_props(graph: Graph, ids: DataFrame, *names: str) -> Graph:
    """REMOVE n.k."""
    gone = {n: F.when(F.col("_hit"), F.lit(None)).otherwise(F.col(n)) for n in names}
    return Graph(_mark(graph.nodes, ids).withColumns(gone).select(*graph.nodes.columns), graph.edges, graph.name)


def remove_edge_props(graph: Graph, ids: DataFrame, *names: str) -> Graph:
    """REMOVE r.k."""
    gone = {n: F.when(F.col("_hit"), F.lit(None)).otherwise(F.col(n)) for n in names}
    return Graph(graph.nodes, _mark(graph.edges, ids).withColumns(gone).select(*graph.edges.columns), graph.name)


# -- DELETE -----------------------------------------------------------------------------------
def delete_nodes(graph: Graph, ids: DataFrame, detach: bool = False) -> Graph:
    """DELETE refuses nodes that still have edges; DETACH DELETE drops those edges too."""
    gone = ids.select("id").distinct()
    src, dst = gone.withColumnRenamed("id", "src"), gone.withColumnRenamed("id", "dst")
    if not detach:
        held = graph.edges.join(src, "src", "left_semi").select("id").unionAll(graph.edges.join(dst, "dst", "left_semi").select("id"))
        if not held.isEmpty():
            raise ValueError("cannot delete nodes that still have edges; use detach")
    edges = graph.edges.join(src, "src", "left_anti").join(dst, "dst", "left_anti").select(*graph.edges.columns) if detach else graph.edges
    return Graph(graph.nodes.join(gone, "id", "left_anti"), edges, graph.name)


def delete_edges(graph: Graph, ids: DataFrame) -> Graph:
    return Graph(graph.nodes, graph.edges.join(ids.select("id").distinct(), "id", "left_anti"), graph.name)


# -- statistics -------------------------------------------------------------------------------
def mutation_stats(before: Graph, after: Graph) -> DataFrame:
    """One row of counts: created and deleted nodes and edges, properties of both changed."""

    def compared(a: DataFrame, b: DataFrame, old: list[str], new: list[str]) -> tuple[DataFrame, Column]:
        shared, fresh = [p for p in new if p in old], [p for p in new if p not in old]
        gone = [p for p in old if p not in new]

        def side(df: DataFrame, name: str, cols: list[str]) -> DataFrame:
            return df.select("id", F.struct(F.lit(1).alias("one"), *cols).alias(name))

        both = side(a, "a", [*shared, *gone]).join(side(b, "b", [*shared, *fresh]), "id", "full")
        differing = [(~F.col(f"a.{p}").eqNullSafe(F.col(f"b.{p}"))).cast("int") for p in shared]
        differing += [F.col(f"b.{p}").isNotNull().cast("int") for p in fresh] + [F.col(f"a.{p}").isNotNull().cast("int") for p in gone]
        return both, F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), sum(differing, F.lit(0))).otherwise(0)

    created, deleted = F.col("a").isNull().cast("long"), F.col("b").isNull().cast("long")
    nodes, node_changes = compared(before.nodes, after.nodes, before.node_props, after.node_props)
    edges, edge_changes = compared(before.edges, after.edges, before.edge_props, after.edge_props)
    counts = nodes.select(
        created.alias("nodes_created"), deleted.alias("nodes_deleted"), F.lit(0).alias("edges_created"), F.lit(0).alias("edges_deleted"),
        node_changes.alias("properties_set"),
    ).unionAll(edges.select(F.lit(0), F.lit(0), created, deleted, edge_changes))
    names = ("nodes_created", "nodes_deleted", "edges_created", "edges_deleted", "properties_set")
    return counts.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])
