"""Pattern matching by composing joins.

    people = (graph.match()
              .node("a", "Person").out("WORKS_FOR", var="r").node("c", "Company")
              .path().node("b", "Person").out("WORKS_FOR").node("c")
              .where(F.col("a_name") != F.col("b_name"))
              .df())

Variables become flat column groups ``a_id, a_labels, a_<property>``, so Catalyst
prunes whatever a query does not use. Unnamed, unconstrained nodes are not
joined at all: the edge already carries their id.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..graph import EDGE_KEYS, Graph, symmetric
from .joinorder import Part, join_all, reduce_parts, sizes
from .paths import expand, reachable


@dataclass
class _Node:
    var: str
    named: bool
    labels: list[str] = field(default_factory=list)
    props: dict = field(default_factory=dict)

    @property
    def constrained(self) -> bool:
        return bool(self.labels or self.props)


@dataclass
class _Hop:
    var: str
    named: bool
    types: list[str]
    props: dict
    direction: str
    length: tuple[int, int | None] | None
    path: str | None


def property_filter(props: dict) -> Column | None:
    """AND of equalities; None asks for the property to be absent (B2)."""
    condition = None
    for key, value in props.items():
        c = F.col(key).isNull() if value is None else F.col(key) == F.lit(value)
        condition = c if condition is None else condition & c
    return condition


def scan_nodes(graph: Graph, labels: list[str] | None = None, props: dict | None = None) -> DataFrame:
    """Nodes carrying all labels (case-sensitive) and the given properties (B1, B2)."""
    df = graph.nodes
    for label in labels or []:
        df = df.where(F.array_contains("labels", label))
    condition = property_filter(props or {})
    return df if condition is None else df.where(condition)


def scan_edges(
    graph: Graph, types: list[str] | None = None, props: dict | None = None, direction: str = "out"
) -> DataFrame:
    """Edges of any of the types, oriented so that ``src`` is the left end."""
    df = graph.edges
    if types:
        df = df.where(F.col("type").isin(*types))
    condition = property_filter(props or {})
    if condition is not None:
        df = df.where(condition)
    if direction == "in":
        swap = {"src": F.col("dst"), "dst": F.col("src")}
        df = df.select(*[swap.get(c, F.col(c)).alias(c) for c in df.columns])
    elif direction == "both":
        df = symmetric(df)
    return df


class Match:
    """One MATCH clause: one or more paths over one graph."""

    def __init__(self, graph: Graph, unique_edges: bool = True):
        self.graph = graph
        self.unique_edges = unique_edges
        self._paths: list[list] = [[]]
        self._on: dict[int, Column | None] = {}
        self._where: list[Column] = []
        self._optional: list[tuple["Match", Column | None]] = []
        self._count = 0
        self._once = False  # only whether there is a match counts, not how many

    # -- builder ------------------------------------------------------------------------------
    def _name(self, var: str | None, kind: str) -> tuple[str, bool]:
        if var:
            return var, True
        self._count += 1
        return f"_{kind}{self._count}", False

    def node(self, var: str | None = None, labels: str | list[str] | None = None, **props) -> "Match":
        labels = [labels] if isinstance(labels, str) else list(labels or [])
        name, named = self._name(var, "n")
        self._paths[-1].append(_Node(name, named, labels, props))
        return self

    def _hop(self, direction, types, var, length, path, props) -> "Match":
        types = [types] if isinstance(types, str) else list(types or [])
        name, named = self._name(var, "e")
        if isinstance(length, int):
            length = (length, length)
        self._paths[-1].append(_Hop(name, named, types, props, direction, length, path))
        return self

    def out(self, types=None, var=None, length=None, path=None, **props) -> "Match":
        """``-[var:types {props}]->``; ``length`` is n or (a, b), b None for no bound."""
        return self._hop("out", types, var, length, path, props)

    def into(self, types=None, var=None, length=None, path=None, **props) -> "Match":
        """``<-[…]-``"""
        return self._hop("in", types, var, length, path, props)

    def either(self, types=None, var=None, length=None, path=None, **props) -> "Match":
        """``-[…]-``"""
        return self._hop("both", types, var, length, path, props)

    def path(self, on: Column | None = None) -> "Match":
        """Start another comma-separated path.

        A path that shares no variable with those before it needs ``on``, the condition
        that relates the two; it becomes their join.
        """
        self._paths.append([])
        self._on[len(self._paths) - 1] = on
        return self

    def where(self, condition: Column) -> "Match":
        self._where.append(condition)
        return self

    def optional(self, pattern: "Match", where: Column | None = None) -> "Match":
        """OPTIONAL MATCH: left join on the shared variables, ``where`` inside the join."""
        self._optional.append((pattern, where))
        return self

    # -- compilation --------------------------------------------------------------------------
    def _node_frame(self, node: _Node) -> DataFrame:
        df = scan_nodes(self.graph, node.labels, node.props)
        return df.select(*[F.col(c).alias(f"{node.var}_{c}") for c in df.columns])

    def _needs_join(self, node: _Node) -> bool:
        return node.named or node.constrained

    def _build_path(self, steps: list, start: DataFrame | None, bound: set[str], hops: list) -> DataFrame:
        first = steps[0]
        if start is not None and first.var in bound:
            cur = start
            if first.constrained:
                again = self._node_frame(first).select(f"{first.var}_id")
                cur = cur.join(again, f"{first.var}_id", "left_semi")
        elif len(steps) > 1 and not self._needs_join(first):
            cur = None  # the edge scan itself provides the ids
        else:
            cur = self._node_frame(first)
        bound.add(first.var)
        left = first
        for hop, right in zip(steps[1::2], steps[2::2]):
            if hop.length is not None:
                cur = self._variable(cur, left, hop, right, bound)
            else:
                cur = self._single(cur, left, hop, right, bound, hops)
            bound.add(right.var)
            left = right
        return cur

    def _edge_frame(self, hop: _Hop) -> DataFrame:
        """The edges of a hop, their source at its left end."""
        e = hop.var
        edges = scan_edges(self.graph, hop.types, hop.props, hop.direction)
        return edges.select(*[F.col(c).alias(f"{e}_{c}") for c in edges.columns])

    def _apart(self, cur: DataFrame, hops: list, others: list) -> DataFrame:
        """An edge binds once per pattern: no edge of ``hops`` is one of ``others``."""
        for a in hops if self.unique_edges else []:
            for b in others:
                if not a.types or not b.types or set(a.types) & set(b.types):
                    cur = cur.where(F.col(f"{b.var}_id") != F.col(f"{a.var}_id"))
        return cur

    @staticmethod
    def _as_stored(cur: DataFrame, hop: _Hop) -> DataFrame:
        """The stored direction of a hop against its edges, as startNode/endNode report it."""
        if hop.direction != "in":
            return cur
        swap = {f"{hop.var}_src": f"{hop.var}_dst", f"{hop.var}_dst": f"{hop.var}_src"}
        return cur.select(*[F.col(x).alias(swap.get(x, x)) for x in cur.columns])

    def _single(self, cur, left: _Node, hop: _Hop, right: _Node, bound: set[str], hops: list) -> DataFrame:
        e = hop.var
        edges = self._edge_frame(hop)
        if cur is None:
            cur = edges.withColumn(f"{left.var}_id", F.col(f"{e}_src"))
        else:
            condition = F.col(f"{left.var}_id") == F.col(f"{e}_src")
            if right.var in bound:
                condition = condition & (F.col(f"{right.var}_id") == F.col(f"{e}_dst"))
            cur = cur.join(edges, condition)
        cur = self._apart(cur, [hop], hops)
        hops.append(hop)
        if right.var not in bound and self._needs_join(right):
            cur = cur.join(self._node_frame(right), F.col(f"{right.var}_id") == F.col(f"{e}_dst"))
        elif right.var not in bound:
            cur = cur.withColumn(f"{right.var}_id", F.col(f"{e}_dst"))
        elif right.constrained:
            cur = cur.join(self._node_frame(right).select(f"{right.var}_id"), f"{right.var}_id", "left_semi")
        return self._as_stored(cur, hop)

    # -- cyclic patterns ----------------------------------------------------------------------
    def _triples(self) -> list[tuple[_Node, _Hop, _Node]]:
        return [t for steps in self._paths for t in zip(steps[::2], steps[1::2], steps[2::2])]

    def _cyclic(self) -> bool:
        """One connected pattern of single hops, with at least as many hops as nodes."""
        triples = self._triples()
        nodes = {n.var for left, _, right in triples for n in (left, right)}
        hops = [hop for _, hop, _ in triples]
        if len(hops) < max(2, len(nodes)) or any(h.length is not None for h in hops) or len({h.var for h in hops}) < len(hops):
            return False
        if any(self._on.values()) or any(len(steps) < 2 for steps in self._paths):
            return False
        met = {triples[0][0].var}
        while grown := {n.var for left, _, right in triples for n in (left, right) if {left.var, right.var} & met} - met:
            met |= grown
        return met == nodes

    def _by_size(self) -> DataFrame:
        """The hops of a cyclic pattern, joined in an order that their measured sizes give.

        Every node is joined to the smallest hop that touches it. Selections reduce the other hops by semi-joins, and a
        cycle closes on all variables that its two halves have in common.
        """
        triples, asked = self._triples(), {}
        for n in (n for steps in self._paths for n in steps if isinstance(n, _Node)):
            asked.setdefault(n.var, []).append(n)
        frames = []
        for left, hop, right in triples:
            e = hop.var
            df = self._edge_frame(hop).withColumn(f"{left.var}_id", F.col(f"{e}_src"))
            df = df.where(F.col(f"{e}_src") == F.col(f"{e}_dst")) if right.var == left.var else df.withColumn(f"{right.var}_id", F.col(f"{e}_dst"))
            frames.append((self._as_stored(df, hop), [left.var, right.var]))
        nodes = {}
        for var, uses in asked.items():
            if any(self._needs_join(n) for n in uses):
                df = scan_nodes(self.graph, sorted({x for n in uses for x in n.labels}))
                for n in uses:
                    df = scan_nodes(Graph(df, self.graph.edges), None, n.props)
                nodes[var] = df.select(*[F.col(c).alias(f"{var}_{c}") for c in df.columns])
        chosen = [v for v in nodes if any(n.constrained for n in asked[v])]
        found = sizes([(df, [f"{v}_id" for v in dict.fromkeys(ends)]) for df, ends in frames] + [(nodes[v], []) for v in chosen])  # node ids differ
        parts = [Part(df, float(n), dict(zip(dict.fromkeys(ends), map(float, d))), [hop]) for (df, ends), (n, d), (_, hop, _) in zip(frames, found, triples)]
        counts = {v: float(n) for v, (n, _) in zip(chosen, found[len(frames):])}
        for var, df in nodes.items():
            part = min((p for p in parts if var in p.ids), key=lambda p: p.rows)
            part.frame = part.frame.join(df, f"{var}_id")
            if counts.get(var, part.ids[var]) < part.ids[var]:
                part.selected = True
                part.limit(var, counts[var])
        reduce_parts(parts)
        return join_all(parts, self._apart)

    def _variable(self, cur, left: _Node, hop: _Hop, right: _Node, bound: set[str]) -> DataFrame:
        edges = scan_edges(self.graph, hop.types, hop.props, hop.direction)
        low, high = hop.length
        starts = self.graph.nodes.select("id") if cur is None else cur.select(F.col(f"{left.var}_id").alias("id"))
        if self._once and not hop.named and hop.path is None and low <= 1:
            # nobody sees the way or counts the ways, so a pair of ends is all that is asked for
            pairs = reachable(edges, starts.distinct(), low, high)
            return self._arrive(cur, left, right, bound, pairs.select(F.col("start").alias(f"{hop.var}_start"), F.col("end").alias(f"{hop.var}_end")), hop.var)
        paths = expand(edges, starts.distinct(), low, high)
        p = hop.path or hop.var
        paths = paths.select(
            F.col("start").alias(f"{p}_start"),
            F.col("end").alias(f"{p}_end"),
            F.col("depth").alias(f"{p}_length"),
            F.col("node_ids").alias(f"{p}_node_ids"),
            F.col("edge_ids").alias(f"{p}_edge_ids"),
        )
        return self._arrive(cur, left, right, bound, paths, p)

    def _arrive(self, cur, left: _Node, right: _Node, bound: set[str], paths: DataFrame, p: str) -> DataFrame:
        """Join ways from the left node and bind the right one."""
        if cur is None:
            cur = paths.withColumn(f"{left.var}_id", F.col(f"{p}_start"))
        else:
            cur = cur.join(paths, F.col(f"{left.var}_id") == F.col(f"{p}_start"))
        if right.var in bound:
            return cur.where(F.col(f"{right.var}_id") == F.col(f"{p}_end"))
        if self._needs_join(right):
            return cur.join(self._node_frame(right), F.col(f"{right.var}_id") == F.col(f"{p}_end"))
        return cur.withColumn(f"{right.var}_id", F.col(f"{p}_end"))

    @staticmethod
    def _flip(steps: list) -> list:
        turn = {"out": "in", "in": "out", "both": "both"}
        flipped = []
        for s in reversed(steps):
            flipped.append(s if isinstance(s, _Node) else _Hop(s.var, s.named, s.types, s.props, turn[s.direction], s.length, s.path))
        return flipped

    def variables(self) -> set[str]:
        return {s.var for steps in self._paths for s in steps if isinstance(s, _Node) and s.named}

    def distinct(self, *columns: str) -> DataFrame:
        """RETURN DISTINCT ``columns``.

        A hop of variable length without a name is then compiled to a search for reachable ends, with one row for each start and
        end, whatever the number of ways between them; ``*`` ends on graphs with cycles too. With a name, or at least two
        edges long, its ways are listed as in ``df``.
        """
        return self._matches(once=True).select(*columns).distinct()

    def ends(self, *columns: str) -> DataFrame:
        """As ``distinct``, for semi-joins, which do not mind repeated rows."""
        return self._matches(once=True).select(*columns)

    def df(self) -> DataFrame:
        """One row per match."""
        return self._matches(once=False)

    def _matches(self, once: bool) -> DataFrame:
        self._once = once
        cur, bound, hops = (self._by_size() if self._cyclic() else None), set(), []
        for number, steps in enumerate(self._paths if cur is None else []):
            named = {s.var for s in steps if isinstance(s, _Node)}
            if cur is not None and steps[0].var not in bound and steps[-1].var in bound:
                steps = self._flip(steps)
            if cur is None or steps[0].var in bound:
                cur = self._build_path(steps, cur, bound, hops)
            else:
                shared = [f"{v}_id" for v in sorted(named & bound)]
                other = self._build_path(steps, None, set(), hops)
                if shared:
                    keep = [c for c in other.columns if c in shared or c not in cur.columns]
                    cur = cur.join(other.select(*keep), shared)
                elif self._on.get(number) is None:
                    raise ValueError("a path shares no variable with those before it; relate them by path(on=...)")
                else:
                    cur = cur.join(other, self._on[number])
                bound |= named
        for condition in self._where:
            cur = cur.where(condition)
        for pattern, condition in self._optional:
            cur = left_outer(cur, pattern.df(), [f"{v}_id" for v in sorted(pattern.variables())], condition)
        # engine-made names of unnamed parts are not visible to the caller
        return cur.select(*[c for c in cur.columns if not c.startswith("_")])


def left_outer(cur: DataFrame, other: DataFrame, id_columns: list[str], condition: Column | None) -> DataFrame:
    """Keep all rows of ``cur``; bind ``other`` where the shared ids agree and ``condition`` holds."""
    shared = [c for c in id_columns if c in cur.columns]
    if not shared:
        raise ValueError("an optional pattern must share a variable with the rows it extends")
    keep = [c for c in other.columns if c not in cur.columns]
    renamed = other.select(*[F.col(c).alias(f"_opt_{c}") for c in shared], *keep)
    on = F.lit(True)
    for c in shared:
        on = on & (F.col(c) == F.col(f"_opt_{c}"))
    if condition is not None:
        on = on & condition
    return cur.join(renamed, on, "left").drop(*[f"_opt_{c}" for c in shared])


def exists_pattern(rows: DataFrame, pattern: Match, on: list[str], negate: bool = False) -> DataFrame:
    """WHERE [NOT] EXISTS(pattern): semi or anti join on the shared variables."""
    ids = [f"{v}_id" for v in on]
    return rows.join(pattern.ends(*ids), ids, "left_anti" if negate else "left_semi")


def pattern_list(rows: DataFrame, pattern: Match, on: str, value: Column, out: str, where: Column | None = None) -> DataFrame:
    """Pattern comprehension: the values of all matches as a sorted list, empty if none."""
    hits = pattern.df()
    if where is not None:
        hits = hits.where(where)
    key = f"{on}_id"
    lists = hits.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias(out))
    element = lists.schema[out].dataType
    return rows.join(lists, key, "left").withColumn(out, F.coalesce(out, F.array().cast(element)))


__all__ = [
    "EDGE_KEYS", "Match", "exists_pattern", "left_outer", "pattern_list", "property_filter", "scan_edges", "scan_nodes",
]
