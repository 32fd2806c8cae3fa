"""Connected components, undirected and strong; labels are smallest member ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import skew
from ..graph import Graph
from ..session import cut, settle
from ..skew import Fanout

FOLD_FROM = 20  # folding pays where more than one node in so many has a single exit


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    """Row count and an order-free hash of the rows."""
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return row[0], int(row[1])


def _nearest(edges: DataFrame, total: int, chunk: int | None) -> DataFrame:
    """Edges with ``m``, the smallest of u and its neighbours v."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("_n"))
    if total > (chunk or skew.ROWS_PER_SALT):
        least = settle(least)  # read several times when hot keys are split
    return skew.join_spread(edges, least, "u", "_n", total, [F.col("v")], chunk)


def wcc(graph: Graph, chunk: int | None = None) -> DataFrame:
    """``id, component``: alternating large-star and small-star rounds.

    Each round hooks neighbours to the smallest id around them until every
    component is a star; the number of rounds grows with the logarithm of its size.
    """
    pairs = graph.edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    edges = settle(pairs)
    mark = _fingerprint(edges)
    while mark[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _nearest(both, 2 * mark[0], chunk).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = settle(large)
        small = _nearest(large, 2 * mark[0], chunk)
        hooked = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v")))
        edges = settle(hooked.where("u <> v").distinct())
        now = _fingerprint(edges)
        if now == mark:
            break
        mark = now
    labels = edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return graph.nodes.select("id").join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _jumped(pointers: DataFrame, steps: int, **carried: str) -> DataFrame:
    """``id, at`` after ``2 ** steps`` steps along ``pointers(id, at)``; where a pointer ends, it stays.

    Each round joins the pointers with themselves, which doubles what one covers. ``carried`` columns become their minimum over all nodes passed.
    """
    for _ in range(steps):
        nxt = pointers.select(F.col("id").alias("at"), F.col("at").alias("_to"), *[F.col(c).alias(f"_{c}") for c in carried])
        pointers = settle(
            pointers.join(nxt, "at", "left").select("id", F.coalesce("_to", "at").alias("at"), *[F.least(c, f"_{c}").alias(c) for c in carried])
        )
    return pointers


class _Folded:
    """Nodes with a single out-edge, taken into the node at which their way ends.

    A cycle through such a node also passes that end, so the node is in the end's component if something of this component
    leads to it, and alone otherwise (``unfold``). Ways that never end lead into rings, which are components.
    """

    def __init__(self, edges: DataFrame, single: DataFrame, forward: bool):
        """``single(id, at)``: the nodes and their successors, seen in the given direction."""
        self.forward, self.single = forward, settle(single)
        n = self.single.count()
        self.steps = n.bit_length()
        ways = _jumped(self.single.withColumn("least", F.least("id", "at")), self.steps, least="")
        ids = self.single.select(F.col("id").alias("at"))
        endless = ways.join(ids, "at", "left_semi")
        ring = endless.select(F.col("at").alias("id")).distinct()
        rings = endless.join(ring, "id", "left_semi").select("id", F.col("least").alias("component"))
        alone = endless.join(ring, "id", "left_anti").select("id", F.col("id").alias("component"))
        #: components that are complete by now
        self.done = settle(rings.unionAll(alone))
        self.ends = settle(ways.join(ids, "at", "left_anti").select("id", "at"))
        taken = self.single.select("id")
        back = self._turned(edges)
        rest = back.join(taken.withColumnRenamed("id", "src"), "src", "left_anti")
        ends = self.ends.select(F.col("id").alias("dst"), F.col("at").alias("_end"))
        gone = self.done.select(F.col("id").alias("dst"))
        placed = rest.join(gone, "dst", "left_anti").join(ends, "dst", "left")
        #: edges that lead into the folded nodes
        self.entries = settle(placed.where("_end is not null").select("src", "dst"))
        self.edges = settle(self._turned(placed.select("src", F.coalesce("_end", "dst").alias("dst")).where("src <> dst").distinct()))
        self.count = n

    def _turned(self, edges: DataFrame) -> DataFrame:
        return edges if self.forward else edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))

    def unfold(self, known: DataFrame) -> DataFrame:
        """``known(id, component)`` with the folded nodes added."""
        if self.ends.isEmpty():
            return settle(known.unionByName(self.done))
        ends = self.ends.join(known.select(F.col("id").alias("at"), F.col("component").alias("of_end")), "at").select("id", "of_end")
        into = self.entries.join(known.select(F.col("id").alias("src"), F.col("component").alias("of_src")), "src").select(F.col("dst").alias("id"), "of_src").distinct()
        hit = ends.join(into, "id").where("of_src = of_end").select("id").distinct().withColumn("hit", F.lit(True))
        state = settle(ends.join(self.single.join(self.ends.select("id"), "id"), "id").join(hit, "id", "left").select("id", "at", "of_end", F.coalesce("hit", F.lit(False)).alias("hit")))
        for _ in range(self.steps):  # whatever is led to leads on: to the next, then two, four ... further
            passed = state.where("hit").select(F.col("at").alias("id")).distinct().withColumn("_passed", F.lit(True))
            jump = state.select(F.col("id").alias("at"), F.col("at").alias("_to"))
            state = settle(
                state.join(passed, "id", "left").join(jump, "at", "left")
                .select("id", F.coalesce("_to", "at").alias("at"), "of_end", (F.col("hit") | F.coalesce("_passed", F.lit(False))).alias("hit"))
            )
        found = state.select("id", F.when(F.col("hit"), F.col("of_end")).otherwise(F.col("id")).alias("component"))
        return settle(known.unionByName(found).unionByName(self.done))


def _single_exits(edges: DataFrame) -> DataFrame:
    """``id, at``: nodes with one successor, and that successor; edges are distinct."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("_n"), F.min("dst").alias("at")).where("_n = 1").select("id", "at")


def _reversed(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def _spread_min(fan: Fanout, state: DataFrame) -> DataFrame:
    """The least label that reaches each node: ``id, label``; a label is a struct with the ``id`` of the node it began at.

    In every round a node takes the least label of its predecessors, and then the label of its label's node:
    what reaches that node reaches this one too. So labels travel as far again as they have come, not one edge.
    """
    state = settle(state.select("id", "label", F.lit(True).alias("fresh")))
    while True:
        offers = fan.send(state.where("fresh").select("id", "label")).select(F.col("dst").alias("id"), "label", F.lit(None).cast(state.schema["label"].dataType).alias("was"))
        merged = state.select("id", "label", F.col("label").alias("was")).unionAll(offers).groupBy("id").agg(F.min("label").alias("label"), F.min("was").alias("was"))
        merged = settle(merged.where("was is not null"))
        # only nodes that have a label of another node are asked for theirs
        asked = merged.select(F.col("label.id").alias("id")).distinct()
        better = merged.join(asked, "id", "left_semi").where("label.id <> id").select(F.col("id").alias("_of"), F.col("label").alias("_label"))
        state = merged.join(better, F.col("label.id") == F.col("_of"), "left").select(
            "id", F.coalesce("_label", "label").alias("label"), (F.coalesce("_label", "label") < F.col("was")).alias("fresh")
        )
        state = settle(state)
        if state.where("fresh").isEmpty():
            return state.select("id", "label")


def scc(graph: Graph) -> DataFrame:
    """``id, component``: folding, trimming, then labels of many pivots spread forward and backward.

    Nodes with a single successor or predecessor are folded into the node at which their way ends, by pointer jumping, so rings,
    chains and trees go in a number of rounds that follows the logarithm of their length (``_Folded``). Nodes
    without predecessor or successor are components by themselves.

    Then every node is a pivot with a seeded random rank: ``f`` is the first rank that reaches a node, ``b`` the first it reaches. Where they
    agree, the node is in that pivot's component. Members of one component share both, so edges between different pairs are
    dropped and the rest repeats. Labels travel by pointer jumping as well.
    """
    nodes = cut(graph.nodes.select("id").distinct())
    edges = cut(graph.edges.where("src <> dst").select("src", "dst").distinct())
    done, folded = [], []
    while True:
        # a node without incoming or outgoing edges is a component by itself
        inner = edges.select(F.col("src").alias("id")).distinct().join(edges.select(F.col("dst").alias("id")).distinct(), "id")
        done.append(cut(nodes.join(inner, "id", "left_anti").select("id", F.col("id").alias("component"))))
        nodes = cut(nodes.join(inner, "id", "left_semi"))
        n = nodes.count()
        if not n:
            break
        edges = cut(_inside(edges, nodes))
        for forward in (True, False):
            single = cut(_single_exits(edges if forward else _reversed(edges)))
            if single.count() * FOLD_FROM > n:
                fold = _Folded(edges, single, forward)
                folded.append(fold)
                edges = fold.edges
                nodes = cut(nodes.join(fold.single.select("id"), "id", "left_anti"))
        if folded and folded[-1].count and edges.isEmpty():
            continue
        own = nodes.select("id", F.struct(F.xxhash64("id").alias("rank"), "id").alias("label"))
        f = _spread_min(Fanout(edges, resident=True), own).withColumnRenamed("label", "f")
        b = _spread_min(Fanout(_reversed(edges), resident=True), own).withColumnRenamed("label", "b")
        pair = cut(f.join(b, "id"))
        done.append(pair.where("f = b").select("id", F.col("f.id").alias("component")))
        rest = pair.where("f <> b").select("id", F.col("f.id").alias("f"), F.col("b.id").alias("b"))
        nodes = rest.select("id")
        tail = rest.select(F.col("id").alias("src"), F.struct("f", "b").alias("_s"))
        head = rest.select(F.col("id").alias("dst"), F.struct("f", "b").alias("_d"))
        edges = cut(edges.join(tail, "src").join(head, "dst").where("_s = _d").select("src", "dst"))
    known = reduce(DataFrame.unionAll, done)
    for fold in reversed(folded):
        known = fold.unfold(known)
    # the smallest member names the component
    named = known.groupBy("component").agg(F.min("id").alias("_name"))
    return known.join(named, "component").select("id", F.col("_name").alias("component"))


def _inside(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes."""
    return edges.join(nodes.withColumnRenamed("id", "src"), "src", "left_semi").join(nodes.withColumnRenamed("id", "dst"), "dst", "left_semi")
