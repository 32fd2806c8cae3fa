"""Long rings, chains and deep trees: rounds follow the logarithm, and results those of plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from graphweft.graph import Graph
from graphweft.operators import components, forest, traversal
from graphweft.operators.paths import _first_edges, shortest_paths
from graphweft.operators.traversal import reach_levels
from graphweft.placed import FOLD_EVERY, PlacedTable, levels
from graphweft.skew import Fanout


@pytest.fixture
def rounds(monkeypatch):
    """Counts what the strong components materialise."""
    made = []
    for name in ("cut", "settle"):
        step = getattr(components, name)
        monkeypatch.setattr(components, name, lambda df, step=step: made.append(1) or step(df))
    return made


def reach(nodes, edges):
    out = {v: set() for v in nodes}
    for a, b in edges:
        out[a].add(b)
    for s in nodes:
        seen, open_ = {s}, [s]
        while open_:
            for b in out[open_.pop()] - seen:
                seen.add(b)
                open_.append(b)
        yield s, seen


def plain_scc(nodes, edges):
    met = dict(reach(nodes, edges))
    return {v: min(u for u in met[v] if v in met[u]) for v in nodes}


def test_ring_of_many_nodes(spark, rounds):
    n = 100_000
    rng = random.Random(1)
    order = list(range(n))
    rng.shuffle(order)
    nodes = spark.range(n).select("id", F.array(F.lit("N")).alias("labels"))
    edges = spark.createDataFrame(list(zip(range(n), order, order[1:] + order[:1])), "id long, src long, dst long").withColumn("type", F.lit("E"))
    got = components.scc(Graph(nodes, edges)).groupBy("component").count().collect()
    assert [tuple(r) for r in got] == [(0, n)]
    assert len(rounds) < 40


def test_wide_ring_and_long_path(plain, rounds):
    rng = random.Random(2)
    k = 300
    ids = rng.sample(range(5000), 4 * k)
    ring = [(ids[2 * i + a], ids[2 * ((i + 1) % k) + b]) for i in range(k) for a in (0, 1) for b in (0, 1)]  # every node has two ways on
    path = [(ids[2 * k + i], ids[2 * k + i + 1]) for i in range(2 * k - 1)]
    got = {r.id: r.component for r in components.scc(plain(ids, ring + path + [(ids[0], ids[2 * k])])).collect()}
    low = min(ids[: 2 * k])
    assert got == {v: low for v in ids[: 2 * k]} | {v: v for v in ids[2 * k :]}
    assert len(rounds) < 150


@pytest.mark.parametrize("seed", range(4))
def test_folded_components(plain, seed):
    rng = random.Random(seed)
    n = rng.choice([8, 20])
    nodes = list(range(n))
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(int(n * (0.9, 1.1, 1.4, 2.2)[seed]))]
    assert {r.id: r.component for r in components.scc(plain(nodes, edges)).collect()} == plain_scc(nodes, edges)


def test_chain_of_ten_thousand(plain, spark):
    n = 10_000
    rng = random.Random(3)
    order = list(range(n))
    rng.shuffle(order)
    g = plain(range(n), [(a, b, 0.5) for a, b in zip(order, order[1:])])
    row = traversal.dijkstra(g, order[0], order[-1], "w").first()
    assert (row.found, row.distance, row.path) == (True, 0.5 * (n - 1), order)
    assert traversal.dijkstra(g, order[5], order[2]).first().found is False
    found = traversal.single_source(g, order[10])
    assert {r.id: (r.distance, r.previous) for r in found.collect()} == {order[i]: (float(i - 10), order[i - 1] if i > 10 else None) for i in range(10, n)}
    ways = {r.target: r.path for r in traversal.way_to(found, spark.createDataFrame([(order[17],), (order[10],), (order[3],)], "id long")).collect()}
    assert ways == {order[17]: order[10:18], order[10]: [order[10]]}
    visits = traversal.dfs_forest(g, spark.createDataFrame([(order[0],)], "id long")).collect()
    assert {r.id: (r.depth, r.visit) for r in visits} == {v: (i, i) for i, v in enumerate(order)}


def test_lanes_between_branches(plain):
    # two lanes of different weight, a lane that comes back to its beginning, a ring that nothing enters, and parallel edges
    edges = [(0, 1, 1), (1, 2, 1), (2, 9, 1), (0, 3, 1), (3, 4, 1), (4, 5, 0), (5, 9, 0.5), (9, 6, 1), (6, 7, 1), (7, 9, 1), (20, 21, 1), (21, 20, 1), (9, 8, 4), (9, 8, 2), (8, 0, 1)]
    g = plain([*range(10), 20, 21], edges)
    want = {0: (0, None), 1: (1, 0), 2: (2, 1), 3: (1, 0), 4: (2, 3), 5: (2, 4), 9: (2.5, 5), 6: (3.5, 9), 7: (4.5, 6), 8: (4.5, 9)}
    assert {r.id: (r.distance, r.previous) for r in traversal.single_source(g, 0, "w").collect()} == want
    for target, path in ((8, [0, 3, 4, 5, 9, 8]), (7, [0, 3, 4, 5, 9, 6, 7]), (0, [0]), (20, None)):
        row = traversal.dijkstra(g, 0, target, "w").first()
        assert (row.found, row.path) == (path is not None, path)


def test_random_ways(plain):
    rng = random.Random(4)
    n = 14
    edges = [(rng.randrange(n), rng.randrange(n), rng.choice([1, 1, 2, 3, 7])) for _ in range(24)]
    g = plain(range(n), edges)
    least = {}
    for a, b, w in edges:
        if a != b:
            least[a, b] = min(w, least.get((a, b), 99))
    best = {0: 0}
    for _ in range(n):
        for (a, b), w in least.items():
            if a in best and best[a] + w < best.get(b, 999):
                best[b] = best[a] + w
    assert {r.id: r.distance for r in traversal.single_source(g, 0, "w").collect()} == best
    for t in range(0, n, 3):
        row = traversal.dijkstra(g, 0, t, "w").first()
        assert row.found == (t in best) and row.distance == best.get(t)
        if row.found:
            assert (row.path[0], row.path[-1]) == (0, t) and sum(least[e] for e in zip(row.path, row.path[1:])) == best[t]


def test_deep_tree_in_preorder(plain, spark):
    rng = random.Random(5)
    n = 600
    above = {i: rng.randrange(max(0, i - 3), i) for i in range(1, n)}  # deep, with branches
    above.pop(300)
    edges = [(p, c) for c, p in above.items()]
    rng.shuffle(edges)
    g = plain(range(n), edges)
    kids = {}
    for a, b in edges:  # ids of edges follow their order
        kids.setdefault(a, []).append(b)
    want, stack = [], [(300, 0), (0, 0)]
    while stack:
        v, d = stack.pop()
        want.append((v, d))
        stack += [(c, d + 1) for c in reversed(kids.get(v, []))]
    got = traversal.dfs_forest(g, spark.createDataFrame([(0,), (300,)], "id long"))
    assert [(r.id, r.depth) for r in got.orderBy("visit").collect()] == want
    some = traversal.dfs_forest(g, spark.createDataFrame([(300,), (0,)], "id long"), 20)
    assert [(r.id, r.depth) for r in some.orderBy("visit").collect()] == [x for x in want if x[1] <= 20]


def test_shortest_paths_by_rank(plain):
    # the smallest path is not the one over the smallest last but one node
    g = plain(range(8), [(0, 2), (0, 1), (2, 3), (1, 4), (3, 7), (4, 7), (0, 1), (7, 5)])
    got = {r.end: (r.node_ids, r.edge_ids) for r in shortest_paths(g.edges, g.nodes.where("id = 0").select("id")).collect()}
    assert got[7] == ([0, 1, 4, 7], [2, 4, 6]) and got[5] == ([0, 1, 4, 7, 5], [2, 4, 6, 8])
    every = shortest_paths(g.edges, g.nodes.where("id = 0").select("id"), all_ties=True).where("end = 5").collect()
    assert sorted(r.node_ids for r in every) == [[0, 1, 4, 7, 5]] * 2 + [[0, 2, 3, 7, 5]]


def test_placed_table(spark):
    table = PlacedTable(spark.createDataFrame([(1, 0)], "id long, depth int"), ["id"], 4)
    for d in range(1, FOLD_EVERY + 3):
        table.add(table.missing(spark.createDataFrame([(d, d), (d + 1, d)], "id long, depth int")))
    assert {(r.id, r.depth) for r in table.rows().collect()} == {(1, 0)} | {(d + 1, d) for d in range(1, FOLD_EVERY + 3)}
    assert [r.id for r in levels(table, 5).collect()] == [6]
    plan = table.missing(spark.range(100).groupBy((F.col("id") % 7).alias("id")).count())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan  # only the candidates move


def test_ways_up_in_several_forests(spark):
    f = spark.createDataFrame([("a", 1, None), ("a", 2, 1), ("a", 3, 2), ("b", 3, 1), ("b", 1, 2), ("b", 2, None)], "s string, id long, above long")
    got = forest.ways_up(f, f.where("id = 3").select("s", "id"), ["s"])
    assert sorted((r.s, r.back, r.id) for r in got.collect()) == [("a", 0, 3), ("a", 1, 2), ("a", 2, 1), ("b", 0, 3), ("b", 1, 1), ("b", 2, 2)]
    with pytest.raises(ValueError):
        forest.depths(spark.createDataFrame([(1, 2), (2, 1)], "id long, above long"))


def test_shortest_paths_from_everywhere(spark, plain):
    """From all nodes the ends share rows, 64 to one, and the paths are those of a search without the first node."""
    draw = random.Random(7)
    pairs = [(0, 1)] + [(draw.randrange(70), draw.randrange(70)) for _ in range(400)] + [(69, 70), (70, 71)]
    g = plain(range(72), [*pairs, *pairs[:40]])  # parallel edges and a lane
    cols = ["start", "end", "depth", "node_ids", "edge_ids"]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "7")  # groups go over several batches
    try:
        for ties in (False, True):
            every = rows(shortest_paths(g.edges, g.nodes.select("id"), ties).where("start <> 0"), *cols)
            assert every == rows(shortest_paths(g.edges, g.nodes.select("id").where("id <> 0"), ties), *cols)
        assert max(r[2] for r in every) > 4
        near = rows(shortest_paths(g.edges, g.nodes.select("id"), True, 1).where("start <> 0"), *cols)
        assert near == [r for r in every if r[2] <= 1]
    finally:
        spark.conf.unset(name)


def test_shared_ends_keep_one_edge_a_pair(plain):
    """Of a dense graph only the edge a path begins with leaves the level, not an offer for every edge."""
    n = 70
    g = plain(range(n), [(a, b) for a in range(n) for b in range(n) if a != b and (a * b) % 3 == 0])
    hops = g.edges.select("src", "dst", F.col("id").alias("edge_id"))
    search = reach_levels(Fanout(hops.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "edge_id")), g.nodes.select("id"))
    first = _first_edges(Fanout(hops.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "edge_id")), search, 2)
    assert first.count() == search.pairs().where("depth = 2").count() == first.select("block", "bit", "id").distinct().count()
