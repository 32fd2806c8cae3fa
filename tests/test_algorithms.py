"""Algorithms on the four-node fixture and against brute force on random graphs."""

import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from graphweft.graph import Graph
from graphweft.operators import centrality, community, components, ranking, similarity, traversal
from graphweft import skew

from conftest import rows


@pytest.fixture(scope="module")
def four(plain):
    return plain([1, 2, 3, 4], [(1, 2), (2, 3), (3, 1), (3, 4)])


def values(df, digits=6):
    return {r[0]: round(r[1], digits) for r in df.collect()}


def test_degrees(four):
    assert rows(centrality.degrees(four), "id", "in_degree", "out_degree", "degree") == [(1, 1, 1, 2), (2, 1, 1, 2), (3, 1, 2, 3), (4, 1, 0, 1)]


def test_components(four):
    assert values(components.wcc(four)) == {1: 1, 2: 1, 3: 1, 4: 1}
    assert values(components.scc(four)) == {1: 1, 2: 1, 3: 1, 4: 4}


def test_triangles(four):
    got = {r.id: (r.triangles, round(r.clustering, 6)) for r in similarity.triangles(four).collect()}
    assert got == {1: (1, 1.0), 2: (1, 1.0), 3: (1, 0.333333), 4: (0, 0.0)}


def test_centralities(four):
    assert values(centrality.closeness(four)) == {1: 0.833333, 2: 0.833333, 3: 1.0, 4: 0.666667}
    assert values(centrality.betweenness(four)) == {1: 1, 2: 2, 3: 3, 4: 0}


def test_pagerank(four):
    got = values(ranking.pagerank(four, iterations=20, tolerance=None))
    assert got == {1: 0.096707, 2: 0.119701, 3: 0.139310, 4: 0.096707}
    assert sum(values(ranking.pagerank(four, tolerance=1e-3)).values()) < 1
    assert [r.id for r in ranking.top_pagerank(four, 2, tolerance=None).collect()] == [3, 2]


def test_personalized(four, spark):
    got = values(ranking.pagerank(four, iterations=3, tolerance=None, seeds=spark.createDataFrame([(4,)], "id long")))
    assert got == {1: 0.0, 2: 0.0, 3: 0.0, 4: 0.15}


def test_all_pairs_and_searches(four):
    assert rows(traversal.all_pairs(four)) == [(1, 2, 1), (1, 3, 2), (1, 4, 3), (2, 1, 2), (2, 3, 1), (2, 4, 2), (3, 1, 1), (3, 2, 2), (3, 4, 1)]
    assert rows(traversal.bfs(four, 1), "id", "depth", "visit") == [(1, 0, 0), (2, 1, 1), (3, 2, 2), (4, 3, 3)]
    assert rows(traversal.bfs(four, 1, 1), "id", "depth") == [(1, 0), (2, 1)]


def test_label_propagation(four):
    assert set(values(community.label_propagation(four)).values()) == {1}


def test_isolated_nodes(plain):
    g = plain([1, 2, 3], [])
    assert values(components.wcc(g)) == {1: 1, 2: 2, 3: 3} == values(components.scc(g))
    assert values(community.label_propagation(g)) == {1: 1, 2: 2, 3: 3}
    assert values(ranking.pagerank(g, iterations=2, tolerance=None)) == {1: 0.05, 2: 0.05, 3: 0.05}
    assert traversal.all_pairs(g).count() == 0


def random_edges(seed, n, m):
    rng = random.Random(seed)
    hub = [(0, rng.randrange(n)) for _ in range(m // 3)]  # a third of all edges leave one node
    return list(range(n)), hub + [(rng.randrange(n), rng.randrange(n)) for _ in range(m - len(hub))]


@pytest.fixture(params=[1, 2])
def rand(request, plain, monkeypatch):
    # a tiny chunk makes the salted joins take part
    monkeypatch.setattr(skew, "ROWS_PER_SALT", 4)
    nodes, edges = random_edges(request.param, 24, 60)
    return nodes, edges, plain(nodes, edges)


def distances(nodes, edges):
    out = defaultdict(set)
    for a, b in edges:
        out[a].add(b)
    dist = {}
    for s in nodes:
        front, d = {s}, 0
        dist[s, s] = 0
        while front:
            d += 1
            front = {b for a in front for b in out[a] if (s, b) not in dist}
            for b in front:
                dist[s, b] = d
    return dist


def test_random_reachability(rand):
    nodes, edges, g = rand
    dist = distances(nodes, edges)
    assert rows(traversal.all_pairs(g)) == sorted((a, b, d) for (a, b), d in dist.items() if d)
    scc = {a: min(b for b in nodes if (a, b) in dist and (b, a) in dist) for a in nodes}
    assert values(components.scc(g)) == scc
    both = distances(nodes, edges + [(b, a) for a, b in edges])
    assert values(components.wcc(g, chunk=3)) == {a: min(b for b in nodes if (a, b) in both) for a in nodes}
    close = {a: round(sum(1 / both[a, b] for b in nodes if b != a and (a, b) in both) / (len(nodes) - 1), 6) for a in nodes}
    assert values(centrality.closeness(g)) == close


def test_random_betweenness(rand):
    nodes, edges, g = rand
    dist = distances(nodes, edges)
    mult = Counter((a, b) for a, b in edges if a != b)
    sigma = {}
    for (s, t), d in sorted(dist.items(), key=lambda x: x[1]):
        sigma[s, t] = 1 if d == 0 else sum(sigma[s, u] * k for (u, v), k in mult.items() if v == t and dist.get((s, u)) == d - 1)
    want = {
        v: round(sum(sigma[s, v] * sigma[v, t] / sigma[s, t] for s in nodes for t in nodes
                     if len({s, v, t}) == 3 and (s, t) in dist and (s, v) in dist and (v, t) in dist and dist[s, v] + dist[v, t] == dist[s, t]), 6)
        for v in nodes
    }
    assert values(centrality.betweenness(g)) == want


def test_random_neighbourhoods(rand):
    nodes, edges, g = rand
    nb = defaultdict(set)
    for a, b in edges:
        if a != b:
            nb[a].add(b)
    jaccard = {(a, b): len(nb[a] & nb[b]) / len(nb[a] | nb[b]) for a, b in itertools.combinations(nodes, 2) if nb[a] & nb[b]}
    got = {(r.a, r.b): r.similarity for r in similarity.node_similarity(g).collect()}
    assert got == pytest.approx(jaccard)
    for t in (0.1, 0.34, 0.5, 1.0):
        part = {(r.a, r.b): r.similarity for r in similarity.node_similarity(g, threshold=t).collect()}
        assert part == pytest.approx({p: j for p, j in jaccard.items() if j >= t})
    und = {frozenset(e) for e in edges if e[0] != e[1]}
    tri = Counter(x for t in itertools.combinations(nodes, 3) if all(frozenset(p) in und for p in itertools.combinations(t, 2)) for x in t)
    assert {r.id: r.triangles for r in similarity.triangles(g).collect()} == {n: tri[n] for n in nodes}


def test_random_dijkstra(spark, plain):
    rng = random.Random(5)
    nodes, pairs = random_edges(7, 20, 70)
    edges = [(a, b, rng.choice([0, 1, 1, 2, 5])) for a, b in pairs]
    g = plain(nodes, edges)
    best = {0: 0.0}
    for _ in nodes:
        for a, b, w in edges:
            if a in best and best[a] + w < best.get(b, 1e9):
                best[b] = best[a] + w
    assert {r.id: r.distance for r in traversal.single_source(g, 0, "w").collect()} == best
    for t in (3, 11, 19):
        row = traversal.dijkstra(g, 0, t, "w").first()
        assert (row.found, row.distance) == ((True, best[t]) if t in best else (False, None))
        placed = type(g)(g.nodes.withColumns({"x": F.col("id") * 0.0, "y": F.col("id") * 0.0}), g.edges)
        assert traversal.astar(placed, 0, t, "x", "y", "w").first().distance == row.distance


def test_astar_ignores_a_misleading_estimate(plain):
    # the straight distance is larger than the edge weights, so it must not prune
    g = plain([1, 2, 3], [(1, 2, 1), (2, 3, 1), (1, 3, 5)])
    far = type(g)(g.nodes.withColumns({"x": F.when(F.col("id") == 2, 100.0).otherwise(0.0), "y": F.lit(0.0)}), g.edges)
    row = traversal.astar(far, 1, 3, "x", "y", "w").first()
    assert (row.distance, row.path) == (2.0, [1, 2, 3])


def test_dfs_forest(plain, spark):
    g = plain(range(1, 9), [(1, 3), (1, 2), (3, 5), (3, 4), (6, 7)])
    roots = spark.createDataFrame([(1,), (6,)], "id long")
    got = [r.id for r in traversal.dfs_forest(g, roots).orderBy("visit").collect()]
    assert got == [1, 3, 5, 4, 2, 6, 7]
    assert [r.id for r in traversal.dfs_forest(g, roots, 1).orderBy("visit").collect()] == [1, 3, 2, 6, 7]
    with pytest.raises(ValueError):
        traversal.dfs_forest(plain([1, 2, 3], [(1, 3), (2, 3)]), spark.createDataFrame([(1,), (2,)], "id long"))
    with pytest.raises(ValueError):
        traversal.dfs_forest(plain([1, 2, 3], [(2, 3), (3, 2)]), spark.createDataFrame([(1,)], "id long"))


def test_louvain_finds_cliques(plain):
    clique = lambda xs: list(itertools.combinations(xs, 2))
    g = plain(range(1, 9), clique([1, 2, 3, 4]) + clique([5, 6, 7, 8]) + [(4, 5)])
    labels, q = community.louvain(g)
    assert values(labels) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5, 7: 5, 8: 5}
    assert q == pytest.approx(community.modularity(g.edges, labels))
    assert q == pytest.approx(12 / 13 - 0.5)


def test_pair_and_knn(plain, spark):
    g = plain([1, 2, 3, 9], [(1, 9), (1, 3), (2, 9), (2, 3), (3, 9)])
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 9)], "a long, b long")
    assert rows(similarity.pair_similarity(g, pairs)) == [(1, 2, 1.0), (1, 3, 0.5), (1, 9, 0.0)]
    assert rows(similarity.knn_nodes(g, 1, spark.createDataFrame([(1,)], "id long")), "a", "b", "rank") == [(1, 2, 1)]


def test_k_and_iterations_as_given(plain):
    g = plain(range(3000), [(i, (i * 7 + 1) % 3000) for i in range(3000)])
    assert ranking.top_pagerank(g, 2000, iterations=1).count() == 2000
    for bad in (lambda: ranking.top_pagerank(g, 0), lambda: ranking.pagerank(g, iterations=0), lambda: community.label_propagation(g, 0)):
        with pytest.raises(ValueError):
            bad()


def test_component_rounds_begin_without_constraints(spark, monkeypatch):
    """What the optimizer infers about the edges of one round must not be carried into the next, where the joins multiply it."""
    seen = []
    real = components._fingerprint
    monkeypatch.setattr(components, "_fingerprint", lambda e: seen.append(e._jdf.queryExecution().optimizedPlan().constraints().size()) or real(e))
    nodes = spark.range(60).select("id", F.array(F.lit("N")).alias("labels"))
    edges = spark.range(59).select("id", F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit("E").alias("type")).where("id <> 29")
    got = {r.id: r.component for r in components.wcc(Graph(nodes, edges)).collect()}
    assert got == {i: 0 if i < 30 else 30 for i in range(60)}
    assert len(seen) > 2 and not any(seen)


def test_searches_of_many_sources_share_rows(spark, plain):
    """All pairs and closeness cross an edge once for 64 searches; ids that are null or unknown to other edges stay as they were."""
    from graphweft.operators.traversal import reach_levels
    from graphweft.skew import Fanout

    rng = random.Random(11)
    nodes = [i * 37 - 900 for i in range(150)]
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(320)] + [(nodes[3], nodes[4])] * 2
    g = plain(nodes, edges)
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    want = set()
    for s in nodes:
        level, met, depth = {s}, {s}, 0
        while level:
            depth += 1
            level = {b for a in level for b in out.get(a, ())} - met
            met |= level
            want |= {(s, b, depth) for b in level}
    assert rows(traversal.all_pairs(g)) == sorted(want)
    some = spark.createDataFrame([(n,) for n in [*nodes[:3], nodes[0], None, 10**9]], "id long")
    assert rows(traversal.all_pairs(g, some)) == sorted(w for w in want if w[0] in nodes[:3])
    search = reach_levels(Fanout(g.edges.select("src", "dst").distinct()), g.nodes.select("id"))
    # a row for every 64 sources that come to a node at a depth, not for every one
    assert search.masks().count() < len(want) / 2
    assert sorted(tuple(r) for r in search.pairs().where("depth > 0").collect()) == sorted(want)


def test_threshold_counts_directly_where_that_is_cheaper(spark, plain, monkeypatch):
    """Where every neighbour has about as many holders, checking candidates one by one moves a row per pair and neighbour."""
    rng = random.Random(4)
    edges = [(a, 100 + b) for a in range(30) for b in rng.sample(range(20), 12)]
    g = plain([*range(30), *range(100, 120)], edges)
    out = {a: {b for x, b in edges if x == a} for a in range(30)}
    want = {(a, b): len(out[a] & out[b]) / len(out[a] | out[b]) for a, b in itertools.combinations(range(30), 2)}
    want = {k: v for k, v in want.items() if v >= 0.4}
    checked, plainly = [], similarity._shared_counts
    monkeypatch.setattr(similarity, "_shared_counts", lambda *a: checked.append(1) or plainly(*a))
    get = lambda: {(r.a, r.b): r.similarity for r in similarity.node_similarity(g, threshold=0.4).collect()}
    assert get() == pytest.approx(want) and not checked
    monkeypatch.setattr(similarity, "CHECK_COST", 0)
    assert get() == pytest.approx(want) and checked
