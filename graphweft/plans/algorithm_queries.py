"""Graph algorithm queries (G): whole hop, chain and supply graphs."""

from pyspark.sql import functions as F

from ..graph import Graph
from ..operators import centrality, community, components, ranking, similarity, traversal
from .data import CHAIN_SQL, HOP_SQL, chain, hop, supply
from .registry import query

c = F.col


def r(x, name, digits=9):
    return F.round(x, digits).alias(name)


def _unrolled(steps, first, step, last):
    """A chain of materialised CTEs s0 … s<steps>."""
    parts = [f"s0 AS MATERIALIZED ({first})"]
    parts += [f"s{i} AS MATERIALIZED ({step.format(prev=f's{i - 1}')})" for i in range(1, steps + 1)]
    return f"WITH RECURSIVE {HOP_SQL}, outdeg AS (SELECT src, count(*) AS d FROM hop GROUP BY 1), n AS (SELECT count(*) AS n FROM users),\n" + ",\n".join(parts) + "\n" + last.format(final=f"s{steps}")


_PR_STEP = """SELECT id, 0.15 / (SELECT n FROM n) + 0.85 * coalesce(sum(p.score / d), 0) AS score FROM users
 LEFT JOIN hop ON dst = users.id LEFT JOIN {prev} p(pid, score) ON pid = hop.src LEFT JOIN outdeg ON outdeg.src = hop.src GROUP BY id"""
_PR = _unrolled(20, "SELECT id, 1.0 / (SELECT n FROM n) AS score FROM users", _PR_STEP, "SELECT id, round(score, 9) AS score FROM {final}")


@query("g01_pagerank", _PR)
def g01(spark, sf):
    return ranking.pagerank(hop(spark, sf), iterations=20, tolerance=None).select("id", r(c("score"), "score"))


@query("g02_top_pagerank", _PR + " ORDER BY score DESC, id LIMIT 10")
def g02(spark, sf):
    return ranking.top_pagerank(hop(spark, sf), 10, tolerance=None).select("id", r(c("score"), "score"))


_SEEDS = "SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > (SELECT quantile_cont(value, 0.99) FROM events)"
_PPR_STEP = f"""SELECT id, CASE WHEN id IN ({_SEEDS}) THEN 0.15 / (SELECT count(*) FROM ({_SEEDS})) ELSE 0 END + 0.85 * coalesce(sum(p.score / d), 0) AS score FROM users
 LEFT JOIN hop ON dst = users.id LEFT JOIN {{prev}} p(pid, score) ON pid = hop.src LEFT JOIN outdeg ON outdeg.src = hop.src GROUP BY id"""
_PPR = _unrolled(
    20, f"SELECT id, CASE WHEN id IN ({_SEEDS}) THEN 1.0 / (SELECT count(*) FROM ({_SEEDS})) ELSE 0.0 END AS score FROM users", _PPR_STEP,
    "SELECT id, round(score, 9) AS score FROM {final}",
)


@query("g03_personalized_pagerank", _PPR)
def g03(spark, sf):
    from ..functions.aggregates import quantiles
    from .data import table

    events = table(spark, sf, "events")
    high = quantiles(events, [], "value", q=("cont", 0.99)).first().q
    seeds = events.where((c("event_type") == "purchase") & (c("value") > high)).select(c("user_id").alias("id"))
    return ranking.pagerank(hop(spark, sf), iterations=20, tolerance=None, seeds=seeds).select("id", r(c("score"), "score"))


_LP_STEP = """SELECT id, coalesce(max_by(label, (n, -label)), any_value(own)) AS community FROM
 (SELECT users.id AS id, o.community AS own, p.community AS label, count(p.community) AS n FROM users JOIN {prev} o ON o.id = users.id
  LEFT JOIN (SELECT src AS a, dst AS b FROM hop UNION ALL SELECT dst, src FROM hop) e ON e.b = users.id LEFT JOIN {prev} p ON p.id = e.a
  GROUP BY 1, 2, 3) GROUP BY id"""
_LP = _unrolled(10, "SELECT id, id AS community FROM users", _LP_STEP, "SELECT id, community FROM {final}")


@query("g04_label_propagation", _LP)
def g04(spark, sf):
    return community.label_propagation(hop(spark, sf), 10)


@query("g05_communities", f"""
WITH lp AS ({_LP}), top AS (SELECT min(community) AS c FROM lp)
SELECT 'of' AS what, id, community FROM lp WHERE id = (SELECT min(id) FROM lp)
UNION ALL SELECT 'member', id, community FROM lp WHERE community = (SELECT c FROM top)
UNION ALL SELECT 'count', count(DISTINCT community), NULL FROM lp""")
def g05(spark, sf):
    labels = community.label_propagation(hop(spark, sf), 10)
    lowest = labels.agg(F.min("id").alias("id"), F.min("community").alias("c")).first()
    return (
        community.community_of(labels, lowest.id).select(F.lit("of").alias("what"), "id", "community")
        .unionAll(community.community_members(labels, lowest.c).select(F.lit("member"), "id", F.lit(lowest.c)))
        .unionAll(community.community_count(labels).select(F.lit("count"), "communities", F.lit(None).cast("bigint")))
    )


@query("g06_louvain", f"WITH {HOP_SQL} SELECT CAST(count(*) AS BIGINT) AS n, true AS better_than_singletons, true AS canonical FROM users")
def g06(spark, sf):
    g = hop(spark, sf)
    labels, q = community.louvain(g, passes=6)
    alone = community.modularity(g.edges, g.nodes.select("id", c("id").alias("community")))
    groups = labels.groupBy("community").agg(F.min("id").alias("m"))
    canonical = groups.where("m <> community").isEmpty()
    return labels.agg(F.count("*").alias("n"), F.lit(q > alone).alias("better_than_singletons"), F.lit(canonical).alias("canonical"))


@query("g07_degree_centrality", f"""
WITH {HOP_SQL}, i AS (SELECT dst AS id, count(*) AS n FROM hop GROUP BY 1), o AS (SELECT src AS id, count(*) AS n FROM hop GROUP BY 1)
SELECT id, CAST(coalesce(i.n, 0) AS BIGINT) AS in_degree, CAST(coalesce(o.n, 0) AS BIGINT) AS out_degree, CAST(coalesce(i.n, 0) + coalesce(o.n, 0) AS BIGINT) AS degree
FROM users LEFT JOIN i USING (id) LEFT JOIN o USING (id)""")
def g07(spark, sf):
    return centrality.degrees(hop(spark, sf))


@query("g07_degree_supply", """
WITH ends AS (SELECT 'Customer' AS label, o_custkey AS k FROM orders UNION ALL SELECT 'Customer', c_custkey FROM customer
 UNION ALL SELECT 'Part', l_partkey FROM lineitem UNION ALL SELECT 'Part', l_partkey FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)),
d AS (SELECT label, k, count(*) AS n FROM ends GROUP BY 1, 2)
SELECT label, CAST(sum(n) AS BIGINT) AS total, CAST(max(n) AS BIGINT) AS widest FROM d GROUP BY 1""")
def g07_supply(spark, sf):
    g = supply(spark, sf)
    labelled = centrality.degrees(g).join(g.nodes.select("id", c("labels")[0].alias("label")), "id").where(c("label").isin("Customer", "Part"))
    return labelled.groupBy("label").agg(F.sum("degree").alias("total"), F.max("degree").alias("widest"))


def _levels_sql(depth, edges="e", extra=""):
    """Breadth-first levels l0 … l<depth> of all sources with path counts; dist unites them."""
    parts = ["l0 AS MATERIALIZED (SELECT id AS s, id AS v, 1.0::DOUBLE AS sg, 0 AS d FROM users)"]
    for i in range(1, depth + 1):
        seen = " UNION ALL ".join(f"SELECT s, v FROM l{j}" for j in range(i))
        parts.append(
            f"l{i} AS MATERIALIZED (SELECT f.s, g.dst AS v, sum(f.sg)::DOUBLE AS sg, {i} AS d FROM l{i - 1} f JOIN {edges} g ON g.src = f.v "
            f"WHERE NOT EXISTS (SELECT 1 FROM ({seen}) x WHERE x.s = f.s AND x.v = g.dst) GROUP BY f.s, g.dst)"
        )
    parts.append("dist AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM l{j}" for j in range(depth + 1)) + ")")
    return ",\n".join(parts)


_DIRECTED = f"WITH RECURSIVE {HOP_SQL}, e AS MATERIALIZED (SELECT src, dst FROM hop WHERE src <> dst), {_levels_sql(6)}"
_UNDIRECTED = f"WITH RECURSIVE {HOP_SQL}, e AS MATERIALIZED (SELECT src, dst FROM hop WHERE src <> dst UNION SELECT dst, src FROM hop WHERE src <> dst), {_levels_sql(6)}"


@query("g08_betweenness", _DIRECTED + """
SELECT id, round(coalesce(sum(b.score), 0), 6) AS score FROM users LEFT JOIN
 (SELECT sv.v AS v, sv.sg * vt.sg / st.sg AS score FROM dist sv JOIN dist vt ON vt.s = sv.v JOIN dist st ON st.s = sv.s AND st.v = vt.v
  WHERE sv.d > 0 AND vt.d > 0 AND sv.d + vt.d = st.d) b ON b.v = id GROUP BY id""")
def g08(spark, sf):
    return centrality.betweenness(hop(spark, sf)).select("id", r(c("score"), "score", 6))


@query("g09_closeness", _UNDIRECTED + """
SELECT id, round(coalesce(sum(1.0 / d) FILTER (WHERE d > 0), 0) / (SELECT count(*) - 1 FROM users), 9) AS score FROM users JOIN dist ON s = id GROUP BY id""")
def g09(spark, sf):
    return centrality.closeness(hop(spark, sf)).select("id", r(c("score"), "score"))


_EV_STEP = """SELECT id, raw / sqrt(sum(raw * raw) OVER ()) AS score FROM
 (SELECT users.id AS id, coalesce(sum(p.score), 0) AS raw FROM users LEFT JOIN hop ON dst = users.id LEFT JOIN {prev} p ON p.id = hop.src GROUP BY users.id)"""


@query("g10_eigenvector", _unrolled(12, "SELECT id, 1.0 / sqrt((SELECT n FROM n)) AS score FROM users", _EV_STEP, "SELECT id, round(score, 9) AS score FROM {final}"))
def g10(spark, sf):
    return ranking.eigenvector(hop(spark, sf), 12, tolerance=None).select("id", r(c("score"), "score"))


@query("g11_triangles", f"""
WITH {HOP_SQL}, p AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM hop WHERE src <> dst),
t AS MATERIALIZED (SELECT x.a AS a, x.b AS b, y.b AS c FROM p x JOIN p y ON x.b = y.a JOIN p z ON z.a = x.a AND z.b = y.b),
n AS (SELECT id, count(*) AS t FROM (SELECT a AS id FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t) GROUP BY 1),
g AS (SELECT id, count(*) AS d FROM (SELECT a AS id FROM p UNION ALL SELECT b FROM p) GROUP BY 1)
SELECT id, CAST(coalesce(n.t, 0) AS BIGINT) AS triangles, round(CASE WHEN d > 1 THEN 2.0 * coalesce(n.t, 0) / (d * (d - 1)) ELSE 0 END, 9) AS clustering
FROM users LEFT JOIN n USING (id) LEFT JOIN g USING (id)""")
def g11(spark, sf):
    return similarity.triangles(hop(spark, sf)).select("id", "triangles", r(c("clustering"), "clustering"))


@query("g12_wcc_chain", "SELECT event_id AS id, min(event_id) OVER (PARTITION BY user_id) AS component FROM events")
def g12(spark, sf):
    return components.wcc(chain(spark, sf))


@query("g12_wcc_supply", """
SELECT CAST(count(*) AS BIGINT) AS nodes, 1000000000000 AS component FROM (SELECT 1 FROM region UNION ALL SELECT 1 FROM nation
 UNION ALL SELECT 1 FROM customer UNION ALL SELECT 1 FROM supplier UNION ALL SELECT 1 FROM part UNION ALL SELECT 1 FROM orders)""")
def g12_supply(spark, sf):
    # every part is ordered and every nation populated, so the whole graph hangs together
    return components.wcc(supply(spark, sf)).groupBy("component").agg(F.count("*").alias("nodes"))


@query("g13_scc", f"""
WITH RECURSIVE {HOP_SQL}, reach(a, b) AS (SELECT id, id FROM users UNION SELECT reach.a, hop.dst FROM reach JOIN hop ON hop.src = reach.b)
SELECT x.a AS id, min(x.b) AS component FROM reach x JOIN reach y ON y.a = x.b AND y.b = x.a GROUP BY x.a""")
def g13(spark, sf):
    return components.scc(hop(spark, sf))


@query("g13_scc_supply", """
SELECT label, CAST(count(*) AS BIGINT) AS nodes, CAST(count(*) AS BIGINT) AS components FROM (SELECT 'Region' AS label FROM region
 UNION ALL SELECT 'Nation' FROM nation UNION ALL SELECT 'Customer' FROM customer UNION ALL SELECT 'Supplier' FROM supplier
 UNION ALL SELECT 'Part' FROM part UNION ALL SELECT 'Order' FROM orders) GROUP BY 1""")
def g13_supply(spark, sf):
    g = supply(spark, sf)  # no directed cycle, so every node is alone
    found = components.scc(g).join(g.nodes.select("id", c("labels")[0].alias("label")), "id")
    return found.groupBy("label").agg(F.count("*").alias("nodes"), F.count_distinct("component").alias("components"))


_BF_STEP = """SELECT id, min(d) AS d FROM (SELECT id, d FROM {prev} UNION ALL
 SELECT e.dst, p.d + e.w FROM {prev} p JOIN (SELECT src, dst, min(weight)::DOUBLE AS w FROM hop GROUP BY 1, 2) e ON e.src = p.id) GROUP BY id"""
_BF = _unrolled(16, "SELECT min(id) AS id, 0.0::DOUBLE AS d FROM users", _BF_STEP, "SELECT id, d AS distance FROM {final}")


def _ends(g):
    row = g.nodes.agg(F.min("id").alias("a"), F.max("id").alias("b")).first()
    return row.a, row.b


@query("g14_single_source", _BF)
def g14_all(spark, sf):
    g = hop(spark, sf)
    return traversal.single_source(g, _ends(g)[0], "weight").select("id", "distance")


_ONE = f"WITH d AS ({_BF}) SELECT true AS found, distance, true AS path_fits FROM d WHERE id = (SELECT max(id) FROM d)"


def _checked_path(g, found, source, target):
    """The path as edges must start, end and add up right."""
    steps = found.select(F.posexplode("path").alias("i", "src"))
    nxt = steps.select((c("i") - 1).alias("i"), c("src").alias("dst"))
    length = steps.join(nxt, "i").join(g.edges.groupBy("src", "dst").agg(F.min("weight").alias("w")), ["src", "dst"]).agg(F.sum("w").alias("length"), F.count("*").alias("hops"))
    row = length.first()
    ends = (c("path")[0] == source) & (F.element_at("path", -1) == target)
    return found.select("found", "distance", (ends & (c("distance") == row.length) & (F.size("path") == row.hops + 1)).alias("path_fits"))


@query("g14_dijkstra", _ONE)
def g14(spark, sf):
    g = hop(spark, sf)
    a, b = _ends(g)
    return _checked_path(g, traversal.dijkstra(g, a, b, "weight"), a, b)


@query("g15_all_pairs", _DIRECTED + " SELECT s AS source, v AS target, CAST(d AS BIGINT) AS distance FROM dist WHERE d > 0")
def g15(spark, sf):
    return traversal.all_pairs(hop(spark, sf))


@query("g16_astar", _ONE)
def g16(spark, sf):
    g = hop(spark, sf)
    a, b = _ends(g)
    # a plane on which no hop is shorter than the distance of its ends
    placed = Graph(g.nodes.withColumns({"px": c("id") / (b - a + 1.0), "py": F.lit(0.0)}), g.edges)
    return _checked_path(g, traversal.astar(placed, a, b, "px", "py", "weight"), a, b)


def _bfs_sql(levels):
    parts = ["b0 AS MATERIALIZED (SELECT min(id) AS id, 0 AS depth, 0 AS visit FROM users)"]
    for i in range(1, levels + 1):
        seen = " UNION ALL ".join(f"SELECT id FROM b{j}" for j in range(i))
        count = " + ".join(f"(SELECT count(*) FROM b{j})" for j in range(i))
        parts.append(
            f"b{i} AS MATERIALIZED (SELECT id, {i} AS depth, {count} - 1 + row_number() OVER (ORDER BY parent, id) AS visit FROM "
            f"(SELECT hop.dst AS id, min(p.visit) AS parent FROM b{i - 1} p JOIN hop ON hop.src = p.id WHERE hop.dst NOT IN ({seen}) GROUP BY 1))"
        )
    union = " UNION ALL ".join(f"SELECT * FROM b{j}" for j in range(levels + 1))
    return f"WITH {HOP_SQL}, " + ",\n".join(parts) + f" SELECT id, CAST(depth AS BIGINT) AS depth, CAST(visit AS BIGINT) AS visit FROM ({union})"


@query("g17_bfs", _bfs_sql(6))
def g17(spark, sf):
    g = hop(spark, sf)
    return traversal.bfs(g, _ends(g)[0])


@query("g18_dfs_forest", f"""
WITH RECURSIVE {CHAIN_SQL}, walk(id, root, depth) AS (
 SELECT event_id, event_id, 0 FROM events WHERE event_id NOT IN (SELECT dst FROM chain)
 UNION ALL SELECT dst, root, depth + 1 FROM walk JOIN chain ON src = id)
SELECT id, CAST(depth AS BIGINT) AS depth, CAST(row_number() OVER (ORDER BY root, depth) - 1 AS BIGINT) AS visit FROM walk""")
def g18(spark, sf):
    g = chain(spark, sf)
    roots = g.nodes.select("id").join(g.edges.select(c("dst").alias("id")), "id", "left_anti")
    return traversal.dfs_forest(g, roots)


@query("g18_dfs_tree", """
WITH o AS (SELECT o_orderkey, o_custkey FROM orders),
t AS (SELECT r_regionkey + 1000000000000 AS id, 0 AS depth, r_regionkey AS r, -1 AS n, -1 AS c, -1 AS o FROM region
 UNION ALL SELECT n_nationkey + 2000000000000, 1, n_regionkey, n_nationkey, -1, -1 FROM nation
 UNION ALL SELECT c_custkey + 3000000000000, 2, n_regionkey, n_nationkey, c_custkey, -1 FROM customer JOIN nation ON c_nationkey = n_nationkey
 UNION ALL SELECT o_orderkey + 6000000000000, 3, n_regionkey, n_nationkey, c_custkey, o_orderkey FROM o JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)
SELECT id, CAST(depth AS BIGINT) AS depth, CAST(row_number() OVER (ORDER BY r, n, c, o) - 1 AS BIGINT) AS visit FROM t""")
def g18_tree(spark, sf):
    g = supply(spark, sf)
    down = c("type").isin("IN_REGION", "LIVES_IN")
    tree = g.edges.where(down | (c("type") == "PLACED")).select(
        "id", F.when(down, c("dst")).otherwise(c("src")).alias("src"), F.when(down, c("src")).otherwise(c("dst")).alias("dst"), "type"
    )
    roots = g.nodes.where(F.array_contains("labels", "Region")).select("id")
    return traversal.dfs_forest(Graph(g.nodes, tree), roots)


_SIM = f"""
WITH {HOP_SQL}, adj AS MATERIALIZED (SELECT src AS a, dst AS nb FROM hop WHERE src <> dst), sz AS (SELECT a, count(*) AS n FROM adj GROUP BY 1),
sh AS (SELECT x.a AS a, y.a AS b, count(*) AS s FROM adj x JOIN adj y USING (nb) WHERE x.a <> y.a GROUP BY 1, 2),
sim AS MATERIALIZED (SELECT sh.a, sh.b, s / (sa.n + sb.n - s) AS j FROM sh JOIN sz sa ON sa.a = sh.a JOIN sz sb ON sb.a = sh.b)
"""


@query("g19_node_similarity", _SIM + "SELECT a, b, round(j, 9) AS similarity FROM sim WHERE a < b")
def g19(spark, sf):
    return similarity.node_similarity(hop(spark, sf)).select("a", "b", r(c("similarity"), "similarity"))


@query("g19_similarity_threshold", _SIM + "SELECT a, b, round(j, 9) AS similarity FROM sim WHERE a < b AND j >= 0.3")
def g19_threshold(spark, sf):
    return similarity.node_similarity(hop(spark, sf), threshold=0.3).select("a", "b", r(c("similarity"), "similarity"))


@query("g19_similarity_top", _SIM + "SELECT a, b, round(j, 9) AS similarity FROM sim WHERE a < b ORDER BY j DESC, a, b LIMIT 200")
def g19_top(spark, sf):
    return similarity.node_similarity(hop(spark, sf), top_k=200).select("a", "b", r(c("similarity"), "similarity"))


@query("g20_knn_hubs", """
WITH adj AS MATERIALIZED (SELECT DISTINCT user_id + 1000000000 AS a, event_type AS nb FROM events
 UNION SELECT DISTINCT user_id + 1000000000, CAST(CAST(ts AS DATE) AS VARCHAR) FROM events),
sz AS (SELECT a, count(*) AS n FROM adj GROUP BY 1),
sh AS (SELECT x.a AS a, y.a AS b, count(*) AS s FROM adj x JOIN adj y USING (nb) WHERE x.a <> y.a GROUP BY 1, 2),
sim AS (SELECT sh.a, sh.b, s / (sa.n + sb.n - s) AS j FROM sh JOIN sz sa ON sa.a = sh.a JOIN sz sb ON sb.a = sh.b)
SELECT a, b, CAST(rank AS BIGINT) AS rank, round(j, 9) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY j DESC, b) AS rank FROM sim) WHERE rank <= 3""")
def g20_hubs(spark, sf):
    """Users by the kinds and days of their events: few neighbours, each held by very many users."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    user = (c("user_id") + 1_000_000_000).alias("src")
    kinds = events.select(user, F.xxhash64("event_type").alias("dst"))
    days = events.select(user, F.xxhash64(F.to_date("ts").cast("string")).alias("dst"))
    edges = kinds.union(days).distinct().select(F.xxhash64("src", "dst").alias("id"), "src", "dst", F.lit("HAS").alias("type"))
    nodes = edges.select(c("src").alias("id")).union(edges.select("dst")).distinct().select("id", F.array(F.lit("Any")).alias("labels"))
    best = similarity.knn_nodes(Graph(nodes, edges), 3)
    return best.select("a", "b", c("rank").cast("long").alias("rank"), r(c("similarity"), "similarity"))


@query("g19_similarity_pairs", _SIM + """
SELECT src AS a, dst AS b, round(coalesce(j, 0), 9) AS similarity FROM hop LEFT JOIN sim ON sim.a = src AND sim.b = dst WHERE src <> dst""")
def g19_pairs(spark, sf):
    g = hop(spark, sf)
    pairs = g.edges.where("src <> dst").select(c("src").alias("a"), c("dst").alias("b"))
    return similarity.pair_similarity(g, pairs).select("a", "b", r(c("similarity"), "similarity"))


@query("g20_knn", _SIM + """
SELECT a, b, CAST(rank AS BIGINT) AS rank, round(j, 9) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY j DESC, b) AS rank FROM sim) WHERE rank <= 10""")
def g20(spark, sf):
    return similarity.knn_nodes(hop(spark, sf)).select("a", "b", c("rank").cast("long").alias("rank"), r(c("similarity"), "similarity"))
