"""Pattern-matching queries (B)."""

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators.match import exists_pattern, pattern_list, scan_nodes
from ..operators.paths import shortest_paths
from .data import CHAIN_SQL, HOP_SQL, chain, hop, supply, table
from .registry import query

c = F.col


@query("b01_node_scan", """
SELECT 'Party' AS label, CAST(count(*) AS BIGINT) AS n, round(sum(b), 2) AS acctbal FROM
 (SELECT c_acctbal AS b FROM customer UNION ALL SELECT s_acctbal FROM supplier)
UNION ALL SELECT 'Party+Supplier', count(*), round(sum(s_acctbal), 2) FROM supplier
UNION ALL SELECT 'party', 0, NULL""")
def b01(spark, sf):
    g = supply(spark, sf)
    # labels are case-sensitive, so 'party' finds nothing
    scans = [("Party", ["Party"]), ("Party+Supplier", ["Party", "Supplier"]), ("party", ["party"])]
    parts = [
        scan_nodes(g, labels).agg(F.lit(name).alias("label"), F.count("*").alias("n"), F.round(F.sum("acctbal"), 2).alias("acctbal"))
        for name, labels in scans
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("b02_inline_properties", """
SELECT o_orderkey + 6000000000000 AS o_id, o_totalprice AS o_total FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def b02(spark, sf):
    return supply(spark, sf).match().node("o", "Order", status="F", priority="1-URGENT", brand=None).df().select("o_id", "o_total")


@query("b03_hop_right", """
SELECT c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def b03(spark, sf):
    return supply(spark, sf).match().node("c", "Customer").out("LIVES_IN").node("n", "Nation").df().select("c_name", "n_name")


@query("b03_hop_left", """
SELECT o_orderkey + 6000000000000 AS o_id, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def b03_left(spark, sf):
    return supply(spark, sf).match().node("o", "Order").into("PLACED").node("c", "Customer").df().select("o_id", "c_name")


@query("b03_hop_undirected", f"""
WITH {HOP_SQL}, both_ways AS (SELECT src, dst FROM hop UNION ALL SELECT dst, src FROM hop WHERE src <> dst)
SELECT src AS a_id, dst AS b_id, CAST(count(*) AS BIGINT) AS n FROM both_ways GROUP BY 1, 2""")
def b03_both(spark, sf):
    return hop(spark, sf).match().node("a").either("HOP").node("b").df().groupBy("a_id", "b_id").agg(F.count("*").alias("n"))


@query("b04_type_alternatives", """
SELECT kind, n_name, CAST(count(*) AS BIGINT) AS n FROM
 (SELECT 'LIVES_IN' AS kind, c_nationkey AS k FROM customer UNION ALL SELECT 'BASED_IN', s_nationkey FROM supplier)
JOIN nation ON k = n_nationkey GROUP BY 1, 2""")
def b04(spark, sf):
    m = supply(spark, sf).match().node("p", "Party").out(["LIVES_IN", "BASED_IN"], var="r").node("n", "Nation").df()
    return m.groupBy(c("r_type").alias("kind"), "n_name").agg(F.count("*").alias("n"))


@query("b05_multi_hop", """
SELECT r_name, p_brand, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity), 2) AS quantity
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
GROUP BY 1, 2""")
def b05(spark, sf):
    m = (
        supply(spark, sf).match()
        .node("r", "Region").into("IN_REGION").node().into("LIVES_IN").node()
        .out("PLACED").node().out("CONTAINS", var="l").node("p", "Part").df()
    )
    return m.groupBy("r_name", "p_brand").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("b05_unique_edges", f"""
WITH {HOP_SQL}
SELECT e1.src AS a_id, e2.dst AS c_id, CAST(count(*) AS BIGINT) AS n FROM hop e1 JOIN hop e2 ON e1.dst = e2.src
WHERE NOT (e1.src = e2.src AND e1.dst = e2.dst) GROUP BY 1, 2""")
def b05_unique(spark, sf):
    m = hop(spark, sf).match().node("a").out("HOP").node("b").out("HOP").node("c").df()
    return m.groupBy("a_id", "c_id").agg(F.count("*").alias("n"))


@query("b05_edge_properties", """
SELECT p_brand, CAST(count(*) AS BIGINT) AS n FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE l_returnflag = 'R' GROUP BY 1""")
def b05_props(spark, sf):
    m = supply(spark, sf).match().node("o", "Order").out("CONTAINS", flag="R").node("p", "Part").df()
    return m.groupBy("p_brand").agg(F.count("*").alias("n"))


@query("b06_shared_variable", """
WITH s AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
SELECT s_name, CAST(count(*) AS BIGINT) AS n FROM supplier
JOIN nation ON s_nationkey = n_nationkey JOIN customer ON c_nationkey = n_nationkey
JOIN orders ON o_custkey = c_custkey JOIN lineitem l ON l.l_orderkey = o_orderkey
JOIN s ON s.l_partkey = l.l_partkey AND s.l_suppkey = s_suppkey GROUP BY 1""")
def b06(spark, sf):
    # suppliers of parts ordered by customers of the supplier's own nation: a cycle over five hops, which is closed on
    # part and nation together, as the sizes of the hops give it
    m = (
        supply(spark, sf).match()
        .node("c", "Customer").out("PLACED").node("o", "Order").out("CONTAINS").node("p", "Part").into("SUPPLIES").node("s", "Supplier")
        .out("BASED_IN").node("n", "Nation").path().node("c").out("LIVES_IN").node("n").df()
    )
    return m.groupBy("s_name").agg(F.count("*").alias("n"))


@query("b06_loose_parts", """
SELECT r_name, c_name FROM region JOIN (SELECT c_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey) ON n_regionkey <> r_regionkey""")
def b06_loose(spark, sf):
    # every region with the customers who do not live there
    m = supply(spark, sf).match().node("r", "Region").path(on=c("e_dst") != c("r_id")).node("c", "Customer").out("LIVES_IN").node().out("IN_REGION", var="e").node().df()
    return m.select("r_name", "c_name")


@query("b07_optional_match", """
SELECT c_name, CAST(count(o_orderkey) AS BIGINT) AS n, round(sum(o_totalprice), 2) AS total
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' AND o_totalprice > c_acctbal * 20 GROUP BY 1""")
def b07(spark, sf):
    g = supply(spark, sf)
    placed = g.match().node("c", "Customer").out("PLACED").node("o", "Order", status="P")
    m = g.match().node("c", "Customer").optional(placed, where=c("o_total") > c("c_acctbal") * 20).df()
    return m.groupBy("c_name").agg(F.count("o_id").alias("n"), F.round(F.sum("o_total"), 2).alias("total"))


def _chain_sql(low, high, tail):
    return f"""
WITH RECURSIVE {CHAIN_SQL}, walk(start_id, end_id, depth, ids) AS (
  SELECT event_id, event_id, 0, [event_id] FROM events
  UNION ALL
  SELECT start_id, dst, depth + 1, list_append(ids, dst) FROM walk JOIN chain ON src = end_id
  WHERE depth < {high} AND NOT list_contains(ids, dst))
{tail.format(low=low)}"""


@query("b08_varlen_path", _chain_sql(1, 3, """
SELECT CAST(depth AS BIGINT) AS depth, e2.event_type AS b_type, CAST(count(*) AS BIGINT) AS n FROM walk
JOIN events e2 ON e2.event_id = end_id JOIN events e1 ON e1.event_id = start_id
WHERE depth >= {low} AND e1.event_type = 'signup' GROUP BY 1, 2"""))
def b08(spark, sf):
    m = chain(spark, sf).match().node("a", "Event", event_type="signup").out("NEXT", length=(1, 3), path="p").node("b", "Event").df()
    return m.groupBy(c("p_length").cast("long").alias("depth"), c("b_event_type").alias("b_type")).agg(F.count("*").alias("n"))


@query("b08_varlen_zero_reversed", _chain_sql(0, 2, """
SELECT end_id AS a_id, CAST(min(start_id) AS BIGINT) AS first_id, CAST(count(*) AS BIGINT) AS n FROM walk WHERE depth >= {low} GROUP BY 1"""))
def b08_reversed(spark, sf):
    m = chain(spark, sf).match().node("a", "Event").into("NEXT", length=(0, 2), path="p").node("b").df()
    return m.groupBy("a_id").agg(F.min("b_id").alias("first_id"), F.count("*").alias("n"))


@query("b08_varlen_unbounded", """
SELECT r_name, CAST(2 AS BIGINT) AS depth, CAST(count(*) AS BIGINT) AS n FROM region JOIN nation ON n_regionkey = r_regionkey
JOIN customer ON c_nationkey = n_nationkey GROUP BY 1""")
def b08_unbounded(spark, sf):
    m = (
        supply(spark, sf).match().node("c", "Customer")
        .out(["LIVES_IN", "IN_REGION"], length=(1, None), path="p").node("r", "Region").df()
    )
    return m.groupBy("r_name", c("p_length").cast("long").alias("depth")).agg(F.count("*").alias("n"))


@query("b08_reachable", f"""
WITH RECURSIVE {HOP_SQL}, walk AS (
 SELECT src AS a_id, src AS b_id FROM hop WHERE src = dst UNION SELECT a_id, dst FROM walk JOIN hop ON b_id = src)
SELECT a_id, CAST(count(*) AS BIGINT) AS n FROM walk WHERE a_id <> b_id GROUP BY 1""")
def b08_reachable(spark, sf):
    # users with two events in a row, and how many others the hops lead to from them, however long the way is
    m = hop(spark, sf).match().node("a").out("HOP").node("a").path().node("a").out("HOP", length=(1, None)).node("b")
    return m.distinct("a_id", "b_id").groupBy("a_id").agg(F.count("*").alias("n"))


@query("b09_named_path", _chain_sql(3, 3, """
SELECT start_id AS a_id, CAST(depth AS BIGINT) AS len, array_to_string(ids, ',') AS nodes, array_to_string(ids[1:3], ',') AS edges
FROM walk WHERE depth = {low}"""))
def b09(spark, sf):
    m = chain(spark, sf).match().node("a", "Event").out("NEXT", length=3, path="p").node("b").df()
    joined = lambda ids: F.array_join(ids.cast("array<string>"), ",")
    return m.select(
        "a_id", c("p_length").cast("long").alias("len"), joined(c("p_node_ids")).alias("nodes"), joined(c("p_edge_ids")).alias("edges")
    )


_SHORT_SQL = f"""
WITH RECURSIVE {HOP_SQL},
l1 AS MATERIALIZED (SELECT src AS s, dst AS e, 1 AS d, [src, dst] AS ids FROM hop WHERE src <> dst),
l2 AS MATERIALIZED (SELECT a.s, h.dst AS e, 2 AS d, list_append(a.ids, h.dst) AS ids FROM l1 a JOIN hop h ON h.src = a.e
  WHERE h.dst <> a.s AND (a.s, h.dst) NOT IN (SELECT (s, e) FROM l1)),
l3 AS MATERIALIZED (SELECT a.s, h.dst AS e, 3 AS d, list_append(a.ids, h.dst) AS ids FROM l2 a JOIN hop h ON h.src = a.e
  WHERE h.dst <> a.s AND (a.s, h.dst) NOT IN (SELECT (s, e) FROM l1 UNION ALL SELECT (s, e) FROM l2)),
l4 AS MATERIALIZED (SELECT a.s, h.dst AS e, 4 AS d, list_append(a.ids, h.dst) AS ids FROM l3 a JOIN hop h ON h.src = a.e
  WHERE h.dst <> a.s AND (a.s, h.dst) NOT IN (SELECT (s, e) FROM l1 UNION ALL SELECT (s, e) FROM l2 UNION ALL SELECT (s, e) FROM l3)),
sp AS (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3 UNION ALL SELECT * FROM l4)
"""


@query("b10_shortest_path", _SHORT_SQL + """
SELECT s AS a_id, e AS b_id, CAST(d AS BIGINT) AS depth, array_to_string(min(ids), ',') AS nodes FROM sp GROUP BY 1, 2, 3""")
def b10(spark, sf):
    g = hop(spark, sf)
    p = shortest_paths(g.edges, g.nodes.select("id"))
    return p.select(
        c("start").alias("a_id"), c("end").alias("b_id"), c("depth").cast("long").alias("depth"),
        F.array_join(c("node_ids").cast("array<string>"), ",").alias("nodes"),
    )


@query("b10_all_shortest_paths", _SHORT_SQL + """
SELECT s AS a_id, e AS b_id, CAST(d AS BIGINT) AS depth, CAST(count(*) AS BIGINT) AS n FROM sp GROUP BY 1, 2, 3""")
def b10_all(spark, sf):
    g = hop(spark, sf)
    p = shortest_paths(g.edges, g.nodes.select("id"), all_ties=True)
    return p.groupBy(c("start").alias("a_id"), c("end").alias("b_id"), c("depth").cast("long").alias("depth")).agg(F.count("*").alias("n"))


@query("b11_exists_pattern", """
SELECT c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def b11(spark, sf):
    g = supply(spark, sf)
    rows = g.match().node("c", "Customer").df()
    return exists_pattern(rows, g.match().node("c").out("PLACED").node("o", "Order", priority="1-URGENT"), ["c"]).select("c_name")


@query("b11_not_exists_pattern", """
SELECT p_partkey + 5000000000000 AS p_id FROM part WHERE NOT EXISTS
 (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 45)""")
def b11_not(spark, sf):
    g = supply(spark, sf)
    heavy = g.match().node("p").into("CONTAINS", var="l", flag="R").node().where(c("l_quantity") > 45)
    return exists_pattern(g.match().node("p", "Part").df(), heavy, ["p"], negate=True).select("p_id")


@query("b12_exists_property", """
SELECT 'Customer' AS label, (SELECT count(*) FROM customer WHERE c_acctbal IS NOT NULL) AS n
UNION ALL SELECT 'Supplier', (SELECT count(*) FROM supplier WHERE s_acctbal IS NOT NULL)""")
def b12(spark, sf):
    m = supply(spark, sf).match().node("n").where(c("n_acctbal").isNotNull()).df()
    return m.groupBy(c("n_labels")[0].alias("label")).agg(F.count("*").alias("n"))


@query("b13_label_predicate", """
SELECT true AS is_customer, CAST(count(*) AS BIGINT) AS n FROM customer UNION ALL SELECT false, count(*) FROM supplier""")
def b13(spark, sf):
    m = supply(spark, sf).match().node("n", "Party").df()
    return m.groupBy(F.array_contains("n_labels", "Customer").alias("is_customer")).agg(F.count("*").alias("n"))


@query("b14_from_graph", f"""
WITH {HOP_SQL} SELECT 'hop' AS graph, CAST(count(*) AS BIGINT) AS n FROM hop
UNION ALL SELECT 'supply', count(*) FROM orders""")
def b14(spark, sf):
    graphs = {g.name: g for g in (supply(spark, sf), hop(spark, sf))}
    a = graphs["hop"].match().node("a").out("HOP").node("b").df().agg(F.lit("hop").alias("graph"), F.count("*").alias("n"))
    b = graphs["supply"].match().node("a").out("PLACED").node("b").df().agg(F.lit("supply").alias("graph"), F.count("*").alias("n"))
    return a.unionAll(b)


@query("b15_comparison_logic", """
SELECT o_orderkey + 6000000000000 AS o_id,
 (o_totalprice >= 250000) AND NOT (o_orderstatus = 'F') AS a,
 (o_totalprice < 100000) OR (o_orderstatus <> 'O') AS b,
 (o_totalprice > 200000) <> (o_orderpriority = '5-LOW') AS c,
 (o_totalprice <= 300000) AND CAST(NULL AS BOOLEAN) AS d FROM orders""")
def b15(spark, sf):
    m = supply(spark, sf).match().node("o", "Order").df()
    total, status = c("o_total"), c("o_status")
    return m.select(
        "o_id",
        ((total >= 250000) & ~(status == "F")).alias("a"),
        ((total < 100000) | (status != "O")).alias("b"),
        X.xor(total > 200000, c("o_priority") == "5-LOW").alias("c"),
        ((total <= 300000) & F.lit(None).cast("boolean")).alias("d"),
    )


@query("b16_arithmetic", """
SELECT p_partkey + 5000000000000 AS p_id, CAST(-p_size + 7 AS BIGINT) AS a, round(p_retailprice * 2 - p_size, 6) AS b,
 CAST((p_size - 25) // 4 AS BIGINT) + CASE WHEN p_size - 25 < 0 AND (p_size - 25) % 4 <> 0 AND ((p_size - 25) // 4) * 4 <> p_size - 25
   AND (p_size - 25) // 4 < (p_size - 25) / 4.0 THEN 1 ELSE 0 END AS quotient,
 CAST((p_size - 25) % 4 AS BIGINT) AS remainder, round(p_retailprice / p_size, 6) AS ratio FROM part""")
def b16(spark, sf):
    m = supply(spark, sf).match().node("p", "Part").df()
    shifted = c("p_size") - 25
    return m.select(
        "p_id", (-c("p_size") + 7).cast("long").alias("a"), F.round(c("p_price") * 2 - c("p_size"), 6).alias("b"),
        X.int_divide(shifted, F.lit(4)).alias("quotient"), X.modulo(shifted, F.lit(4)).cast("long").alias("remainder"),
        F.round(c("p_price") / c("p_size"), 6).alias("ratio"),
    )


@query("b17_string_concat", "SELECT c_name || '@' || c_mktsegment || '/' || CAST(c_nationkey AS VARCHAR) AS s FROM customer")
def b17(spark, sf):
    m = supply(spark, sf).match().node("c", "Customer").out("LIVES_IN", var="r").node().df()
    return m.select(X.concat_text(c("c_name"), F.lit("@"), c("c_segment"), F.lit("/"), c("r_dst") - F.lit(2 * 10**12)).alias("s"))


@query("b18_in_list", """
SELECT c_name, c_mktsegment AS c_segment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def b18(spark, sf):
    m = supply(spark, sf).match().node("c", "Customer").where(c("c_segment").isin("BUILDING", "MACHINERY")).df()
    return m.select("c_name", "c_segment")


@query("b19_text_predicates", """
SELECT c_name, starts_with(c_mktsegment, 'B') AS s, ends_with(c_mktsegment, 'Y') AS e, contains(c_name, '7_') AS u,
 contains(c_name, '77') AS k, starts_with(c_mktsegment, 'b') AS lower FROM customer""")
def b19(spark, sf):
    m = supply(spark, sf).match().node("c", "Customer").df()
    seg, name = c("c_segment"), c("c_name")
    return m.select(
        "c_name", seg.startswith("B").alias("s"), seg.endswith("Y").alias("e"), name.contains("7_").alias("u"),
        name.contains("77").alias("k"), seg.startswith("b").alias("lower"),
    )


@query("b20_regex", """
SELECT doc_id, regexp_matches(text, '(?i)licen[sc]e') AS licence, regexp_matches(text, '[0-9]{3}-[0-9]{2,4}') AS digits FROM documents""")
def b20(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(
        "doc_id", X.regex_match(c("text"), "(?i)licen[sc]e").alias("licence"),
        X.regex_match(c("text"), "[0-9]{3}-[0-9]{2,4}").alias("digits"),
    )


@query("b21_is_null", """
SELECT doc_id, quality IS NULL AS unlabelled, quality IS NOT NULL AS labelled FROM documents LEFT JOIN labels USING (doc_id)""")
def b21(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", c("quality").isNull().alias("unlabelled"), c("quality").isNotNull().alias("labelled"))


@query("b22_property_access", """
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, event_type AS kind FROM events""")
def b22(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        F.variant_get(F.parse_json("props"), "$.k", "long").alias("k"),
        F.struct("event_type", "value")["event_type"].alias("kind"),
    )


@query("b23_map_projection", """
SELECT c_name || '|' || c_mktsegment || '|' || n_name || '|' || CAST(length(n_name) AS VARCHAR) AS m FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def b23(spark, sf):
    m = supply(spark, sf).match().node("c", "Customer").out("LIVES_IN").node("n", "Nation").df()
    projected = m.select(X.map_projection("c", ["name", "segment"], nation=c("n_name"), size=F.length("n_name")).alias("m"))
    return projected.select(F.concat_ws("|", "m.name", "m.segment", "m.nation", "m.size").alias("m"))


@query("b24_case", """
SELECT o_orderkey + 6000000000000 AS o_id, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS simple,
 CASE WHEN o_totalprice > 300000 THEN 'A' WHEN o_totalprice > 150000 THEN 'B' END AS searched FROM orders""")
def b24(spark, sf):
    m = supply(spark, sf).match().node("o", "Order").df()
    simple = F.when(c("o_status") == "F", "finished").when(c("o_status") == "O", "open").otherwise("other")
    searched = F.when(c("o_total") > 300000, "A").when(c("o_total") > 150000, "B")
    return m.select("o_id", simple.alias("simple"), searched.alias("searched"))


_WORDS_SQL = "SELECT doc_id, string_split(text, ' ') AS w FROM documents"


def _words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("w"))


@query("b25_list_index_slice", f"""
SELECT doc_id, w[1] AS first, w[-2] AS before_last, w[1000000] AS outside, array_to_string(w[2:3], ' ') AS part,
 array_to_string(w[-2:], ' ') AS ending FROM ({_WORDS_SQL})""")
def b25(spark, sf):
    w = c("w")
    return _words(spark, sf).select(
        "doc_id", X.list_item(w, 0).alias("first"), X.list_item(w, -2).alias("before_last"), X.list_item(w, 999_999).alias("outside"),
        F.array_join(X.list_slice(w, 1, 3), " ").alias("part"), F.array_join(X.list_slice(w, -2), " ").alias("ending"),
    )


@query("b26_list_comprehension", f"""
SELECT doc_id, md5(array_to_string(list_transform(list_filter(w, lambda x: length(x) > 8), lambda x: x || '!'), ' ')) AS long_words FROM ({_WORDS_SQL})""")
def b26(spark, sf):
    words = X.comprehension(c("w"), lambda x: F.length(x) > 8, lambda x: F.concat(x, F.lit("!")))
    return _words(spark, sf).select("doc_id", F.md5(F.array_join(words, " ")).alias("long_words"))


@query("b27_pattern_comprehension", """
SELECT c_name, coalesce(array_to_string(list_sort(list(o_orderkey + 6000000000000) FILTER (WHERE o_totalprice > 200000)), ','), '') AS big_orders
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name""")
def b27(spark, sf):
    g = supply(spark, sf)
    pattern = g.match().node("c").out("PLACED").node("o", "Order")
    rows = pattern_list(g.match().node("c", "Customer").df(), pattern, "c", c("o_id"), "ids", where=c("o_total") > 200000)
    return rows.select("c_name", F.array_join(c("ids").cast("array<string>"), ",").alias("big_orders"))


@query("b28_quantifiers", f"""
SELECT doc_id, len(list_filter(w, lambda x: length(x) < 25)) = len(w) AS all_short, len(list_filter(w, lambda x: contains(x, '@'))) > 0 AS any_at,
 len(list_filter(w, lambda x: contains(x, '%'))) = 0 AS none_percent, len(list_filter(w, lambda x: x = 'la')) = 1 AS single_la FROM ({_WORDS_SQL})""")
def b28(spark, sf):
    w = c("w")
    return _words(spark, sf).select(
        "doc_id", X.all_of(w, lambda x: F.length(x) < 25).alias("all_short"), X.any_of(w, lambda x: F.contains(x, F.lit("@"))).alias("any_at"),
        X.none_of(w, lambda x: F.contains(x, F.lit("%"))).alias("none_percent"), X.single_of(w, lambda x: x == "la").alias("single_la"),
    )


@query("b29_reduce", f"""
SELECT doc_id, CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT) AS letters FROM ({_WORDS_SQL})""")
def b29(spark, sf):
    total = X.reduce_list(c("w"), F.lit(0).cast("long"), lambda acc, x: acc + F.length(x))
    return _words(spark, sf).select("doc_id", total.alias("letters"))


@query("b30_parameters", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice BETWEEN 1000.5 AND 99999.25""")
def b30(spark, sf):
    params = {"status": "O", "low": 1000.5, "high": 99999.25}
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = :status AND o_totalprice BETWEEN :low AND :high",
        args=params, orders=table(spark, sf, "orders"),
    )
