"""Graph update (D), streaming (K) and user-function (L) queries."""

import pandas as pd
from pyspark.sql import functions as F

from ..functions import udf as U
from ..graph import Graph, number_edges
from ..operators import clauses as K
from ..operators import mutate as D
from ..operators import sync
from ..session import new_folder
from ..streaming import feeds
from .data import CUSTOMER, ORDER, PART, supply, table
from .registry import query
from .table_queries import ORDERS_B, orders_b
from .vector_queries import _CENTRES, label_centres

c = F.col
_MAX = f"(SELECT max(o_orderkey) + {ORDER} FROM orders)"


def customers(spark, sf):
    """Customers and their orders, with PLACED edges."""
    g = supply(spark, sf)
    keep = F.array_contains("labels", "Customer") | F.array_contains("labels", "Order")
    props = ["name", "acctbal", "segment", "status", "total"]
    return Graph(g.nodes.where(keep).select("id", "labels", *props), g.edges.where("type = 'PLACED'").select("id", "src", "dst", "type"), "customers")


@query("d01_create_nodes", f"""
SELECT {_MAX} + row_number() OVER (ORDER BY s_suppkey) AS id, s_name AS name, s_acctbal AS acctbal, 'Vendor' AS label FROM supplier""")
def d01(spark, sf):
    g = D.create_nodes(customers(spark, sf), table(spark, sf, "supplier"), "Vendor", ["s_suppkey"], name=c("s_name"), acctbal=c("s_acctbal"))
    return g.nodes.where(F.array_contains("labels", "Vendor")).select("id", "name", "acctbal", c("labels")[0].alias("label"))


@query("d01_create_paths", """
SELECT c_name AS a, n_name AS b, 'IN' AS type, c_custkey AS pos FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT n_name, c_name, 'HAS', c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def d01_paths(spark, sf):
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), c("c_nationkey") == c("n_nationkey"))
    g = D.create_paths(
        customers(spark, sf), rows,
        {"a": ("Spot", {"name": c("c_name")}), "b": ("Spot", {"name": c("n_name")})},
        [("a", "IN", "b", {"pos": c("c_custkey")}), ("b", "HAS", "a", {"pos": c("c_custkey")})], ["c_custkey"],
    )
    m = g.match().node("a", "Spot").out(["IN", "HAS"], var="r").node("b", "Spot").df()
    return m.select(c("a_name").alias("a"), c("b_name").alias("b"), c("r_type").alias("type"), c("r_pos").alias("pos"))


@query("d02_match_create", f"""
SELECT o_custkey + {CUSTOMER} AS src, o_orderkey + {ORDER} AS dst, o_totalprice AS amount,
 CAST((SELECT max(o_orderkey) + 4000000000000 FROM orders) + row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS id
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000""")
def d02(spark, sf):
    g = customers(spark, sf)
    big = g.match().node("c", "Customer").out("PLACED").node("o", "Order", status="F").where(c("o_total") > 300000).df()
    g = D.create_edges(g, big, "c_id", "o_id", "BIG", ["o_id"], amount=c("o_total"))
    return g.edges.where("type = 'BIG'").select("id", "src", "dst", "amount")


@query("d03_merge_nodes", f"""
WITH r AS (SELECT DISTINCT 'Customer#' || right(s_name, 9) AS name, s_acctbal FROM supplier UNION SELECT s_name, s_acctbal FROM supplier)
SELECT name, acctbal, state FROM (SELECT c_name AS name, c_acctbal AS acctbal, CASE WHEN c_name IN (SELECT name FROM r) THEN 'matched' END AS state FROM customer
UNION ALL SELECT name, s_acctbal, 'created' FROM r WHERE name NOT IN (SELECT c_name FROM customer))""")
def d03(spark, sf):
    s = table(spark, sf, "supplier")
    rows = s.select(F.concat(F.lit("Customer#"), F.right("s_name", F.lit(9))).alias("name"), "s_acctbal").unionAll(s.select(c("s_name").alias("name"), "s_acctbal"))
    g = D.merge_nodes(
        customers(spark, sf), rows, "Customer", ["name"],
        on_create={"acctbal": c("s_acctbal"), "state": F.lit("created")}, on_match={"state": F.lit("matched")},
    )
    return g.nodes.where(F.array_contains("labels", "Customer")).select("name", "acctbal", "state")


@query("d04_merge_edges", f"""
WITH w AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem), old AS (SELECT s, p FROM w JOIN supplier ON s = s_suppkey WHERE s_acctbal > 5000)
SELECT s + 4000000000000 AS src, p + 5000000000000 AS dst, CASE WHEN (s, p) IN (SELECT (s, p) FROM old) THEN 'seen' ELSE 'new' END AS state FROM w""")
def d04(spark, sf):
    g = supply(spark, sf)
    rich = g.nodes.where("acctbal > 5000").select(c("id").alias("src"))
    stored = g.edges.where("type = 'SUPPLIES'").join(rich, "src", "left_semi").select("id", "src", "dst", "type")
    lines = table(spark, sf, "lineitem").select((c("l_suppkey") + F.lit(4 * 10**12)).alias("src"), (c("l_partkey") + F.lit(5 * 10**12)).alias("dst"))
    merged = D.merge_edges(Graph(g.nodes, stored), lines, "SUPPLIES", on_create={"state": F.lit("new")}, on_match={"state": F.lit("seen")})
    return merged.edges.select("src", "dst", "state")


@query("d05_set_property", """
SELECT c_name AS name, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) THEN c_acctbal + 1000 ELSE c_acctbal END AS acctbal,
 CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) THEN NULL ELSE c_mktsegment END AS segment,
 CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) THEN true END AS vip FROM customer""")
def d05(spark, sf):
    g = customers(spark, sf)
    m = g.match().node("c", "Customer").out("PLACED").node("o", "Order").where(c("o_total") > 450000).df()
    g = D.set_props(g, m.withColumnRenamed("c_id", "id"), acctbal=c("c_acctbal") + 1000, segment=F.lit(None).cast("string"), vip=F.lit(True))
    return g.nodes.where(F.array_contains("labels", "Customer")).select("name", "acctbal", "segment", "vip")


@query("d06_set_map", """
SELECT c_custkey + 3000000000000 AS id, CASE WHEN c_acctbal < 0 THEN upper(c_name) ELSE c_name END AS name,
 CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS acctbal, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal > 9000 THEN 'TOP' ELSE c_mktsegment END AS segment FROM customer""")
def d06(spark, sf):
    g = customers(spark, sf)
    poor, rich = g.nodes.where("acctbal < 0"), g.nodes.where("acctbal > 9000")
    g = D.set_map(g, rich, {"segment": F.lit("TOP")}, replace=False)
    g = D.set_map(g, poor, {"name": F.upper("name")}, replace=True)
    return g.nodes.where(F.array_contains("labels", "Customer")).select("id", "name", "acctbal", "segment")


@query("d06_set_edge_map", """
SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS quantity, l_extendedprice AS amount,
 CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_quantity > 40 THEN 'BULK' ELSE l_returnflag END AS flag FROM lineitem""")
def d06_edges(spark, sf):
    g = supply(spark, sf)
    lines = g.edges.where("type = 'CONTAINS'")
    g = D.set_edge_map(g, lines.where("quantity > 40"), {"flag": F.lit("BULK")}, replace=False)
    g = D.set_edge_map(g, lines.where("flag = 'R'"), {"amount": c("amount")}, replace=True)
    return g.edges.where("type = 'CONTAINS'").select((c("src") - ORDER).alias("l_orderkey"), (c("dst") - PART).alias("l_partkey"), "quantity", "amount", "flag")


@query("d07_add_label", """
SELECT 'Customer,Party' || CASE WHEN c_acctbal > 5000 THEN ',Rich' ELSE '' END AS labels, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 1
UNION ALL SELECT 'Order', count(*) FROM orders""")
def d07(spark, sf):
    g = customers(spark, sf)
    once = D.add_label(g, g.nodes.where("acctbal > 5000"), "Rich")
    twice = D.add_label(once, g.nodes.where("acctbal > 8000"), "Rich")  # a label is never doubled
    return twice.nodes.groupBy(F.array_join("labels", ",").alias("labels")).agg(F.count("*").alias("n"))


@query("d08_remove", """
SELECT c_name AS name, CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_mktsegment END AS segment, c_mktsegment <> 'BUILDING' AS is_party FROM customer""")
def d08(spark, sf):
    g = customers(spark, sf)
    g = D.remove_label(g, g.nodes.where("segment = 'BUILDING'"), "Party")
    g = D.remove_props(g, g.nodes.where("acctbal < 1000"), "segment")
    return g.nodes.where(F.array_contains("labels", "Customer")).select("name", "segment", F.array_contains("labels", "Party").alias("is_party"))


@query("d08_remove_edge", """
SELECT l_orderkey, l_partkey, CASE WHEN l_quantity < 5 THEN NULL ELSE l_extendedprice END AS amount, l_returnflag AS flag FROM lineitem""")
def d08_edges(spark, sf):
    g = supply(spark, sf)
    g = D.remove_edge_props(g, g.edges.where("type = 'CONTAINS' and quantity < 5"), "amount")
    return g.edges.where("type = 'CONTAINS'").select((c("src") - ORDER).alias("l_orderkey"), (c("dst") - PART).alias("l_partkey"), "amount", "flag")


@query("d09_detach_delete", """
SELECT 'nodes' AS what, (SELECT count(*) FROM customer WHERE c_acctbal >= 0) + (SELECT count(*) FROM orders) AS n
UNION ALL SELECT 'edges', (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0)
UNION ALL SELECT 'edges_left', (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0 AND o_orderstatus <> 'F')
UNION ALL SELECT 'refused', 1""")
def d09(spark, sf):
    g = customers(spark, sf)
    poor = g.nodes.where("acctbal < 0").select("id")
    try:
        D.delete_nodes(g, poor)
        refused = 0
    except ValueError:
        refused = 1
    left = D.delete_nodes(g, poor, detach=True)
    finished = left.match().node().out("PLACED", var="r").node("o", "Order", status="F").df().select(c("r_id").alias("id"))
    fewer = D.delete_edges(left, finished)
    count = lambda df, name: df.agg(F.lit(name).alias("what"), F.count("*").alias("n"))
    return (
        count(left.nodes, "nodes").unionAll(count(left.edges, "edges")).unionAll(count(fewer.edges, "edges_left"))
        .unionAll(left.nodes.agg(F.lit("refused"), F.lit(refused).cast("long")))
    )


@query("d10_unwind_create", """
SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM conversations""")
def d10(spark, sf):
    words = table(spark, sf, "conversations").select(F.explode(F.split("text", " ")).alias("name"))
    g = D.merge_nodes(customers(spark, sf), words, "Word", ["name"])
    return g.nodes.where(F.array_contains("labels", "Word")).select(c("name").alias("word"))


@query("d11_merge_then_match", """
WITH pair AS (SELECT DISTINCT o_custkey AS k, o_orderstatus AS s FROM orders)
SELECT s AS status, CAST(count(*) AS BIGINT) AS n, round(sum(c_acctbal), 2) AS money FROM pair JOIN customer ON c_custkey = k GROUP BY 1""")
def d11(spark, sf):
    g = customers(spark, sf)
    orders = g.match().node("c", "Customer").out("PLACED").node("o", "Order").df()

    def merge(graph):
        named = D.merge_nodes(graph, orders.select(c("o_status").alias("name")), "Status", ["name"])
        status = named.nodes.where(F.array_contains("labels", "Status")).select(c("id").alias("dst"), c("name").alias("o_status"))
        return D.merge_edges(named, orders.select(c("c_id").alias("src"), "o_status").join(status, "o_status").select("src", "dst"), "HAS_STATUS")

    def read(graph):
        m = graph.match().node("c", "Customer").out("HAS_STATUS").node("s", "Status").df()
        return m.groupBy(c("s_name").alias("status")).agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("money"))

    return D.merge_then(g, merge, read)[1]


@query("d12_mutation_stats", """
SELECT (SELECT count(*) FROM supplier) AS nodes_created, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS nodes_deleted,
 CAST(0 AS BIGINT) AS edges_created, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0) AS edges_deleted,
 (SELECT count(*) FROM customer WHERE c_acctbal > 9000 AND c_mktsegment <> 'TOP') AS properties_set""")
def d12(spark, sf):
    g = customers(spark, sf)
    after = D.delete_nodes(g, g.nodes.where("acctbal < 0"), detach=True)
    after = D.set_map(after, g.nodes.where("acctbal > 9000"), {"segment": F.lit("TOP")}, replace=False)
    after = D.create_nodes(after, table(spark, sf, "supplier"), "Vendor", ["s_suppkey"], name=c("s_name"))
    return D.mutation_stats(g, after)


@query("d12_edge_statistics", """
SELECT CAST(0 AS BIGINT) AS nodes_created, CAST(0 AS BIGINT) AS nodes_deleted, CAST(0 AS BIGINT) AS edges_created, (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS edges_deleted,
 (SELECT count(*) FROM lineitem WHERE l_returnflag = 'A') * 2 AS properties_set""")
def d12_edges(spark, sf):
    """Of the lines of all orders one kind goes; another gets a new flag and a property not seen before."""
    lines = number_edges(supply(spark, sf).edges.where("type = 'CONTAINS'").select("src", "dst", "type", "quantity", "amount", "flag"), ["src", "dst", "quantity", "amount", "flag"])
    g = Graph(supply(spark, sf).nodes, lines)
    after = D.delete_edges(g, g.edges.where("flag = 'R'"))
    after = D.set_edge_props(after, g.edges.where("flag = 'A'"), flag=F.lit("X"), checked=F.lit(True))
    return D.mutation_stats(g, after)


@query("c12_foreach_updates", f"""
WITH v AS (SELECT c_custkey + {CUSTOMER} AS src, k, row_number() OVER (ORDER BY c_custkey, k) AS n FROM customer, (SELECT unnest([1, 2]) AS k))
SELECT CAST((SELECT max(o_orderkey) + 4000000000000 FROM orders) + n AS BIGINT) AS id, src, CAST({_MAX} + n AS BIGINT) AS dst, k,
 CAST(2 AS INT) AS visits FROM v""")
def c12_updates(spark, sf):
    """FOREACH that creates nodes, one that creates edges to them, and one that sets a property of the matched nodes."""
    g = customers(spark, sf)
    rows = g.match().node("a", "Customer").df().select("a_id")
    both = F.array(F.lit(1), F.lit(2))
    g = K.foreach(g, rows, both, "k", lambda graph, each: D.create_nodes(graph, each, "Visit", ["a_id", "k"], visitor=c("a_id"), k=c("k")))
    made = g.match().node("v", "Visit").df().select(c("v_id").alias("visit"), c("v_visitor").alias("visitor"), "v_k")
    g = K.foreach(g, made, F.array("v_k"), "k", lambda graph, each: D.create_edges(graph, each, "visitor", "visit", "MADE", ["visit"], k=c("k")))
    g = K.foreach(g, rows, F.array(F.size(both)), "n", lambda graph, each: D.set_props(graph, each.select(c("a_id").alias("id"), "n"), visits=c("n")))
    m = g.match().node("a", "Customer").out("MADE", var="r").node("b", "Visit").df()
    return m.select(c("r_id").alias("id"), c("a_id").alias("src"), c("b_id").alias("dst"), c("r_k").alias("k"), c("a_visits").alias("visits"))


# -- K ---------------------------------------------------------------------------------------
def _as_stream(spark, df, files=4):
    """The rows as files that arrive one by one."""
    path = new_folder(spark, "feed")
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("k01_change_feed", f"WITH {ORDERS_B} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM b")
def k01(spark, sf):
    a, b = table(spark, sf, "orders"), orders_b(spark, sf)
    changes = sync.diff(a, b, ["o_orderkey"])
    values = F.coalesce("new", "old")
    final = changes.select("op", F.lit(2).cast("long").alias("seq"), "o_orderkey", values["o_custkey"].alias("o_custkey"),
                           values["o_orderstatus"].alias("o_orderstatus"), values["o_totalprice"].alias("o_totalprice"),
                           values["o_orderdate"].alias("o_orderdate"), values["o_orderpriority"].alias("o_orderpriority"))
    # an earlier change of every touched row that must lose, whatever the order of arrival
    stale = final.withColumns({"op": F.lit("UPDATE"), "seq": F.lit(1).cast("long"), "o_orderstatus": F.lit("?")})
    feed = feeds.FeedTable(spark, new_folder(spark, "table"), ["o_orderkey"], a)
    feeds.run_available(_as_stream(spark, final.unionByName(stale)), feed.apply, new_folder(spark, "progress"))
    return feed.table()


@query("k02_streaming_vectors", f"WITH {_CENTRES} SELECT vec_id, CAST(cell AS BIGINT) AS cell FROM cells")
def k02(spark, sf):
    centres = label_centres(spark, sf)
    folder = new_folder(spark, "cells")
    feeds.ingest_vectors(_as_stream(spark, table(spark, sf, "embeddings")), centres, folder, new_folder(spark, "progress"))
    return spark.read.parquet(folder).select("vec_id", c("cell").cast("long").alias("cell"))


@query("k03_streaming_edges", """
WITH w AS (SELECT DISTINCT l_suppkey + 4000000000000 AS s, l_partkey + 5000000000000 AS p FROM lineitem)
SELECT id, CAST(count(*) AS BIGINT) AS degree FROM (SELECT s AS id FROM w UNION ALL SELECT p FROM w) GROUP BY 1""")
def k03(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        (c("l_suppkey") + F.lit(4 * 10**12)).alias("src"), (c("l_partkey") + F.lit(5 * 10**12)).alias("dst")
    )
    merger = feeds.EdgeMerger(spark, new_folder(spark, "edges"))
    feeds.run_available(_as_stream(spark, lines), merger.apply, new_folder(spark, "progress"))
    return merger.degrees()


# -- L ---------------------------------------------------------------------------------------
@query("l01_scalar_udf", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity + l_tax * 100 + 10, 6) AS s FROM lineitem")
def l01(spark, sf):
    U.register_scalar(spark, "add_up", lambda extra, a, b: a + b * 100 + extra, "double", user_data=10)
    return spark.sql("SELECT l_orderkey, l_linenumber, l_partkey, round(add_up(l_quantity, l_tax), 6) AS s FROM {lines}", lines=table(spark, sf, "lineitem"))


@query("l02_aggregate_udf", """
SELECT l_returnflag AS flag, round(avg((l_quantity - l_discount * 100) ** 2), 4) AS udf, round(avg((l_quantity - l_discount * 100) ** 2), 4) AS native FROM lineitem GROUP BY 1""")
def l02(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", (c("l_discount") * 100).alias("d"))

    def step(state, rows: pd.DataFrame):
        return state[0] + float(((rows["l_quantity"] - rows["d"]) ** 2).sum()), state[1] + len(rows)

    udf = U.aggregate(lines, ["l_returnflag"], lambda: (0.0, 0), step, lambda x, y: (x[0] + y[0], x[1] + y[1]), lambda s: s[0] / s[1], "udf")
    native = lines.groupBy("l_returnflag").agg(U.mean_squared_difference(c("l_quantity"), c("d")).alias("native"))
    return udf.join(native, "l_returnflag").select(c("l_returnflag").alias("flag"), F.round("udf", 4).alias("udf"), F.round("native", 4).alias("native"))


@query("l03_collation", """
SELECT lower(p_brand) AS brand, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1""")
def l03(spark, sf):
    mixed = table(spark, sf, "part").select(F.when(c("p_size") > 25, F.upper("p_brand")).otherwise(c("p_brand")).alias("b"))
    grouped = mixed.groupBy(U.order_key(c("b")).alias("k")).agg(F.count("*").alias("n"))
    return grouped.select(F.lower(c("k").cast("string")).alias("brand"), "n")


@query("l04_table_function", """
SELECT pos, word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word, unnest(range(0, len(string_split(text, ' ')))) AS pos FROM conversations) GROUP BY 1, 2""")
def l04(spark, sf):
    U.register_table_function(spark, "words_of", U.Words)
    rows = spark.sql("SELECT w.pos, w.word FROM {b}, LATERAL words_of(text) w", b=table(spark, sf, "conversations"))
    return rows.groupBy(c("pos").cast("long").alias("pos"), "word").agg(F.count("*").alias("n"))
