"""Clause queries (C)."""

from pyspark.sql import functions as F

from ..operators import clauses as K
from .data import CHAIN_SQL, ORDER, chain, supply, table
from .registry import query

c = F.col

_FLAGSHIP = """
SELECT r_name AS region, c_name AS customer, CAST(count(*) AS BIGINT) AS orders, round(sum(o_totalprice), 2) AS total
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN orders ON o_custkey = c_custkey GROUP BY r_name, c_name"""


def _customer_orders(spark, sf):
    """(c)-[:LIVES_IN]->()-[:IN_REGION]->(r), (c)-[:PLACED]->(o)"""
    return (
        supply(spark, sf).match()
        .node("c", "Customer").out("LIVES_IN").node().out("IN_REGION").node("r", "Region")
        .path().node("c").out("PLACED").node("o", "Order").df()
    )


def _totals(spark, sf):
    return K.returning(
        _customer_orders(spark, sf), c("r_name").alias("region"), c("c_name").alias("customer"),
        orders=F.count("*"), total=F.round(F.sum("o_total"), 2),
    )


@query("c01_return_items", "SELECT c_name AS name, c_acctbal * 2 AS doubled, upper(c_mktsegment) AS segment FROM customer")
def c01(spark, sf):
    m = supply(spark, sf).match().node("c", "Customer").df()
    return K.returning(m, c("c_name").alias("name"), (c("c_acctbal") * 2).alias("doubled"), F.upper("c_segment").alias("segment"))


@query("c02_return_distinct", """
SELECT DISTINCT n_name, c_mktsegment AS segment FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def c02(spark, sf):
    m = supply(spark, sf).match().node("c", "Customer").out("LIVES_IN").node("n", "Nation").df()
    return K.returning(m, "n_name", c("c_segment").alias("segment"), distinct=True)


@query("c03_return_star", """
SELECT c_custkey + 3000000000000 AS c_id, c_name, n_nationkey + 2000000000000 AS n_id, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def c03(spark, sf):
    m = supply(spark, sf).match().node("c", "Customer").out("LIVES_IN").node("n", "Nation").df()
    named = [x for x in m.columns if x.endswith(("_id", "_name"))]
    return m.select("*").select(*named)


@query("c04_implicit_grouping", _FLAGSHIP)
def c04(spark, sf):
    return _totals(spark, sf)


@query("c05_with_where", f"SELECT * FROM ({_FLAGSHIP}) WHERE orders >= 12 AND total > 2000000")
def c05(spark, sf):
    return _totals(spark, sf).where((c("orders") >= 12) & (c("total") > 2_000_000))


@query("c06_order_by", """
SELECT doc_id, quality, CAST(row_number() OVER (ORDER BY quality ASC NULLS FIRST, n_chars DESC, doc_id) AS BIGINT) AS place
FROM documents LEFT JOIN labels USING (doc_id)""")
def c06(spark, sf):
    from ..ordered import dense_number

    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select("doc_id", "quality", "n_chars")
    # the rank makes the order visible to an order-insensitive check
    order = [c("quality").asc_nulls_first(), c("n_chars").desc(), c("doc_id").asc()]
    return K.order_by(dense_number(d, order, "place"), "quality", ("n_chars", "desc"), "doc_id").select("doc_id", "quality", "place")


@query("c07_skip_limit", """
SELECT p_name, p_partkey FROM part ORDER BY p_name, p_partkey LIMIT 50 OFFSET 100""")
def c07(spark, sf):
    return K.page(K.order_by(table(spark, sf, "part"), "p_name", "p_partkey"), skip=100, limit=50).select("p_name", "p_partkey")


@query("c08_top_k", f"SELECT * FROM ({_FLAGSHIP}) ORDER BY total DESC, customer LIMIT 10")
def c08(spark, sf):
    return K.page(K.order_by(_totals(spark, sf), ("total", "desc"), "customer"), limit=10)


@query("c09_union", """
SELECT n_name AS name FROM nation JOIN customer ON c_nationkey = n_nationkey UNION
SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey""")
def c09(spark, sf):
    g = supply(spark, sf)
    return K.union_rows(
        g.match().node("x", "Customer").out("LIVES_IN").node("n", "Nation").df().select(c("n_name").alias("name")),
        g.match().node("x", "Supplier").out("BASED_IN").node("n", "Nation").df().select("n_name"),
    )


@query("c09_union_all", """
SELECT o_orderkey AS k, 'big' AS why FROM orders WHERE o_totalprice > 400000 UNION ALL
SELECT o_orderkey, 'urgent' FROM orders WHERE o_orderpriority = '1-URGENT'""")
def c09_all(spark, sf):
    o = table(spark, sf, "orders")
    return K.union_rows(
        o.where("o_totalprice > 400000").select(c("o_orderkey").alias("k"), F.lit("big").alias("why")),
        o.where("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit("urgent")), keep_all=True,
    )


@query("c10_unwind", """
SELECT word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations) GROUP BY 1""")
def c10(spark, sf):
    words = K.unwind(table(spark, sf, "conversations").select("text"), F.split("text", " "), "word")
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query("c11_call_subquery", """
SELECT c_name, CAST(coalesce(n, 0) AS BIGINT) AS n, biggest FROM customer LEFT JOIN
 (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS biggest FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""")
def c11(spark, sf):
    g = supply(spark, sf)
    inner = (
        g.match().node("c").out("PLACED").node("o", "Order", status="F").df()
        .groupBy("c_id").agg(F.count("*").alias("n"), F.max("o_total").alias("biggest"))
    )
    rows = K.call(g.match().node("c", "Customer").df(), inner, ["c_id"], keep_empty=True)
    return rows.select("c_name", F.coalesce("n", F.lit(0)).alias("n"), "biggest")


@query("c11_call_top", """
SELECT c_name, o_orderkey, o_totalprice AS total FROM customer LEFT JOIN
 (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) ON o_custkey = c_custkey AND r <= 2""")
def c11_top(spark, sf):
    g = supply(spark, sf)
    inner = g.match().node("c").out("PLACED").node("o", "Order").df().select("c_id", (c("o_id") - ORDER).alias("o_orderkey"), c("o_total").alias("total"))
    rows = K.call_top(g.match().node("c", "Customer").df(), inner, ["c_id"], [F.desc("total"), F.asc("o_orderkey")], 2, keep_empty=True)
    return rows.select("c_name", "o_orderkey", "total")


@query("c12_foreach", f"""
WITH {CHAIN_SQL}
SELECT event_id AS id, unnest([event_type, event_type || '_seen']) AS tag FROM events""")
def c12(spark, sf):
    from ..graph import Graph

    def tag(graph, rows):
        return Graph(graph.nodes, rows.select(c("a_id").alias("id"), "tag"), "tags")

    g = chain(spark, sf)
    rows = g.match().node("a", "Event").df()
    tags = F.array(c("a_event_type"), F.concat(c("a_event_type"), F.lit("_seen")))
    return K.foreach(g, rows, tags, "tag", tag).edges


@query("c13_chained_with", f"""
SELECT region, CAST(count(*) AS BIGINT) AS customers, round(avg(total), 2) AS mean_total FROM
 (SELECT * FROM ({_FLAGSHIP}) WHERE orders > 8) GROUP BY region HAVING count(*) > 10""")
def c13(spark, sf):
    first = _totals(spark, sf).where(c("orders") > 8)
    second = K.returning(first, "region", customers=F.count("*"), mean_total=F.round(F.avg("total"), 2))
    return second.where(c("customers") > 10)


@query("c14_explain", """
SELECT CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 2) AS total, true AS pushed, true AS pruned FROM orders WHERE o_orderstatus = 'F'""")
def c14(spark, sf):
    m = supply(spark, sf).match().node("o", "Order", status="F").df().select("o_total")
    text = K.explain(m)
    # the label picks one source table, the property reaches its scan, unused columns are not read
    pushed = "EqualTo(o_orderstatus,F)" in text
    pruned = "customer.parquet" not in text and "o_orderpriority" not in text
    return m.agg(F.count("*").alias("n"), F.round(F.sum("o_total"), 2).alias("total"), F.lit(pushed).alias("pushed"), F.lit(pruned).alias("pruned"))
