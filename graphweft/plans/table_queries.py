"""Source and sink (A), table sync (I) and sequence (J) queries."""

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import sequence, sync
from ..session import new_folder
from ..sources import tables as T
from ..sources import vectors as V
from .data import chain, supply, table
from .registry import query
from .vector_queries import _FOLD, _fold

c = F.col


# -- A ---------------------------------------------------------------------------------------
@query("a01_graph_nodes", """
SELECT 'Region' AS label, count(*) AS n, CAST(NULL AS DOUBLE) AS money FROM region UNION ALL SELECT 'Nation', count(*), NULL FROM nation
UNION ALL SELECT 'Customer', count(*), round(sum(c_acctbal), 2) FROM customer UNION ALL SELECT 'Supplier', count(*), round(sum(s_acctbal), 2) FROM supplier
UNION ALL SELECT 'Part', count(*), round(sum(p_retailprice), 2) FROM part UNION ALL SELECT 'Order', count(*), round(sum(o_totalprice), 2) FROM orders""")
def a01(spark, sf):
    money = F.coalesce("acctbal", "price", "total")
    return supply(spark, sf).nodes.groupBy(c("labels")[0].alias("label")).agg(F.count("*").alias("n"), F.round(F.sum(money), 2).alias("money"))


@query("a01_graph_edges", """
SELECT 'IN_REGION' AS type, count(*) AS n, CAST(NULL AS DOUBLE) AS q FROM nation UNION ALL SELECT 'LIVES_IN', count(*), NULL FROM customer
UNION ALL SELECT 'BASED_IN', count(*), NULL FROM supplier UNION ALL SELECT 'PLACED', count(*), NULL FROM orders
UNION ALL SELECT 'CONTAINS', count(*), round(sum(l_quantity), 2) FROM lineitem
UNION ALL SELECT 'SUPPLIES', count(*), NULL FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)""")
def a01_edges(spark, sf):
    return supply(spark, sf).edges.groupBy("type").agg(F.count("*").alias("n"), F.round(F.sum("quantity"), 2).alias("q"))


@query("a02_load_csv_headers", "SELECT c_name AS name, round(c_acctbal, 2) AS bal, c_mktsegment AS segment FROM customer")
def a02(spark, sf):
    path = new_folder(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).option("sep", ";").csv(path)
    rows = T.load_csv(spark, path, headers=True, separator=";")
    return rows.select(c("row")["c_name"].alias("name"), c("row")["c_acctbal"].cast("double").alias("bal"), c("row")["c_mktsegment"].alias("segment"))


@query("a02_load_csv_lists", "SELECT p_name AS name, CAST(p_size AS BIGINT) AS size FROM part")
def a02_lists(spark, sf):
    path = new_folder(spark, "csv")
    table(spark, sf, "part").write.csv(path)
    rows = T.load_csv(spark, path, headers=False)
    return rows.select(X.list_item(c("row"), 1).alias("name"), X.list_item(c("row"), 4).cast("long").alias("size"))


@query("a03_vector_ingest", f"""
SELECT vec_id, {_FOLD.format(v='embedding')} AS from_text, {_FOLD.format(v='embedding')} AS from_blob, CAST(256 AS BIGINT) AS bytes FROM embeddings""")
def a03(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.to_json("embedding").alias("text"), V.to_blob(c("embedding")).alias("blob"))
    return e.select(
        "vec_id", _fold(V.from_json_text(c("text"), 64)).alias("from_text"), _fold(V.from_blob(c("blob"), 64)).alias("from_blob"),
        F.octet_length("blob").cast("long").alias("bytes"),
    )


@query("a05_graph_cache", """
SELECT 'chain' AS graph, count(*) AS node_count, count(*) - count(DISTINCT user_id) AS edge_count, true AS cached, false AS cached_after FROM events""")
def a05(spark, sf):
    g = chain(spark, sf).cache().refresh()
    row = g.stats()
    row.collect()
    after = g.unpersist().nodes.is_cached
    return row.withColumn("cached_after", F.lit(after))


@query("a06_eav_long", """
SELECT entity, key, text, int, round(real, 2) AS real FROM (
 SELECT c_custkey AS entity, 'c_name' AS key, c_name AS text, CAST(NULL AS BIGINT) AS int, CAST(NULL AS DOUBLE) AS real FROM customer
 UNION ALL SELECT c_custkey, 'c_nationkey', NULL, c_nationkey, NULL FROM customer
 UNION ALL SELECT c_custkey, 'c_acctbal', NULL, NULL, c_acctbal FROM customer
 UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment, NULL, NULL FROM customer)""")
def a06(spark, sf):
    long = T.to_eav(table(spark, sf, "customer"), "c_custkey")
    return long.select("entity", "key", "text", "int", F.round("real", 2).alias("real"))


@query("a06_eav_round_trip", "SELECT c_custkey AS entity, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def a06_wide(spark, sf):
    df = table(spark, sf, "customer")
    return T.from_eav(T.to_eav(df, "c_custkey"), {k: v for k, v in df.dtypes if k != "c_custkey"})


@query("a07_partitioned_vectors", """
SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(min(vec_id) AS BIGINT) AS first_id FROM embeddings WHERE label >= 5 GROUP BY 1""")
def a07(spark, sf):
    path = new_folder(spark, "vectors")
    V.write_table(table(spark, sf, "embeddings"), path, ["label"], "vec_id")
    return V.read_table(spark, path).where("label >= 5").groupBy("label").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))


@query("a08_rows_to_json", """
SELECT s_suppkey + 4000000000000 AS id, '{"id":' || CAST(s_suppkey + 4000000000000 AS VARCHAR) || ',"labels":["Supplier","Party"],"properties":{"name":"' || s_name || '"' AS head
FROM supplier""")
def a08(spark, sf):
    rows = T.nodes_to_json(supply(spark, sf)).join(table(spark, sf, "supplier"), c("id") == c("s_suppkey") + F.lit(4 * 10**12))
    return rows.select("id", F.substring_index("json", ",\"acctbal\"", 1).alias("head"))


@query("a08_edges_to_json", """
SELECT json->>'$.type' AS type, CAST(json->>'$.start' AS BIGINT) AS s, CAST(json->>'$.end' AS BIGINT) AS e FROM
 (SELECT json_object('type', 'PLACED', 'start', o_custkey + 3000000000000, 'end', o_orderkey + 6000000000000) AS json FROM orders)""")
def a08_edges(spark, sf):
    from ..graph import Graph

    g = supply(spark, sf)
    rows = T.edges_to_json(Graph(g.nodes, g.edges.where("type = 'PLACED'")))
    picked = [F.get_json_object("json", f"$.{p}") for p in ("type", "start", "end")]
    return rows.select(picked[0].alias("type"), picked[1].cast("long").alias("s"), picked[2].cast("long").alias("e"))


@query("a09_materialise_paths", """
WITH n AS (SELECT event_id AS a, lead(event_id, 2) OVER w AS z, event_type AS t0, lead(event_type) OVER w AS t1, lead(event_type, 2) OVER w AS t2
 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT a AS start_id, t0 || '>' || t1 || '>' || t2 AS types FROM n WHERE z IS NOT NULL""")
def a09(spark, sf):
    g = chain(spark, sf)
    paths = g.match().node("a", "Event").out("NEXT", length=2, path="p").node("b").df().select("a_id", "p_node_ids")
    full = g.materialise_paths(paths, "a_id", "p_node_ids")
    types = F.transform("path", lambda v: v["properties"]["event_type"])
    return full.select(c("a_id").alias("start_id"), F.array_join(types, ">").alias("types"))


# -- I ---------------------------------------------------------------------------------------
# Side B of orders: urgent finished orders are gone, low-priority ones repriced and some reopened, large ones copied.
_GONE = "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"
_REPRICED = "o_orderpriority = '5-LOW'"
_REOPENED = "o_orderpriority = '5-LOW' AND o_orderstatus = 'F'"
_COPIED = "o_totalprice > 450000"
ORDERS_B = f"""
b AS (SELECT o_orderkey, o_custkey, CASE WHEN {_REOPENED} THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
 CASE WHEN {_REPRICED} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate,
 CASE WHEN o_orderpriority = '3-MEDIUM' AND o_totalprice < 20000 THEN NULL ELSE o_orderpriority END AS o_orderpriority
 FROM orders WHERE NOT ({_GONE})
 UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE {_COPIED})"""


def orders_b(spark, sf):
    o = table(spark, sf, "orders")
    edited = o.where(f"NOT ({_GONE})").withColumns({
        "o_orderstatus": F.when(F.expr(_REOPENED), "O").otherwise(c("o_orderstatus")),
        "o_totalprice": F.when(F.expr(_REPRICED), c("o_totalprice") + 1).otherwise(c("o_totalprice")),
        "o_orderpriority": F.when(F.expr("o_orderpriority = '3-MEDIUM' AND o_totalprice < 20000"), F.lit(None)).otherwise(c("o_orderpriority")),
    })
    return edited.unionByName(o.where(_COPIED).withColumn("o_orderkey", c("o_orderkey") + F.lit(1_000_000_000)))


_DIFF_SQL = f"""
WITH {ORDERS_B}, j AS (SELECT a.o_orderkey AS ak, b.o_orderkey AS bk, a.o_totalprice AS old_price, b.o_totalprice AS new_price,
 a.o_orderstatus IS DISTINCT FROM b.o_orderstatus AS cs, a.o_totalprice IS DISTINCT FROM b.o_totalprice AS cp,
 a.o_orderpriority IS DISTINCT FROM b.o_orderpriority AS co FROM orders a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT CASE WHEN bk IS NULL THEN 'DELETE' WHEN ak IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS op, coalesce(ak, bk) AS o_orderkey, old_price, new_price,
 CASE WHEN ak IS NULL OR bk IS NULL THEN '' ELSE concat_ws(',', CASE WHEN cs THEN 'o_orderstatus' END, CASE WHEN cp THEN 'o_totalprice' END,
  CASE WHEN co THEN 'o_orderpriority' END) END AS changed FROM j WHERE ak IS NULL OR bk IS NULL OR cs OR cp OR co"""


def _diff(spark, sf):
    return sync.diff(table(spark, sf, "orders"), orders_b(spark, sf), ["o_orderkey"])


@query("i01_diff", _DIFF_SQL)
def i01(spark, sf):
    d = _diff(spark, sf)
    return d.select(
        "op", "o_orderkey", c("old.o_totalprice").alias("old_price"), c("new.o_totalprice").alias("new_price"),
        F.array_join("changed", ",").alias("changed"),
    )


@query("i02_schema_check", """
SELECT count(*) AS n, true AS same, false AS renamed, false AS retyped, false AS keyless FROM orders""")
def i02(spark, sf):
    o = table(spark, sf, "orders")

    def passes(b, pk):
        try:
            sync.check_schema(o, b, pk)
            return True
        except ValueError:
            return False

    key = ["o_orderkey"]
    return o.agg(
        F.count("*").alias("n"), F.lit(passes(o, key)).alias("same"), F.lit(passes(o.withColumnRenamed("o_custkey", "c"), key)).alias("renamed"),
        F.lit(passes(o.withColumn("o_custkey", c("o_custkey").cast("int")), key)).alias("retyped"), F.lit(passes(o, [])).alias("keyless"),
    )


@query("i03_multi_table_diff", f"""
WITH {ORDERS_B}, d AS ({_DIFF_SQL.replace(f'WITH {ORDERS_B}, j', 'WITH j')})
SELECT 'orders' AS tbl, op, CAST(count(*) AS BIGINT) AS n FROM d GROUP BY 2
UNION ALL SELECT 'customer', 'UPDATE', count(*) FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'part', 'DELETE', count(*) FROM part WHERE p_size > 40""")
def i03(spark, sf):
    names = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"]}
    a = {n: table(spark, sf, n) for n in names}
    b = {
        "orders": orders_b(spark, sf),
        "customer": a["customer"].withColumn("c_acctbal", F.greatest("c_acctbal", F.lit(0.0))),
        "part": a["part"].where("p_size <= 40"),
    }
    out = None
    for name, d in sync.diff_tables(a, b, names).items():
        counts = d.groupBy("op").agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "op", "n")
        out = counts if out is None else out.unionAll(counts)
    return out


@query("i04_patch", f"WITH {ORDERS_B} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM b")
def i04(spark, sf):
    patched = sync.apply_all(table(spark, sf, "orders"), _diff(spark, sf), ["o_orderkey"])
    return patched.drop("o_orderdate")


@query("i04_patch_conflicts", f"""
WITH {ORDERS_B}, d AS ({_DIFF_SQL.replace(f'WITH {ORDERS_B}, j', 'WITH j')})
SELECT op, o_orderkey FROM d JOIN orders USING (o_orderkey) WHERE o_custkey < 300 AND op <> 'INSERT' AND (op = 'DELETE' OR contains(changed, 'o_totalprice'))
UNION ALL SELECT op, o_orderkey FROM d JOIN (SELECT o_orderkey + 1000000000 AS o_orderkey FROM orders WHERE o_custkey < 300) USING (o_orderkey) WHERE op = 'INSERT'""")
def i04_conflicts(spark, sf):
    # meanwhile the table moved on: prices of some customers changed and the copies were already made
    o = table(spark, sf, "orders")
    moved = o.withColumn("o_totalprice", F.when(c("o_custkey") < 300, c("o_totalprice") + 7).otherwise(c("o_totalprice")))
    taken = o.where("o_custkey < 300").withColumn("o_orderkey", c("o_orderkey") + F.lit(1_000_000_000))
    return sync.patch(moved.unionByName(taken), _diff(spark, sf), ["o_orderkey"]).conflicts.select("op", "o_orderkey")


@query("i05_diff_summary", f"""
WITH d AS ({_DIFF_SQL}) SELECT op, CAST(NULL AS VARCHAR) AS "column", CAST(count(*) AS BIGINT) AS n FROM d GROUP BY 1
UNION ALL SELECT op, unnest(string_split(changed, ',')), count(*) FROM d WHERE op = 'UPDATE' GROUP BY 1, 2""")
def i05(spark, sf):
    return sync.summary(_diff(spark, sf))


@query("i06_round_trip", "SELECT CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra, count(*) AS a_rows FROM orders")
def i06(spark, sf):
    a, b = table(spark, sf, "orders"), orders_b(spark, sf)
    patched = sync.patch(a, sync.diff(a, b, ["o_orderkey"]), ["o_orderkey"]).table
    missing, extra = b.exceptAll(patched).count(), patched.exceptAll(b).count()
    return a.agg(F.lit(missing).cast("long").alias("missing"), F.lit(extra).cast("long").alias("extra"), F.count("*").alias("a_rows"))


@query("a04_changeset_files", f"WITH d AS ({_DIFF_SQL}) SELECT op, CAST(count(*) AS BIGINT) AS n, round(sum(new_price), 2) AS new_total FROM d GROUP BY 1")
def a04(spark, sf):
    path = new_folder(spark, "changes")
    T.write_changes({"orders": _diff(spark, sf)}, path)
    back = T.read_changes(spark, path, "orders")
    return back.groupBy("op").agg(F.count("*").alias("n"), F.round(F.sum("new.o_totalprice"), 2).alias("new_total"))


@query("i04_patch_tables", f"""
WITH {ORDERS_B} SELECT 'orders' AS tbl, CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 2) AS money FROM b
UNION ALL SELECT 'customer', count(*), round(sum(greatest(c_acctbal, 0)), 2) FROM customer
UNION ALL SELECT 'part', count(*), round(sum(p_retailprice), 2) FROM part WHERE p_size <= 40""")
def i04_tables(spark, sf):
    """Three tables patched in one step, after a patch that fits only two of them was refused as a whole."""
    keys = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"]}
    a = {"orders": table(spark, sf, "orders").select(*orders_b(spark, sf).columns), "customer": table(spark, sf, "customer"), "part": table(spark, sf, "part")}
    b = {
        "orders": orders_b(spark, sf), "customer": a["customer"].withColumn("c_acctbal", F.greatest("c_acctbal", F.lit(0.0))),
        "part": a["part"].where("p_size <= 40"),
    }
    changes = sync.diff_tables(a, b, keys)
    store = sync.TableSet(spark, new_folder(spark, "tables"))
    store.write(a)
    store.write({"part": b["part"]})
    try:
        store.patch(changes, keys)
    except sync.PatchConflict:
        store.write({"part": a["part"]})
    store.patch(changes, keys)
    now, out = store.read(), None
    for name, money in (("orders", "o_totalprice"), ("customer", "c_acctbal"), ("part", "p_retailprice")):
        one = now[name].agg(F.count("*").alias("n"), F.round(F.sum(money), 2).alias("money")).select(F.lit(name).alias("tbl"), "n", "money")
        out = one if out is None else out.unionAll(one)
    return out


# -- J ---------------------------------------------------------------------------------------
@query("j01_stored_marks", """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS id FROM orders
UNION ALL SELECT -1 - c_custkey, CAST((SELECT count(*) FROM orders) + row_number() OVER (ORDER BY c_custkey) AS BIGINT) FROM customer""")
def j01_stored(spark, sf):
    folder = new_folder(spark, "marks")
    one, other = (sequence.StoredMarks(spark, folder) for _ in range(2))
    first = one.nextval(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "rows", ["o_orderdate", "o_orderkey"])
    second = other.nextval(table(spark, sf, "customer").select("c_custkey"), "rows", ["c_custkey"])
    return first.select("o_orderkey", "id").unionAll(second.select(-1 - c("c_custkey"), "id"))


@query("j01_nextval", """
SELECT o_orderkey, CAST(1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS id FROM orders
UNION ALL SELECT -1 - c_custkey, CAST(1000 + (SELECT count(*) FROM orders) + row_number() OVER (ORDER BY c_custkey) AS BIGINT) FROM customer""")
def j01(spark, sf):
    marks = sequence.new_marks(spark, {"rows": 1000, "other": 5})
    first, marks = sequence.nextval(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), marks, "rows", ["o_orderdate", "o_orderkey"])
    second, marks = sequence.nextval(table(spark, sf, "customer").select("c_custkey"), marks, "rows", ["c_custkey"])
    return first.select("o_orderkey", "id").unionAll(second.select(-1 - c("c_custkey"), "id"))


@query("j02_curval", """
SELECT 'rows' AS name, 1000 + (SELECT count(*) FROM orders) AS seq UNION ALL SELECT 'other', 5 UNION ALL SELECT 'fresh', (SELECT count(*) FROM customer)""")
def j02(spark, sf):
    marks = sequence.new_marks(spark, {"rows": 1000, "other": 5})
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    _, marks = sequence.nextval(orders.select("o_orderkey"), marks, "rows", ["o_orderkey"])
    requests = customers.groupBy(F.lit("fresh").alias("name")).agg(F.count("*").alias("n"))
    before = sequence.curval(marks, "rows")
    marks = sequence.advance(marks, requests)
    return marks.where((c("name") != "rows") | (c("seq") == before))
