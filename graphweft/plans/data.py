"""Graphs over the given tables, and the same graphs as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..graph import Graph, edge_table, node_table
from ..ordered import with_next
from ..session import cut

# Node ids: table key + label number * this step. Edge ids likewise by type.
STEP = 10**12
REGION, NATION, CUSTOMER, SUPPLIER, PART, ORDER = (i * STEP for i in range(1, 7))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def supply(spark: SparkSession, sf: str) -> Graph:
    """Region, nation, customer, supplier, part and order nodes with their foreign-key edges."""
    c = F.col
    region, nation, customer, supplier, part, orders, lineitem = (
        table(spark, sf, t) for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    )
    nodes = [
        node_table(region, c("r_regionkey") + F.lit(REGION), "Region", name=c("r_name")),
        node_table(nation, c("n_nationkey") + F.lit(NATION), "Nation", name=c("n_name")),
        node_table(
            customer, c("c_custkey") + F.lit(CUSTOMER), ["Customer", "Party"],
            name=c("c_name"), acctbal=c("c_acctbal"), segment=c("c_mktsegment"),
        ),
        node_table(supplier, c("s_suppkey") + F.lit(SUPPLIER), ["Supplier", "Party"], name=c("s_name"), acctbal=c("s_acctbal")),
        node_table(
            part, c("p_partkey") + F.lit(PART), "Part",
            name=c("p_name"), brand=c("p_brand"), kind=c("p_type"), size=c("p_size"), price=c("p_retailprice"),
        ),
        node_table(
            orders, c("o_orderkey") + F.lit(ORDER), "Order",
            status=c("o_orderstatus"), total=c("o_totalprice"), ordered_at=c("o_orderdate"), priority=c("o_orderpriority"),
        ),
    ]
    line_id = F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    supplies = lineitem.select("l_suppkey", "l_partkey").distinct()
    edges = [
        edge_table(nation, c("n_nationkey") + F.lit(STEP), c("n_nationkey") + F.lit(NATION), c("n_regionkey") + F.lit(REGION), "IN_REGION"),
        edge_table(customer, c("c_custkey") + F.lit(2 * STEP), c("c_custkey") + F.lit(CUSTOMER), c("c_nationkey") + F.lit(NATION), "LIVES_IN"),
        edge_table(supplier, c("s_suppkey") + F.lit(3 * STEP), c("s_suppkey") + F.lit(SUPPLIER), c("s_nationkey") + F.lit(NATION), "BASED_IN"),
        edge_table(orders, c("o_orderkey") + F.lit(4 * STEP), c("o_custkey") + F.lit(CUSTOMER), c("o_orderkey") + F.lit(ORDER), "PLACED"),
        edge_table(
            lineitem, line_id, c("l_orderkey") + F.lit(ORDER), c("l_partkey") + F.lit(PART), "CONTAINS",
            quantity=c("l_quantity"), amount=c("l_extendedprice"), flag=c("l_returnflag"),
        ),
        edge_table(supplies, F.xxhash64("l_suppkey", "l_partkey"), c("l_suppkey") + F.lit(SUPPLIER), c("l_partkey") + F.lit(PART), "SUPPLIES"),
    ]
    return Graph.of(nodes, edges, "supply")


def hop_edges(spark: SparkSession, sf: str) -> DataFrame:
    """``src, dst, weight``: user of an event → user of the next event of the whole stream."""
    events = table(spark, sf, "events").select("ts", "event_id", "user_id")
    pairs = with_next(events, ["ts", "event_id"], ["user_id"]).where("next is not null")
    return cut(pairs.groupBy(F.col("user_id").alias("src"), F.col("next.user_id").alias("dst")).agg(F.count("*").alias("weight")))


def hop(spark: SparkSession, sf: str) -> Graph:
    """Users as nodes, distinct hops as edges with a weight; edge id unique per pair."""
    edges = hop_edges(spark, sf)
    users = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst"))).distinct()
    nodes = users.select("id", F.array(F.lit("User")).alias("labels"))
    # user ids are far below 2^31, so both fit into one long
    ids = F.col("src") * F.lit(1 << 31) + F.col("dst")
    return Graph(nodes, edges.select(ids.alias("id"), "src", "dst", F.lit("HOP").alias("type"), "weight"), "hop")


def chain(spark: SparkSession, sf: str) -> Graph:
    """Events as nodes; NEXT leads to the following event of the same user."""
    events = table(spark, sf, "events")
    nodes = events.select(
        F.col("event_id").alias("id"), F.array(F.lit("Event")).alias("labels"), "user_id", "event_type", "value", "ts"
    )
    placed = with_next(events.select("user_id", "ts", "event_id"), ["user_id", "ts", "event_id"], ["user_id", "event_id"])
    edges = placed.where("next.user_id = user_id").select(
        F.col("event_id").alias("id"), F.col("event_id").alias("src"), F.col("next.event_id").alias("dst"), F.lit("NEXT").alias("type")
    )
    return Graph(nodes, cut(edges), "chain")


# The same graphs in SQL, as CTEs.
HOP_SQL = """
ev AS (SELECT user_id AS src, lead(user_id) OVER (ORDER BY ts, event_id) AS dst FROM events),
hop AS MATERIALIZED (SELECT src, dst, count(*) AS weight FROM ev WHERE dst IS NOT NULL GROUP BY src, dst),
users AS MATERIALIZED (SELECT src AS id FROM hop UNION SELECT dst FROM hop)
"""
CHAIN_SQL = """
chain AS MATERIALIZED (
  SELECT * FROM (SELECT event_id AS src, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst FROM events)
  WHERE dst IS NOT NULL)
"""
