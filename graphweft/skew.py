"""Equi-joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .session import cut, cut_placed

# A key with more rows than this on the big side is split over several tasks.
ROWS_PER_SALT = 1_000_000
# The table of hot keys is broadcast, so the chunk grows until it must fit this bound.
MAX_HOT_KEYS = 100_000
EDGES_PER_PARTITION = 5_000_000


def hot_keys(counts: DataFrame, key: str, n: str, total: int, chunk: int | None = None) -> tuple[DataFrame, int]:
    """Keys to split, as ``(key, _copies)``, and the chunk size in use.

    With ``total`` rows at most ``total / chunk`` keys can exceed ``chunk``;
    the chunk is chosen so that this stays at or below ``MAX_HOT_KEYS``, which
    is what makes the broadcast of the result safe at any scale.
    """
    chunk = max(chunk or ROWS_PER_SALT, -(-total // MAX_HOT_KEYS))
    hot = counts.where(F.col(n) > chunk).select(key, F.ceil(F.col(n) / chunk).cast("int").alias("_copies"))
    return hot, chunk


def add_salt(big: DataFrame, hot: DataFrame, key: str, spread_by: list[Column]) -> DataFrame:
    """Give each row of the big side one of the copies of its key."""
    return (
        big.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.coalesce("_copies", F.lit(1))).cast("int"))
        .drop("_copies")
    )


def replicate(small: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Repeat each row of the small side once per copy of its key."""
    return (
        small.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
        .drop("_copies")
    )


def join_spread(
    big: DataFrame, small: DataFrame, key: str, n: str, total: int, spread_by: list[Column], chunk: int | None = None
) -> DataFrame:
    """Inner join of ``big`` to ``small`` (one row per key, ``n`` = its rows in ``big``).

    Up to ``chunk`` rows in total no key can be too large, and the join is plain.
    """
    if total <= (chunk or ROWS_PER_SALT):
        return big.join(small.drop(n), key)
    hot, _ = hot_keys(small, key, n, total, chunk)
    return add_salt(big, hot, key, spread_by).join(replicate(small.drop(n), hot, key), [key, "_salt"]).drop("_salt")


class Fanout:
    """Edges prepared once for repeated joins from a node table to its out-edges.

    ``edges`` needs ``src`` and ``dst``. Sources with very many edges are split
    over salts; a node row joins all copies of its key, so no task ever holds
    all edges of a hub. Without hubs the join is a plain equi-join.

    ``resident`` edges are placed by source once, and every later ``send`` moves only
    the state. That suits states with one row per node. States with many rows per
    node (searches from many sources) leave it off, so that Spark's adaptive join
    can split a node that most searches meet.
    """

    def __init__(self, edges: DataFrame, chunk: int | None = None, resident: bool = False):
        edges = cut(edges)
        counts = cut(edges.groupBy("src").agg(F.count("*").alias("_n")))
        total, largest = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
        hot, used = hot_keys(counts, "src", "_n", total, chunk)
        self.out_degree = counts.select(F.col("src").alias("id"), F.col("_n").alias("out_degree"))
        self.hot = cut(hot) if largest > used else None
        self.edge_count = total
        keys = ["src"]
        if self.hot is not None:
            edges = add_salt(edges, self.hot, "src", [F.col("dst")])
            keys.append("_salt")
            edges = cut(edges)
        self.edges = cut_placed(edges, _partitions(edges, total), keys) if resident else edges

    def send(self, state: DataFrame) -> DataFrame:
        """Join ``state(id, …)`` to the out-edges of ``id``; adds the edge columns but ``src``."""
        if self.hot is None:
            return state.join(self.edges, state["id"] == self.edges["src"]).drop("src")
        hot = self.hot.withColumnRenamed("src", "id")
        spread = replicate(state, hot, "id").withColumnRenamed("_salt", "_slot")
        hit = (spread["id"] == self.edges["src"]) & (spread["_slot"] == self.edges["_salt"])
        return spread.join(self.edges, hit).drop("src", "_salt", "_slot")


def _partitions(df: DataFrame, total: int) -> int:
    """Few for small edge sets, at most EDGES_PER_PARTITION rows each for large ones.

    At least two: Spark does not count a single partition as placed by a key.
    """
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, -(-total // EDGES_PER_PARTITION), min(configured, -(-total // 20_000)))
