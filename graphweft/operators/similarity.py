"""Triangles and neighbourhood similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..graph import Graph
from ..ordered import dense_number, running_sum
from ..session import cut, fits
from ..skew import Fanout


def triangles(graph: Graph) -> DataFrame:
    """``id, triangles, clustering`` over the undirected simple view.

    Edges point from the smaller to the larger (degree, id), so no node has more
    than √(2·edges) out-edges. Every edge u→v looks up the out-edges v→w and the
    closing edge u→w; hubs have few or no out-edges and cannot blow up a task.
    """
    pairs = graph.edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    pairs = cut(pairs)
    degree = cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("d")))
    da = degree.select(F.col("id").alias("a"), F.col("d").alias("da"))
    db = degree.select(F.col("id").alias("b"), F.col("d").alias("db"))
    first = F.struct("da", "a") < F.struct("db", "b")
    oriented = cut(
        pairs.join(da, "a").join(db, "b").select(
            F.when(first, F.col("a")).otherwise(F.col("b")).alias("src"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("dst")
        )
    )
    fan = Fanout(oriented)
    wedges = fan.send(oriented.select(F.col("src").alias("u"), F.col("dst").alias("id"))).select("u", F.col("id").alias("v"), F.col("dst").alias("w"))
    closing = oriented.select(F.col("src").alias("u"), F.col("dst").alias("w"))
    found = wedges.join(closing, ["u", "w"])
    per_node = found.select(F.explode(F.array("u", "v", "w")).alias("id")).groupBy("id").agg(F.count("*").alias("t"))
    t, d = F.coalesce(F.col("t"), F.lit(0)), F.coalesce(F.col("d"), F.lit(0))
    return graph.nodes.select("id").join(degree, "id", "left").join(per_node, "id", "left").select(
        "id", t.alias("triangles"), F.when(d > 1, 2.0 * t / (d * (d - 1))).otherwise(0.0).alias("clustering")
    )


def _out_neighbours(graph: Graph) -> DataFrame:
    return graph.edges.where("src <> dst").select(F.col("src").alias("a"), F.col("dst").alias("nb")).distinct()


def _scored(shared: DataFrame, sizes: DataFrame) -> DataFrame:
    """Jaccard from ``a, b, shared`` and the neighbour counts."""
    sa = sizes.select("a", F.col("n").alias("na"))
    sb = sizes.select(F.col("a").alias("b"), F.col("n").alias("nb"))
    return shared.join(sa, "a").join(sb, "b").select(
        "a", "b", (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("similarity")
    )


def node_similarity(graph: Graph, threshold: float = 0.0, top_k: int | None = None) -> DataFrame:
    """``a, b, similarity``: Jaccard of out-neighbours for all pairs a < b above zero.

    Without a threshold every pair with a common neighbour is a result, and the join
    produces just those. With one, where neighbours differ in popularity, only the rarest of each node
    are used to find candidates (any pair reaching the threshold shares one of them), so
    popular neighbours are not paired at all; candidates are then counted exactly.
    ``top_k`` without a threshold takes the pairs from the best partners of each node.
    """
    adj = cut(_out_neighbours(graph))
    if threshold <= 0 and top_k is not None:
        return _best_partners(adj, adj, top_k, larger_only=True).drop("rank").orderBy(F.desc("similarity"), "a", "b").limit(top_k)
    sizes = cut(adj.groupBy("a").agg(F.count("*").alias("n")))
    if threshold <= 0:
        result = _scored(_all_shared(adj), sizes)
    else:
        result = _scored(_shared_above(adj, sizes, threshold), sizes).where(F.col("similarity") >= threshold)
    return result if top_k is None else result.orderBy(F.desc("similarity"), "a", "b").limit(top_k)


def _all_shared(adj: DataFrame) -> DataFrame:
    """Pairs a < b with a common neighbour, and how many."""
    keyed = Fanout(adj.select(F.col("nb").alias("src"), F.col("a").alias("dst")))
    both = keyed.send(adj.select(F.col("nb").alias("id"), "a")).where("a < dst")
    return both.groupBy("a", F.col("dst").alias("b")).agg(F.count("*").alias("shared"))


# Rows that counting all common neighbours may read for one that finding candidates reads; to check a candidate takes a row per neighbour.
CHECK_COST = 4


def _shared_above(adj: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """``a, b, shared`` of all pairs a < b that can reach the threshold, counted in the cheaper of two ways.

    Pairs share a neighbour of their prefixes in order of rarity. Where that spares popular neighbours, candidates are found by
    it and checked; where prefixes meet about as often as whole sets, all common neighbours are counted at once.
    """
    popularity = cut(adj.groupBy("nb").agg(F.count("*").alias("pop")))
    keep = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    # a distributed rank, since one node may have most of the edges
    ranked = running_sum(adj.join(popularity, "nb").join(sizes, "a"), ["a"], ["pop", "nb"], F.lit(1), "_r")
    prefix = cut(ranked.where(F.col("_r") <= keep).select("a", "nb", "n"))
    meetings = F.coalesce(F.sum(F.col("pop").cast("double") * (F.col("pop") - 1)), F.lit(0.0))
    whole, some = (x.agg(meetings).first()[0] for x in (popularity, prefix.groupBy("nb").agg(F.count("*").alias("pop"))))
    if whole <= CHECK_COST * some:
        return _all_shared(adj)
    keyed = Fanout(prefix.select(F.col("nb").alias("src"), F.col("a").alias("dst"), F.col("n").alias("n2")))
    joined = keyed.send(prefix.select(F.col("nb").alias("id"), "a", "n"))
    long_enough = (F.col("n2") >= F.col("n") * threshold - 1e-9) & (F.col("n") >= F.col("n2") * threshold - 1e-9)
    candidates = cut(joined.where((F.col("a") < F.col("dst")) & long_enough).select("a", F.col("dst").alias("b")).distinct())
    return _shared_counts(adj, candidates)


def _shared_counts(adj: DataFrame, pairs: DataFrame) -> DataFrame:
    other = adj.select(F.col("a").alias("b"), "nb")
    return pairs.join(adj, "a").join(other, ["b", "nb"]).groupBy("a", "b").agg(F.count("*").alias("shared"))


def pair_similarity(graph: Graph, pairs: DataFrame) -> DataFrame:
    """Jaccard of the given ``pairs(a, b)``; 0 when a node has no out-neighbours or nothing is shared."""
    adj = _out_neighbours(graph)
    sizes = adj.groupBy("a").agg(F.count("*").alias("n"))
    scored = _scored(_shared_counts(adj, pairs), sizes)
    return pairs.join(scored, ["a", "b"], "left").select("a", "b", F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def knn_nodes(graph: Graph, k: int = 10, nodes: DataFrame | None = None) -> DataFrame:
    """``a, b, similarity, rank``: the k most similar nodes with a positive value, ties to the smaller id.

    ``nodes(id)`` restricts the left side; by default every node gets its list.
    """
    adj = cut(_out_neighbours(graph))
    left = adj if nodes is None else adj.join(nodes.select(F.col("id").alias("a")), "a", "left_semi")
    return _best_partners(adj, left, k)


# Partners a node looks at in the first round of the search, and by how much each round widens it.
FIRST_LOOK = 256
WIDER = 8
# Holders that a node counts in one task's memory at most, and how many of them are dealt to a task.
MOST_COUNTED = 4_000_000
COUNTED_PER_TASK = 8_000_000
# Neighbours of the searching nodes that fit in the columns of a matrix, and the rows of a block on either side.
FEW_NEIGHBOURS = 256
LEFT_BLOCK, RIGHT_BLOCK = 8192, 65536
BEST = "a long, b long, similarity double, rank int"


def _best_partners(
    adj: DataFrame, left: DataFrame, k: int, larger_only: bool = False, first_look: int | None = None, few: int | None = None
) -> DataFrame:
    """The k best partners of every node of ``left`` (with ``larger_only`` among those of larger id), exact.

    Three ways, chosen by what they cost. A node whose neighbours have few holders counts all common neighbours (``_counted``);
    that is at most ``first_look`` holders per edge. The others touch hubs. If they have few different neighbours, blocks of
    them are compared with blocks of all holders (``_compared``), otherwise they search (``_search``).
    """
    look = first_look or FIRST_LOOK
    sizes = cut(adj.groupBy("a").agg(F.count("*").alias("n")))
    popular = adj.groupBy("nb").agg(F.count("*").alias("pop")).where("pop > 1")  # others are shared with nobody
    full = cut(adj.join(popular, "nb").join(sizes, "a"))
    mine = full.join(left.select("a").distinct(), "a", "left_semi")
    cost = cut(mine.groupBy("a", "n").agg(F.sum("pop").alias("cost")))
    dear = (F.col("cost") > F.col("n") * look) | (F.col("cost") > MOST_COUNTED)
    cheap = mine.join(cost.where(~dear).select("a"), "a", "left_semi")
    total = cost.where(~dear).agg(F.sum("cost")).first()[0] or 0
    best = _counted(full, cheap, k, larger_only, look, total)
    searching = cost.where(dear).select("a")
    if searching.isEmpty():
        return best
    searching = mine.join(searching, "a", "left_semi")
    hubs = searching.select("nb").distinct()
    if fits(hubs, FEW_NEIGHBOURS if few is None else few):
        return best.unionByName(_compared(full, searching, hubs, k, larger_only))
    allowed = F.col("b") > F.col("a") if larger_only else F.col("b") != F.col("a")
    return best.unionByName(_search(full, searching, k, allowed, look))


def _counted(full: DataFrame, mine: DataFrame, k: int, larger_only: bool, look: int, total: int) -> DataFrame:
    """Best partners of the nodes of ``mine`` by all that hold one of their neighbours, ``total`` holders together.

    A neighbour's holders travel as lists of some ``look`` of them, and a task counts those of one node at a time: no row per
    pair is moved or grouped.
    """
    dealt = full.withColumn("_block", F.pmod(F.xxhash64("a"), F.ceil(F.col("pop") / look))).groupBy("nb", "_block")
    lists = dealt.agg(F.collect_list(F.struct(F.col("a").alias("b"), F.col("n").cast("int").alias("m"))).alias("held")).drop("_block")
    held = F.filter("held", lambda x: x["b"] > F.col("a")) if larger_only else F.col("held")
    met = mine.select("a", "nb", "n").join(lists, "nb").select("a", "n", held.alias("held"))
    met = met.select("a", "n", F.col("held.b").alias("b"), F.col("held.m").alias("m")).where("size(b) > 0")
    tasks = max(int(full.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // COUNTED_PER_TASK))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            a, n = batch["a"].to_numpy(), batch["n"].to_numpy()
            ends = np.concatenate([[0], np.cumsum(batch["b"].value_lengths().to_numpy())])
            b, m = batch["b"].flatten().to_numpy(), batch["m"].flatten().to_numpy()
            borders = np.flatnonzero(a[1:] != a[:-1]) + 1
            found = []
            for low, high in zip([0, *borders], [*borders, len(a)], strict=True):
                if last is not None and a[low] != last[0]:
                    found.append(_top_counted(*last, parts, k))
                    parts = []
                last = (a[low], n[low])
                parts.append((b[ends[low] : ends[high]], m[ends[low] : ends[high]]))
            parts = [tuple(np.concatenate(x) for x in zip(*parts, strict=True))]
            yield _best_rows(found)
        if last is not None:
            yield _best_rows([_top_counted(*last, parts, k)])

    return met.repartition(tasks, "a").sortWithinPartitions("a").mapInArrow(count, BEST)


def _top_counted(a: int, n: int, parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, ...]:
    """The k best partners of one node; a partner is listed in ``parts`` once for every neighbour it shares."""
    b, m = (np.concatenate(x) for x in zip(*parts, strict=True))
    b, at, shared = np.unique(b, return_index=True, return_counts=True)
    value = shared / (n + m[at] - shared)
    value[b == a] = 0
    good = np.flatnonzero(value > 0)
    if len(good) > k:
        good = good[value[good] >= np.partition(value[good], len(good) - k)[len(good) - k]]
    good = good[np.lexsort((b[good], -value[good]))[:k]]
    return np.full(len(good), a), b[good], value[good], np.arange(1, len(good) + 1, dtype=np.int32)


def _best_rows(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    kinds = (np.int64, np.int64, np.float64, np.int32)
    columns = [np.concatenate([np.zeros(0, kind), *[f[i] for f in found]]) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "b", "similarity", "rank"])


def _compared(full: DataFrame, mine: DataFrame, hubs: DataFrame, k: int, larger_only: bool) -> DataFrame:
    """Best partners of the nodes of ``mine``, which have no neighbours but ``hubs(nb)``: blocks of them meet blocks of all holders.

    Common neighbours are counted by multiplying matrices with a column per neighbour. From a pair of blocks come the k best of each node.
    """
    numbers = cut(dense_number(hubs, ["nb"], "at", start=0))
    width = numbers.count()

    def sets(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(numbers), "nb").groupBy(F.col("a").alias("id"), "n").agg(F.collect_list(F.col("at").cast("int")).alias("held"))

    sides = [cut(sets(mine)), cut(sets(full))]
    blocks = [-(-side.count() // size) for side, size in zip(sides, (LEFT_BLOCK, RIGHT_BLOCK), strict=True)]
    dealt = []
    for i, name in enumerate(("left", "right")):
        own = F.pmod(F.xxhash64("id"), F.lit(blocks[i])).alias(name)
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks[1 - i] - 1).cast("long"))).alias(("right", "left")[i])
        dealt.append(sides[i].select("id", "n", "held", own, other))
    # names of their own: both sides come from the same rows
    dealt[1] = dealt[1].select(*[F.col(c).alias(f"r_{c}") for c in dealt[1].columns])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.rename_columns([c.removeprefix("r_") for c in right.column_names])
        found = list(_tiles(left, right, width, k, larger_only)) if left.num_rows and right.num_rows else []
        return pa.Table.from_batches([_best_rows(found)])

    met = dealt[0].groupBy("left", "right").cogroup(dealt[1].groupBy("r_left", "r_right")).applyInArrow(meet, BEST).drop("rank")
    return _ranked(met, k)


def _tiles(left: pa.Table, right: pa.Table, width: int, k: int, larger_only: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """The k best of ``right`` for each row of ``left``, a tile of the two at a time."""

    def matrix(table: pa.Table, rows: np.ndarray) -> np.ndarray:
        held = table["held"].combine_chunks().take(pa.array(rows))
        out = np.zeros((len(rows), width), np.float32)
        out[np.repeat(np.arange(len(rows)), held.value_lengths().to_numpy()), held.flatten().to_numpy()] = 1
        return out

    ids, sizes = ([t[c].to_numpy() for t in (left, right)] for c in ("id", "n"))
    order = np.argsort(ids[1])  # of equal values the smaller id comes first and stays
    # narrow tiles first: they set the values that others must exceed
    cuts = [0, *[c for c in (64, 512) if c < len(order)], *range(2048, len(order), 2048), len(order)]
    for low in range(0, len(ids[0]), 1024):
        rows = np.arange(low, min(low + 1024, len(ids[0])))
        a, n, one = ids[0][rows], sizes[0][rows], matrix(left, rows)
        best_value, best_id = np.zeros((len(rows), k)), np.full((len(rows), k), -1)
        for begin, end in zip(cuts, cuts[1:]):
            others = order[begin:end]
            b = ids[1][others]
            shared = (one @ matrix(right, others).T).astype(np.float64)
            value = shared / (n[:, None] + sizes[1][others] - shared)
            row, col = np.nonzero(value > best_value[:, -1:])
            keep = b[col] > a[row] if larger_only else b[col] != a[row]
            row, col = row[keep], col[keep]
            if not len(row):
                continue
            # what was found so far precedes, since its ids are smaller
            touched = np.unique(row)
            at = np.concatenate([np.repeat(touched, k), row])
            new_value = np.concatenate([best_value[touched].ravel(), value[row, col]])
            new_id = np.concatenate([best_id[touched].ravel(), b[col]])
            sort = np.lexsort((np.arange(len(at)), -new_value, at))
            at = at[sort]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            some = place < k
            best_value[at[some], place[some]], best_id[at[some], place[some]] = new_value[sort][some], new_id[sort][some]
        row, place = np.nonzero(best_value > 0)
        yield a[row], best_id[row, place], best_value[row, place], place.astype(np.int32) + 1


def _jaccard(shared: str) -> Column:
    return F.col(shared) / (F.col("n") + F.col("m") - F.col(shared))


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("a").orderBy(F.desc("similarity"), "b"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def _search(full: DataFrame, mine: DataFrame, k: int, allowed: Column, look: int) -> DataFrame:
    """Best partners of the nodes of ``mine``, most promising holders first, until none left can enter the list.

    Neighbours are ordered by rarity. A partner whose first common neighbour is this one shares at most those from here on, so
    the holders of a neighbour, in classes of similar size, have a bound; popular neighbours come last and have low ones. Each round looks
    at the next holders in order of the bounds, counts exactly what they share, and ends for the nodes whose k-th value
    beats the bound of all that is left. Within a class holders are sorted by (size, id), so equal values end a class too.
    The holders come in blocks of ``look`` rows: a hub is read as far as somebody needs it.
    """
    size_class = F.floor(4 * F.log2("n")).cast("int")  # sizes up to 8 by themselves, then steps of a fifth
    holders = running_sum(full.withColumn("g", size_class), ["nb", "g"], ["n", "a"], F.lit(1), "pos").select(
        "nb", "g", "pos", F.floor((F.col("pos") - 1) / look).alias("block"), F.col("a").alias("b"), F.col("n").alias("m")
    )
    holders = cut(holders)
    classes = holders.groupBy("nb", "g").agg(F.min("m").alias("lo"), F.max("m").alias("hi"), F.count("*").alias("cnt"))
    rest = running_sum(mine, ["a"], [F.desc("pop"), F.desc("nb")], F.lit(1), "rest")
    most = F.least("rest", "hi")
    steps = rest.join(classes, "nb").withColumn("most", most)
    steps = steps.withColumn("bound", F.col("most") / (F.col("n") + F.greatest("most", "lo") - F.col("most")))
    steps = cut(
        running_sum(steps.select("a", "n", "nb", "g", "most", "bound", "cnt"), ["a"], [F.desc("bound"), "nb", "g"], F.col("cnt"), "upto")
        .withColumn("before", F.col("upto") - F.col("cnt"))
    )
    open_, best, done, wide = mine.select("a").distinct(), None, 0, look
    while True:
        left = cut(steps.where(F.col("upto") > done).join(open_, "a", "left_semi"))
        first, last = F.greatest(F.lit(done) - F.col("before"), F.lit(0)), F.least(F.lit(wide) - F.col("before"), F.col("cnt"))
        now = left.where(F.col("before") < wide).select("a", "n", "nb", "g", first.alias("first"), last.alias("last"))
        blocks = F.sequence(F.floor(F.col("first") / look), F.floor((F.col("last") - 1) / look))
        met = now.withColumn("block", F.explode(blocks)).join(holders, ["nb", "g", "block"]).where(allowed & (F.col("pos") > F.col("first")) & (F.col("pos") <= F.col("last")))
        found = _count_shared(met.select("a", "b", "n", "m").distinct(), full).select("a", "b", _jaccard("shared").alias("similarity"))
        if best is not None:
            found = found.unionByName(best.drop("rank")).distinct()
        best = cut(_ranked(found, k))
        # what is left of each node: whole classes, and one class that was begun, of which the next holder is known
        kth = best.where(F.col("rank") == k).select("a", F.col("similarity").alias("kth"), F.col("b").alias("kb"))
        after = left.where(F.col("upto") > wide).withColumn("pos", F.when(F.col("before") < wide, F.lit(wide) - F.col("before") + 1))
        after = after.join(holders.select("nb", "g", "pos", "b", "m"), ["nb", "g", "pos"], "left").join(kth, "a", "left")
        bound = F.when(F.col("m").isNull(), F.col("bound")).otherwise(F.col("most") / (F.col("n") + F.greatest("most", "m") - F.col("most")))
        tie = (bound == F.col("kth")) & (F.col("m") >= F.col("most")) & (F.col("b") > F.col("kb"))
        open_ = cut(after.where(~F.coalesce((bound < F.col("kth")) | tie, F.lit(False))).select("a").distinct())
        if open_.isEmpty():
            return best
        done, wide = wide, wide * WIDER


def _count_shared(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """``pairs(a, b, n, m)`` with ``shared``; only the smaller of the two sets is spread out."""
    small = F.col("n") <= F.col("m")
    sided = pairs.withColumn("_s", F.when(small, F.col("a")).otherwise(F.col("b"))).withColumn("_l", F.when(small, F.col("b")).otherwise(F.col("a")))
    spread = sided.join(full.select(F.col("a").alias("_s"), "nb"), "_s")
    return spread.join(full.select(F.col("a").alias("_l"), "nb"), ["_l", "nb"]).groupBy("a", "b", "n", "m").agg(F.count("*").alias("shared"))
