"""Variable-length paths and shortest-path patterns as frontier joins."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..ordered import sort_into_ranges
from ..placed import PlacedTable, levels
from ..session import cut, new_folder, settle
from ..skew import Fanout
from .forest import ways_up
from .resident import Held, resident
from .traversal import ReachSearch, reach_levels

_LAZY_DEPTH = 4  # up to this depth the levels stay one plan; beyond it each level is materialised
_WAYS_BYTES = 128_000_000  # of a table with 4 bytes for each node and end of a block
_BITS_AT_ONCE, _PLACES_AT_ONCE = 1 << 20, 1 << 19  # pairs looked for, and steps of paths, at a time
_TURNS, _TURN_ROWS = 512, 4_096


def expand(edges: DataFrame, starts: DataFrame, low: int, high: int | None) -> DataFrame:
    """Paths without repeated nodes, ``low`` to ``high`` edges long, without a bound if None.

    Returns ``start, end, depth, node_ids, edge_ids``. Each level joins the
    frontier to the edges once; the work is proportional to the paths found.
    """
    hops = edges.select("src", "dst", F.col("id").alias("edge_id"))
    nothing = F.array().cast("array<bigint>")
    level = starts.select(
        F.col("id").alias("start"),
        F.col("id").alias("end"),
        F.lit(0).alias("depth"),
        F.array("id").alias("node_ids"),
        nothing.alias("edge_ids"),
    )
    found = [level] if low == 0 else []
    deep = high is None or high > _LAZY_DEPTH
    fan = Fanout(hops)
    for depth in count(1) if high is None else range(1, high + 1):
        step = fan.send(level.withColumnRenamed("end", "id")).withColumnRenamed("id", "end")
        level = step.where(~F.array_contains("node_ids", F.col("dst"))).select(
            "start",
            F.col("dst").alias("end"),
            F.lit(depth).alias("depth"),
            F.array_append("node_ids", F.col("dst")).alias("node_ids"),
            F.array_append("edge_ids", F.col("edge_id")).alias("edge_ids"),
        )
        if deep:
            level = cut(level)
            if level.isEmpty():
                break
        if depth >= low:
            found.append(level)
    result = found[0] if found else level.limit(0)
    for more in found[1:]:
        result = result.unionAll(more)
    return result


def reachable(edges: DataFrame, starts: DataFrame, low: int = 1, high: int | None = None) -> DataFrame:
    """``start, end`` once for all pairs with a path of ``low`` (0 or 1) to ``high`` edges between them.

    The same pairs as the ends of ``expand``, which lists every path. Here a pair is met once: a search from all starts
    at the same time, whose pairs lie in a placed table, so cycles end and many ways to a node cost no more than one.
    """
    if low > 1:
        raise ValueError("a way of at least two edges is not a matter of reachability; use expand")
    hops = edges.where("src <> dst").select("src", "dst").distinct()
    first = starts.select(F.col("id").alias("start"), "id", F.lit(0).alias("depth")).distinct()
    fan = Fanout(hops)
    if high is not None and high <= _LAZY_DEPTH:
        level, found = first, [first]
        for _ in range(high):
            level = fan.send(level.select("start", "id")).select("start", F.col("dst").alias("id")).distinct().withColumn("depth", F.lit(1))
            found.append(level)
        pairs = found[0]
        for more in found[1:]:
            pairs = pairs.unionAll(more.where("start <> id"))
        return pairs.where(F.col("depth") >= low).select("start", F.col("id").alias("end")).distinct()
    table, depth = PlacedTable(first, ["start", "id"]), 0
    while high is None or depth < high:
        step = fan.send(levels(table, depth).select("start", "id")).select("start", F.col("dst").alias("id")).distinct()
        depth += 1
        table.add(table.missing(step).withColumn("depth", F.lit(depth)))
        if levels(table, depth).isEmpty():
            break
    return table.rows().where(F.col("depth") >= low).select("start", F.col("id").alias("end"))


def shortest_paths(
    edges: DataFrame, starts: DataFrame, all_ties: bool = False, max_depth: int | None = None
) -> DataFrame:
    """Shortest path per (start, end) pair with end ≠ start.

    Breadth-first from all ``starts(id)`` at once. A pair is settled at the first level that reaches it and keeps one pointer to
    the node before it, in a placed table; whole paths are put together at the end. One path per pair (smallest node
    ids, then edge ids) or, with ``all_ties``, every one.

    Pairs of a level are ranked by the rank of the node before them and their own id. That is the order of their
    paths, so the smallest rank leads to the smallest path, and no path is carried along.

    Where every node with an out-edge is a start, the distances of all pairs are found first, 64 ends to a row (``_from_everywhere``).
    """
    hops = cut(edges.where("src <> dst").select("src", "dst", F.col("id").alias("edge_id")))
    if _everywhere(hops, starts):
        return _from_everywhere(hops, all_ties, max_depth)
    fan = Fanout(hops)
    nothing = F.lit(None).cast("long")
    first = starts.select(F.col("id").alias("start"), "id", F.lit(0).alias("depth"), nothing.alias("above"), nothing.alias("edge_id"), F.lit(0).cast("long").alias("rank"))
    table, links, depth = PlacedTable(first.distinct(), ["start", "id"]), new_folder(edges.sparkSession, "links"), 0
    while max_depth is None or depth < max_depth:
        step = fan.send(levels(table, depth).select("start", "id", "rank"))
        offers = step.select("start", F.col("dst").alias("id"), "rank", "edge_id", F.col("id").alias("above"))
        depth += 1
        if all_ties:
            offers = cut(table.missing(offers))
            offers.withColumn("depth", F.lit(depth)).write.mode("append").parquet(links)
        best = offers.groupBy("start", "id").agg(F.min(F.struct("rank", "edge_id", "above")).alias("_b"))
        fresh = (best if all_ties else table.missing(best)).select("start", "id", F.lit(depth).alias("depth"), "_b.above", "_b.edge_id", F.col("_b.rank").alias("_rank"))
        table.add(sort_into_ranges(fresh, ["start", "_rank", "id"]).withColumn("rank", F.shiftleft("_range", 33) + F.col("_pos")))
        if levels(table, depth).isEmpty():
            break
    if all_ties:
        return _every_path(edges.sparkSession.read.parquet(links) if depth else None, first, depth)
    pairs = table.rows().where("depth > 0")
    met = ways_up(table.rows().select("start", "id", "above"), pairs.select("start", "id", F.col("id").alias("end"), "depth"), ["start"])
    on = met.join(table.rows().select("start", "id", "edge_id"), ["start", "id"])
    steps = F.array_sort(F.collect_list(F.struct((F.col("depth") - F.col("back")).alias("at"), "id", "edge_id")))
    return on.groupBy("start", "end", "depth").agg(steps.alias("_s")).select(
        "start", "end", "depth", F.transform("_s", lambda x: x["id"]).alias("node_ids"), F.transform(F.slice("_s", 2, F.col("depth")), lambda x: x["edge_id"]).alias("edge_ids")
    )


def _every_path(links: DataFrame | None, first: DataFrame, deepest: int) -> DataFrame:
    """All ways over ``links(start, id, above, edge_id, depth)``; the rows are the paths asked for."""
    level = first.select("start", F.col("id").alias("end"), "depth", F.array("id").alias("node_ids"), F.array().cast("array<bigint>").alias("edge_ids"))
    folder = new_folder(first.sparkSession, "paths")
    level.write.parquet(f"{folder}/d=0")
    for depth in range(1, deepest + 1):
        before = first.sparkSession.read.schema(level.schema).parquet(f"{folder}/d={depth - 1}").drop("depth")
        level = links.where(F.col("depth") == depth).join(before.withColumnRenamed("end", "above"), ["start", "above"]).select(
            "start", F.col("id").alias("end"), "depth", F.array_append("node_ids", F.col("id")).alias("node_ids"), F.array_append("edge_ids", F.col("edge_id")).alias("edge_ids")
        )
        level.write.parquet(f"{folder}/d={depth}")
    return first.sparkSession.read.schema(level.schema).parquet(*[f"{folder}/d={d}" for d in range(1, deepest + 1)] or [f"{folder}/d=0"]).where("depth > 0")


def _everywhere(hops: DataFrame, starts: DataFrame) -> bool:
    """Does a search begin, once, at every node that has an out-edge?"""
    if not hops.select(F.col("src").alias("id")).join(starts.select("id"), "id", "left_anti").isEmpty():
        return False
    return starts.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def _from_everywhere(hops: DataFrame, all_ties: bool, max_depth: int | None) -> DataFrame:
    """``shortest_paths`` from every node with an out-edge.

    A search against the edges from all ends gives the nodes at every distance, 64 ends to a row. A path then begins with an edge
    to a node one step nearer to its end and goes on as a path of that node, so paths grow at the front, level by level.

    Paths are put together in the tasks that return them, and nothing of them is written; only where the graph is too large for a task, rows travel.
    """
    back = hops.groupBy(F.col("dst").alias("src"), F.col("src").alias("dst")).agg(F.min("edge_id").alias("edge_id"))
    ends = hops.select(F.col("dst").alias("id")).distinct()
    every = hops.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "edge_id")
    held = resident(every if all_ties else back, ends, "edge_id")
    if held is not None:
        work = partial(_every_way if all_ties else _ways, max_depth=max_depth)
        return held.searched(work, "start long, end long, depth int, node_ids array<long>, edge_ids array<long>", 4, _WAYS_BYTES)
    backward = Fanout(back)
    search = reach_levels(backward, ends, max_depth)
    deepest = search.table.rows().agg(F.max("depth")).first()[0] or 0
    nothing = F.array().cast("array<bigint>")
    begun = search.numbers.select(F.col("source").alias("id"), "block", "bit", F.col("source").alias("end"), F.lit(0).alias("depth"), F.array("source").alias("node_ids"), nothing.alias("edge_ids"))
    if all_ties:
        parts = _tied_levels(Fanout(hops), search, begun, deepest)
    else:
        parts, before = [], begun
        for depth in range(1, deepest + 1):
            first = _first_edges(backward, search, depth).join(before.withColumnRenamed("id", "to"), ["block", "bit", "to"])
            before = settle(_grown(first, depth))
            parts.append(before)
    paths = reduce(DataFrame.unionAll, parts) if parts else begun.limit(0)
    return paths.select(F.col("id").alias("start"), "end", "depth", "node_ids", "edge_ids")


def _ways(graph: Held, blocks: Iterator[np.ndarray], max_depth: int | None) -> Iterator[pa.RecordBatch]:
    """The smallest path of every node to the ends of each block. The graph's edges are turned round: ``ptr`` and ``near`` give the nodes that an edge leads to."""
    for own in blocks:
        first = np.full((graph.n, len(own)), -1, "int32")  # the place of the first edge
        lane = np.arange(len(own))
        before = np.zeros((graph.n, -(-len(own) // 64)), "uint64")
        before[own, lane // 64] = np.uint64(1) << (lane % 64).astype("uint64")
        for depth, fresh in graph.levels(own, max_depth):
            _choose(graph, first, before, fresh)
            for node, end in _bits(fresh):
                for at in range(0, len(node), step := max(1, _PLACES_AT_ONCE // (depth + 1))):
                    nodes, ends, edges = [node[at : at + step]], end[at : at + step], []
                    for _ in range(depth):
                        edges.append(first[nodes[-1], ends])
                        nodes.append(graph.near[edges[-1]])
                    yield _paths(graph, graph.ids[own[ends]], nodes, edges)
            before = fresh


def _every_way(graph: Held, blocks: Iterator[np.ndarray], max_depth: int | None) -> Iterator[pa.RecordBatch]:
    """All shortest paths to the ends of each block; the graph's edges are turned round here too."""
    degree = np.diff(graph.ptr)
    for own in blocks:
        distance = np.full((len(own), graph.n), -1, "int32")
        for depth, fresh in graph.levels(own, max_depth):
            for node, end in _bits(fresh):
                distance[end, node] = depth
        for end, far in zip(own, distance):
            # the edges that lead one step nearer
            far[end] = 0
            wanted = far - 1
            wanted[end] = -2
            nearer = np.flatnonzero(far[graph.near] == np.repeat(wanted, degree))
            ptr = np.searchsorted(nearer, graph.ptr)
            order = np.argsort(far, kind="stable")
            for node in np.split(order, np.flatnonzero(np.diff(far[order])) + 1):
                if (depth := int(far[node[0]])) > 0:
                    yield from _longer(graph, ptr, nearer, graph.ids[end], depth, [node], [])


def _bits(fresh: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and place of the bits that are set."""
    lanes = 64 * fresh.shape[1]
    for at in range(0, len(fresh), step := max(1, _BITS_AT_ONCE // lanes)):
        row, place = np.divmod(np.flatnonzero(np.unpackbits(fresh[at : at + step].view("uint8"), bitorder="little")), lanes)
        yield row + at, place


def _choose(graph: Held, table: np.ndarray, before: np.ndarray, fresh: np.ndarray) -> None:
    """The place of the first edge, in their order, that leads one step nearer, for every node and end of a level."""
    left = fresh.copy()
    rows = np.flatnonzero(left.any(axis=1))
    flat = table.reshape(-1)

    def take(nodes: np.ndarray, places: np.ndarray, bits: np.ndarray) -> None:
        row, lane = np.divmod(np.flatnonzero(np.unpackbits(bits.view("uint8"), bitorder="little")), 64 * bits.shape[1])
        flat[nodes[row] * table.shape[1] + lane] = places[row]

    # all nodes try their first edge, then their second one; the few that go on for long are taken one by one
    for turn in range(_TURNS):
        rows = rows[graph.ptr[rows] + turn < graph.ptr[rows + 1]]
        if not len(rows):
            return
        places = graph.ptr[rows] + turn
        have = np.take(left, rows, axis=0)
        bits = have & np.take(before, graph.near[places], axis=0)
        hit = np.flatnonzero(bits.any(axis=1))
        for some in np.split(hit, range(_TURN_ROWS, len(hit), _TURN_ROWS)):
            take(rows[some], places[some], bits[some])
        have ^= bits
        left[rows] = have
        rows = rows[have.any(axis=1)]
    for node in rows:
        for at in range(graph.ptr[node] + _TURNS, graph.ptr[node + 1], _TURN_ROWS):
            places = np.arange(at, min(at + _TURN_ROWS, graph.ptr[node + 1]))
            bits = np.unpackbits((before[graph.near[places]] & left[node]).view("uint8"), axis=1, bitorder="little")
            lane = np.flatnonzero(bits.any(axis=0))
            table[node, lane] = places[bits[:, lane].argmax(axis=0)]
            left[node] &= ~np.bitwise_or.reduce(before[graph.near[places]], axis=0)
            if not left[node].any():
                break


def _longer(graph: Held, ptr: np.ndarray, nearer: np.ndarray, end: int, left: int, nodes: list, edges: list) -> Iterator[pa.RecordBatch]:
    """All ways with ``left`` more edges, of ``nearer``, behind the steps so far, ``nodes`` and ``edges``."""
    if not left:
        yield _paths(graph, np.full(len(nodes[0]), end), nodes, edges)
        return
    begin = ptr[nodes[-1]]
    degree = ptr[nodes[-1] + 1] - begin
    until = np.cumsum(degree)
    limit = max(1, _PLACES_AT_ONCE // len(nodes))
    for at in range(0, int(until[-1]), limit):
        taken = np.arange(at, min(at + limit, until[-1]))
        row = np.searchsorted(until, taken, "right")
        place = nearer[begin[row] + taken - (until - degree)[row]]
        yield from _longer(graph, ptr, nearer, end, left - 1, [*(x[row] for x in nodes), graph.near[place]], [*(x[row] for x in edges), place])


def _paths(graph: Held, ends: np.ndarray, nodes: list, edges: list) -> pa.RecordBatch:
    n, depth = len(ends), len(edges)

    def lists(steps: list, of: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(np.arange(n + 1, dtype="int32") * len(steps), of[np.stack(steps, axis=1).reshape(-1)])

    columns = [graph.ids[nodes[0]], ends, np.full(n, depth, "int32"), lists(nodes, graph.ids), lists(edges, graph.value)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["start", "end", "depth", "node_ids", "edge_ids"])


def _grown(first: DataFrame, depth: int) -> DataFrame:
    """Paths with one more node, ``id``, and the edge ``edge_id`` in front."""
    return first.select("id", "block", "bit", "end", F.lit(depth).alias("depth"), F.array_prepend("node_ids", F.col("id")).alias("node_ids"), F.array_prepend("edge_ids", F.col("edge_id")).alias("edge_ids"))


def _tied_levels(forward: Fanout, search: ReachSearch, ends: DataFrame, deepest: int) -> list[DataFrame]:
    """All shortest paths, a frame per level. Of a level up to ``_LAZY_DEPTH`` only the paths that longer ones go on with are written."""
    parts, before = [], ends

    def longer(nodes: DataFrame, depth: int) -> DataFrame:
        steps = forward.send(nodes).withColumnRenamed("dst", "to")
        met = steps.join(before.withColumnRenamed("id", "to"), ["block", "to"]).where("shiftrightunsigned(mask, bit) & 1 = 1")
        return _grown(met, depth)

    for depth in range(1, deepest + 1):
        nodes = levels(search.table, depth).select("block", "id", "mask")
        level = longer(nodes, depth)
        if depth > _LAZY_DEPTH:
            level = settle(level)
        parts.append(level)
        if depth < deepest and depth <= _LAZY_DEPTH:
            wanted = forward.send(levels(search.table, depth + 1).select("block", "id", "mask")).groupBy("block", F.col("dst").alias("id")).agg(F.bit_or("mask").alias("wanted"))
            some = nodes.join(wanted, ["block", "id"]).select("block", "id", F.col("mask").bitwiseAND(F.col("wanted")).alias("mask")).where("mask <> 0")
            before = settle(longer(some, depth))
        else:
            before = level
    return parts


def _first_edges(backward: Fanout, search: ReachSearch, depth: int) -> DataFrame:
    """``block, bit, id, to, edge_id``: the first edge of the smallest path of every pair of this depth.

    It leads to the smallest node that is one step nearer to the end. Per block and node come the mask of the ends at this depth and
    then, in order of their ids, the nodes reached by its edges with the masks of those they are nearer to; each takes what is left.
    """
    own = levels(search.table, depth).select("block", "id", F.lit(False).alias("offer"), F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("edge_id"), "mask")
    offers = backward.send(levels(search.table, depth - 1).select("block", "id", "mask")).select("block", F.col("dst").alias("id"), F.lit(True).alias("offer"), F.col("id").alias("to"), "edge_id", "mask")
    order = ["block", "id", "offer", "to"]
    placed = own.unionAll(offers).repartition("block", "id").sortWithinPartitions(*order)
    return placed.mapInArrow(_taken, "block long, bit int, id long, to long, edge_id long")


def _taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which offer takes each bit of its group; a group may go on in the next batch."""
    bits = np.arange(64, dtype=np.uint64)
    last, left = None, np.uint64(0)
    for batch in batches:
        if not batch.num_rows:
            continue
        block, node, to, edge, mask = (batch[c].to_numpy() for c in ("block", "id", "to", "edge_id", "mask"))
        offer, mask = batch["offer"].to_numpy(zero_copy_only=False), mask.view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (node[1:] != node[:-1])]))
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(block))))
        free = np.where(offer[starts], np.uint64(0), mask[starts])
        if (block[0], node[0]) == last:
            free[0] = left
        mask = np.where(offer, mask & free[group], np.uint64(0))
        last, left = (block[-1], node[-1]), free[-1] & ~np.bitwise_or.reduce(mask[starts[-1] :])
        row, bit = np.nonzero(mask[:, None] >> bits & np.uint64(1))
        taker = np.full(len(starts) * 64, len(block))
        np.minimum.at(taker, group[row] * 64 + bit, row)
        cell = np.flatnonzero(taker < len(block))
        at = taker[cell]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (block[at], (cell % 64).astype(np.int32), node[at], to[at], edge[at])], ["block", "bit", "id", "to", "edge_id"])


def path_length(path: str) -> Column:
    """length(p): number of edges."""
    return F.col(f"{path}_length")


def path_nodes(path: str) -> Column:
    """nodes(p): node ids in order."""
    return F.col(f"{path}_node_ids")


def path_edges(path: str) -> Column:
    """relationships(p): edge ids in order."""
    return F.col(f"{path}_edge_ids")
