"""Exact nearest-neighbour search: one query (H13–H17) and query batches.

Distances are computed on Arrow batches without copying the vectors. A batch
search keeps only k rows per query and partition before the single shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..ordered import dense_number
from ..session import cut

METRICS = ("l2", "l1", "cosine", "hamming")
# Queries go to the executors in chunks of this many numbers, their vectors and lists together (64 MB at most).
CHUNK_CELLS = 8_000_000
ROWS_OUT = 20_000  # queries whose lists make one batch of results
_CELLS_AT_ONCE = 4_000_000  # bound of a temporary distance matrix


# -- kernels ----------------------------------------------------------------------------------
def to_matrix(column: pa.Array) -> np.ndarray:
    """A list column as a two-dimensional array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if n and flat.size % n:
        raise ValueError("vectors of different dimensions in one column")
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def distances(metric: str, queries: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Matrix (queries × base) of distances in double precision, computed directly."""
    if queries.shape[1] != base.shape[1]:
        raise ValueError(f"query dimension {queries.shape[1]} differs from {base.shape[1]}")
    if metric == "hamming":
        # unsigned, because bit counting works on the absolute value of signed numbers
        b, q = np.ascontiguousarray(base).view("uint64"), np.ascontiguousarray(queries).view("uint64")
        return np.stack([np.bitwise_count(b ^ x).sum(axis=1) for x in q]).astype("float64")
    q, b = queries.astype("float64"), base.astype("float64")
    if metric == "cosine":
        return 1.0 - (q @ b.T) / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(b, axis=1))
    if metric == "l1":
        return np.stack([np.abs(b - x).sum(axis=1) for x in q])
    if metric == "l2":
        return np.stack([np.sqrt(np.square(b - x).sum(axis=1)) for x in q])
    raise ValueError(f"unknown metric {metric}; one of {METRICS}")


def _pair_distances(metric: str, q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each row of ``q`` to the same row of ``b``; equal pairs get equal values wherever they stand."""
    x, y = q.astype("float64"), b.astype("float64")
    if metric == "cosine":
        return 1.0 - (x * y).sum(axis=1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
    return np.sqrt(np.square(y - x).sum(axis=1))


def _scaled(metric: str, m: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The vectors (of length one for cosine) and their squares, as ``_rough`` compares them."""
    if metric == "cosine":
        m = m.astype("float64")
        m = m / np.linalg.norm(m, axis=1)[:, None]
    m = m.astype(kind)
    return m, np.square(m.astype("float64")).sum(axis=1)


def _rough(q: np.ndarray, b: np.ndarray, b2: np.ndarray) -> np.ndarray:
    """Squared l2 distances by one matrix product, less the queries' own squares.

    The product cancels badly for long vectors close to each other; ``TopK`` allows for that.
    """
    value = q @ (-2 * b).T
    value += b2.astype(value.dtype)
    return value


_HUGE = 1e15  # vectors with such components are compared in double precision
_MANY = 16  # so are blocks of which more than one pair in so many passes
_PAIRS_AT_ONCE = 1 << 16  # pairs measured exactly at a time
_NO_ID = np.iinfo("int64").max


class TopK:
    """The k nearest (distance, id) per query seen so far; ties go to the smaller id, undefined distances come last.

    A batch is compared with a block of queries at once: as many as make ``_CELLS_AT_ONCE`` pairs, ``block`` at most. What may
    enter a list by the rough value is measured exactly, so blocks and precision do not show in the result.
    """

    def __init__(self, metric: str, queries: np.ndarray, k: int, block: int | None = None):
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric}; one of {METRICS}")
        self.metric, self.k, self.block, self.queries = metric, k, block, queries
        self.dist = np.full((len(queries), k), np.nan)
        self.ids = np.full((len(queries), k), _NO_ID, dtype="int64")
        self.count = np.zeros(len(queries), dtype="int64")

    def add(self, ids: np.ndarray, base: np.ndarray, rows: np.ndarray | None = None, skip_self: np.ndarray | None = None) -> None:
        """Offer base vectors to the queries ``rows`` (all by default)."""
        rows = np.arange(len(self.queries)) if rows is None else rows
        if self.k == 0 or len(ids) == 0 or len(rows) == 0:
            return
        if self.queries.shape[1] != base.shape[1]:
            raise ValueError(f"query dimension {self.queries.shape[1]} differs from {base.shape[1]}")
        order = None if skip_self is None else np.argsort(ids, kind="stable")
        kinds = ("float32", "float64") if self._small(base) and self._small(self.queries) else ("float64",)
        ready = {}
        step = max(1, min(_CELLS_AT_ONCE // len(ids), self.block or len(rows)))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            own = None if skip_self is None else _places(skip_self[part], ids, order)
            if self.metric in ("hamming", "l1"):
                value = self._direct(part, base)
                r, c = self._passing(value, self._kth(part), own)
                self._merge(part[r], ids[c], value[r, c].astype("float64"))
                continue
            for kind in kinds:
                if kind not in ready:
                    ready[kind] = _scaled(self.metric, base, kind)
                b, b2 = ready[kind]
                q, q2 = _scaled(self.metric, self.queries[part], kind)
                # rounding of the product, of either side; both the values and the limit may be off by it
                slack = 4.0 * np.finfo(kind).eps * (q.shape[1] + 8) * (q2 + b2[np.isfinite(b2)].max(initial=0.0))
                kth = self._kth(part)
                limit = (2.0 * kth if self.metric == "cosine" else np.square(kth)) - q2
                value = _rough(q, b, b2)
                r, c = self._passing(value, limit, own, slack)
                if len(r) * _MANY <= value.size:
                    break
            for first in range(0, len(r), _PAIRS_AT_ONCE):
                some, near = part[r[first : first + _PAIRS_AT_ONCE]], c[first : first + _PAIRS_AT_ONCE]
                self._merge(some, ids[near], _pair_distances(self.metric, self.queries[some], base[near]))

    def _small(self, m: np.ndarray) -> bool:
        return m.dtype == np.float32 and bool(np.abs(m).max(initial=0.0) < _HUGE)

    def _direct(self, part: np.ndarray, base: np.ndarray) -> np.ndarray:
        if self.metric == "l1":
            return distances("l1", self.queries[part], base)
        # unsigned, because bit counting works on the absolute value of signed numbers
        q, b = np.ascontiguousarray(self.queries[part]).view("uint64"), np.ascontiguousarray(base).view("uint64")
        value = np.zeros((len(q), len(b)), dtype="uint8" if q.shape[1] <= 3 else "uint32")
        for word in range(q.shape[1]):
            value += np.bitwise_count(q[:, word, None] ^ b[None, :, word])
        return value

    def _kth(self, part: np.ndarray) -> np.ndarray:
        """The k-th distance of each query; infinite where there is none yet."""
        kth = self.dist[part, -1]
        return np.where(np.isnan(kth), np.inf, kth)

    def _passing(self, value: np.ndarray, limit: np.ndarray, own: tuple[np.ndarray, np.ndarray] | None, slack: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Row and column of the cells that may enter the lists; ``own`` cells never do."""
        open_ = np.flatnonzero(~np.isfinite(limit))
        if len(open_) and value.shape[1] > self.k:
            # k cells of this batch are enough to leave out what is farther than all of them
            some = value[open_].astype("float64")
            if own is not None:
                at = np.searchsorted(open_, own[0])
                at[at == len(open_)] = 0
                hit = open_[at] == own[0]
                some[at[hit], own[1][hit]] = np.inf
            limit = limit.copy()
            limit[open_] = np.partition(some, self.k - 1, axis=1)[:, self.k - 1]
        limit = limit + 2 * slack
        limit[np.isnan(limit)] = np.inf
        if value.dtype.kind == "u":
            passes = value <= np.minimum(limit, np.iinfo(value.dtype).max).astype(value.dtype)[:, None]
        else:
            # undefined values pass and are ranked last; a rounded limit must not become smaller
            rounded = np.nextafter(limit.astype(value.dtype), np.inf, dtype=value.dtype)
            passes = ~(value > rounded[:, None])
        if own is not None:
            passes[own] = False
        return np.divmod(np.flatnonzero(passes), value.shape[1])

    def _merge(self, rows: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> None:
        """Enter (distance, id) pairs into the lists of their rows."""
        last = self.dist[rows, -1]
        better = np.isnan(last) | (dist < last) | ((dist == last) & (ids < self.ids[rows, -1]))
        rows, ids, dist = rows[better], ids[better], dist[better]
        if not len(rows):
            return
        used = np.unique(rows)
        held = np.arange(self.k)[None, :] < self.count[used][:, None]
        all_r = np.concatenate([np.repeat(used, self.count[used]), rows])
        all_i, all_d = np.concatenate([self.ids[used][held], ids]), np.concatenate([self.dist[used][held], dist])
        order = np.lexsort((all_i, all_d, all_r))
        all_r, all_i, all_d = all_r[order], all_i[order], all_d[order]
        place = np.arange(len(all_r)) - np.searchsorted(all_r, all_r)
        best = place < self.k
        self.dist[all_r[best], place[best]], self.ids[all_r[best], place[best]] = all_d[best], all_i[best]
        self.count[used] = np.minimum(self.count[used] + np.bincount(np.searchsorted(used, rows), minlength=len(used)), self.k)

    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of all queries, one list after the other; ``count`` has their lengths."""
        held = np.arange(self.k)[None, :] < self.count[:, None]
        return self.ids[held], self.dist[held]

    def table(self, query_ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(query_ids), ROWS_OUT):
            rows = slice(at, at + ROWS_OUT)
            held = np.arange(self.k)[None, :] < self.count[rows, None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(query_ids[rows], self.count[rows]), pa.int64()),
                    pa.array(self.ids[rows][held], pa.int64()),
                    pa.array(self.dist[rows][held], pa.float64()),
                ],
                names=["query_id", "id", "distance"],
            )


def _places(wanted: np.ndarray, ids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every cell whose id is the wanted one of its row; ``order`` sorts ``ids``."""
    ordered = ids[order]
    low, high = np.searchsorted(ordered, wanted, "left"), np.searchsorted(ordered, wanted, "right")
    n = high - low
    begin = np.repeat(low - (np.cumsum(n) - n), n)
    return np.repeat(np.arange(len(wanted)), n), order[begin + np.arange(n.sum())]


PAIRS = "query_id long, id long, distance double"


# -- one query --------------------------------------------------------------------------------
def distance_to(vector: Column, query: Iterable[float], metric: str) -> Column:
    """Distance of each row's vector to one fixed query vector."""
    target = np.asarray(list(query), dtype="int64" if metric == "hamming" else "float64").reshape(1, -1)

    @F.arrow_udf("double")
    def measure(v: pa.Array) -> pa.Array:
        valid = v.drop_null()
        got = distances(metric, target, to_matrix(valid))[0] if len(valid) else np.empty(0)
        if len(valid) == len(v):
            return pa.array(got, pa.float64())
        full = np.full(len(v), np.nan)
        mask = v.is_valid().to_numpy(zero_copy_only=False)
        full[mask] = got
        return pa.array(full, pa.float64(), mask=~mask)

    return measure(vector)


def knn(
    base: DataFrame,
    query: Iterable[float],
    k: int,
    metric: str = "l2",
    id_col: str = "id",
    vector: str = "embedding",
    where: Column | None = None,
    ids: DataFrame | None = None,
    bounds: Column | None = None,
) -> DataFrame:
    """The k rows nearest to ``query``: ``id, distance``, nearest first.

    ``where`` filters before any distance is computed and reaches the Parquet scan
    or its partitions (H14, H15); ``ids`` is a candidate set (H16); ``bounds`` is a
    condition on ``distance``, applied before the k nearest are taken (H17).
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}; one of {METRICS}")
    if k < 0:
        raise ValueError("k must not be negative")
    rows = base if where is None else base.where(where)
    if ids is not None:
        rows = rows.join(ids.select(F.col(ids.columns[0]).alias(id_col)), id_col, "left_semi")
    rows = rows.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("id"), distance_to(F.col(vector), query, metric).alias("distance"))
    if bounds is not None:
        rows = rows.where(bounds)
    return rows.orderBy("distance", "id").limit(k)


# -- batches ----------------------------------------------------------------------------------
def nearest_k(pairs: DataFrame, k: int) -> DataFrame:
    """k best rows per query with their rank; Spark limits each partition before it shuffles."""
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


def query_chunks(queries: DataFrame, total: int, k: int) -> Iterator[pa.Table]:
    """The ``total`` queries (``query_id, qv``) chunk by chunk on the driver; ``CHUNK_CELLS`` holds the vectors of one and its lists of ``k``."""
    width = queries.agg(F.coalesce(F.max(F.size("qv")), F.lit(1))).first()[0]
    rows = max(1, CHUNK_CELLS // max(1, width + 2 * k))
    if total <= rows:
        yield queries.toArrow()
        return
    numbered = dense_number(queries, ["query_id"], "_n", 0)
    for at in range(0, total, rows):
        yield numbered.where((F.col("_n") >= at) & (F.col("_n") < at + rows)).drop("_n").toArrow()


def scan_chunks(queries: DataFrame, base: DataFrame, k: int, scanner) -> DataFrame:
    """``query_id, id, distance, rank``: one scan of the unshuffled base per chunk of queries.

    ``scanner(chunk)`` gives a broadcast variable, the base rows it needs, and the function that reads them.
    Chunks are independent; each is finished before the next, so that one is on the executors at a time.
    """
    found, total = None, queries.count()
    for chunk in query_chunks(queries, total, k):
        shared, some, scan = scanner(chunk)
        best = nearest_k(some.mapInArrow(scan, PAIRS), k)
        if chunk.num_rows < total:
            best = cut(best)
            shared.destroy()
        found = best if found is None else found.unionAll(best)
    return found


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    metric: str = "l2",
    query_id: str = "id",
    base_id: str = "id",
    vector: str = "embedding",
    skip_self: bool = False,
    chunk_rows: int | None = None,
) -> DataFrame:
    """``query_id, id, distance, rank`` of the k nearest base rows per query.

    The base is scanned once per chunk of queries, without a shuffle of vectors. Within a scan, ``chunk_rows`` queries at most
    are compared with a batch at a time; the number of scans does not depend on it.
    """
    base = base.where(F.col(vector).isNotNull()).select(F.col(base_id).cast("long").alias("id"), F.col(vector).alias("v"))
    q = queries.select(F.col(query_id).cast("long").alias("query_id"), F.col(vector).alias("qv"))

    def scanner(chunk: pa.Table):
        shared = base.sparkSession.sparkContext.broadcast((chunk["query_id"].to_numpy(), to_matrix(chunk["qv"])))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qid, matrix = shared.value
            top = TopK(metric, matrix, k, chunk_rows)
            for batch in batches:
                if batch.num_rows:
                    top.add(batch["id"].to_numpy(), to_matrix(batch["v"]), skip_self=qid if skip_self else None)
            yield from top.table(qid)

        return shared, base, scan

    return scan_chunks(q, base, k, scanner)
