"""Exact top-k search by inner product over norm-sorted vectors.

Vectors are scanned by descending length. They and the queries are turned into the basis
of the base's singular vectors, where the first coordinates carry most of every product:
the product of those, plus the product of the two remaining lengths (Cauchy-Schwarz),
bounds the whole. Only pairs whose bound reaches the query's k-th best score so far are
computed in full, in integers. A query starts with the k-th best score among the longest
vectors, so most partitions of shorter ones drop it by lengths alone.

Queries go to the executors in blocks of ``QUERY_BLOCK`` rows, one scan of the unshuffled
base for each; a partition returns k rows per query at most. The rotation comes from
sums of products, dimension squared many.

Vectors are arrays of whole numbers below 2^53. Shorter arrays count as padded with zeros.
Rows with a null id, or a vector that is null or holds a null, take no part. Repeated
rows count once; a row is not its own candidate, nor are others with its id. Ties go to
the smaller id. A score that no 64-bit integer holds is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..ordered import dense_number
from ..session import cut

QUERY_BLOCK = 4096
LEADERS = 4096
EXACT = 2.0**53
ENERGY = 0.9  # share of the lengths that the first coordinates should carry


def whole_numbers(vector: Column, scale: float) -> Column:
    """Components times ``scale``, rounded down; null if one is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return F.when(vector.isNotNull() & ~bad, scaled)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    lengths = np.diff(offsets)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    if len(lengths) and (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = values
    return out


def _gram(base: DataFrame, dims: int) -> np.ndarray:
    """Sum of the vectors' outer products."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0), dims).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], ["at", "sum"])

    sums = base.select("vec").mapInArrow(partial, "at long, sum double").groupBy("at").agg(F.sum("sum").alias("sum")).collect()
    out = np.zeros(dims * dims)
    for r in sums:
        out[r["at"]] = r["sum"]
    return out.reshape(dims, dims)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact products of paired rows."""
    if len(q) and np.abs(q).max() * float(np.abs(x).max()) * q.shape[1] >= 2.0**62:
        out = [sum(a * b for a, b in zip(u, v, strict=True)) for u, v in zip(q.tolist(), x.tolist(), strict=True)]
        return np.array(out, np.int64)  # raises beyond 64 bits
    return np.einsum("ij,ij->i", q, x)


def _best(number: np.ndarray, ident: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows of each query, by query and rank."""
    order = np.lexsort((ident, -score, number))
    n = number[order]
    first = np.searchsorted(n, n)
    return order[np.arange(len(n)) - first < k]


class _Search:
    """The queries of one block with their best rows so far."""

    def __init__(self, numbers, idents, vectors, rotation, lead, k):
        self.number, self.ident, self.vec, self.k, self.lead, self.rotation = numbers, idents, vectors, k, lead, rotation
        turned = vectors @ rotation
        self.length = np.sqrt((vectors.astype(float) ** 2).sum(1))
        self.front = turned[:, :lead]
        self.rest = np.sqrt((turned[:, lead:] ** 2).sum(1))
        self.least = np.full(len(numbers), -np.inf)
        self.rows = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def offer(self, ident: np.ndarray, x: np.ndarray, length: np.ndarray) -> None:
        """Look at base rows; a few hundred at a time keeps the bounds tight and the arrays small."""
        live = np.flatnonzero(self.length * length.max() * (1 + 1e-9) + 1e-6 >= self.least)
        if not len(live):
            return
        turned = x @ self.rotation
        front, rest = turned[:, : self.lead], np.sqrt((turned[:, self.lead :] ** 2).sum(1))
        for some in np.array_split(live, len(live) // 512 + 1):
            bound = self.front[some] @ front.T + self.rest[some, None] * rest
            slack = 1e-9 * self.length[some, None] * length + 1e-6
            a, b = np.nonzero((bound + slack >= self.least[some, None]) & (self.ident[some, None] != ident))
            a = some[a]
            for part in range(0, len(a), 1 << 18):
                pa_, pb = a[part : part + (1 << 18)], b[part : part + (1 << 18)]
                score = _scores(self.vec[pa_], x[pb])
                good = score >= self.least[pa_]
                self._keep(pa_[good], ident[pb[good]], score[good])

    def _keep(self, at: np.ndarray, ident: np.ndarray, score: np.ndarray) -> None:
        at, ident, score = (np.concatenate(p) for p in zip(self.rows, (at, ident, score), strict=True))
        best = _best(at, ident, score, self.k)
        self.rows = at[best], ident[best], score[best]
        counts = np.bincount(self.rows[0], minlength=len(self.least))
        full = np.flatnonzero(counts == self.k)
        ends = np.cumsum(counts)
        self.least[full] = np.maximum(self.least[full], self.rows[2][ends[full] - 1])


def top_k(base: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec", query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, <id_col>, score``: the k best base rows per query row."""
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = base.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        big = F.exists("vec", lambda v: F.abs(v) >= int(EXACT))
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<bigint>").alias("vec"))
        rows = rows.where("id is not null and vec is not null and not exists(vec, v -> v is null)").dropDuplicates()
        return rows.withColumn("vec", F.when(big, F.raise_error(F.lit("vector component out of range"))).otherwise(F.col("vec")))

    schema = T.StructType().add("query_id", "long").add("rank", "integer").add(id_col, "long").add("score", "long")
    square = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    by_length = [F.desc("length"), F.asc("id")]
    base = cut(clean(base).withColumn("length", F.sqrt(square)).repartitionByRange(*by_length).sortWithinPartitions(*by_length))
    numbered = cut(dense_number(clean(queries), ["id", "vec"], "number", 0))
    asked = numbered.count()
    dims = max(x.agg(F.coalesce(F.max(F.size("vec")), F.lit(0))).first()[0] for x in (base, numbered))
    if not asked or not dims:
        return spark.createDataFrame([], schema)
    values, vectors = np.linalg.eigh(_gram(base, dims))
    rotation = vectors[:, ::-1]
    energy = np.cumsum(np.maximum(values[::-1], 0))
    lead = int(np.searchsorted(energy, ENERGY * energy[-1])) + 1 if energy[-1] > 0 else 1
    leaders = base.orderBy(*by_length).limit(LEADERS).select("id", "vec", "length").toArrow()
    found = []
    for start in range(0, asked, query_block):
        block = numbered.where((F.col("number") >= start) & (F.col("number") < start + query_block)).select("number", "id", "vec").toArrow()
        search = _Search(block["number"].to_numpy(), block["id"].to_numpy(), _matrix(block["vec"], dims), rotation, lead, k)
        if leaders.num_rows:
            search.offer(leaders["id"].to_numpy(), _matrix(leaders["vec"], dims), leaders["length"].to_numpy())
        empty = (np.zeros(0, np.int64),) * 3
        search.rows = empty  # only the bound is kept: the scan meets these rows again
        sent = spark.sparkContext.broadcast(search)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            search = sent.value
            known, search.least = search.least, search.least.copy()
            search.rows = (np.zeros(0, np.int64),) * 3
            for batch in batches:
                ident, length = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                x = _matrix(batch.column(1), dims)
                for at in range(0, batch.num_rows, 1024):
                    search.offer(ident[at : at + 1024], x[at : at + 1024], length[at : at + 1024])
            at, ident, score = search.rows
            search.least = known  # the worker may scan another partition
            yield pa.RecordBatch.from_arrays([pa.array(search.number[at]), pa.array(search.ident[at]), pa.array(ident), pa.array(score)], ["number", "query_id", "id", "score"])

        rows = base.mapInArrow(scan, "number long, query_id long, id long, score long")
        rank = F.row_number().over(W.partitionBy("number").orderBy(F.desc("score"), "id"))
        best = rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
        found.append(cut(best) if asked > query_block else best)
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, b.vec_id, list_inner_product(q.vec, b.vec)::BIGINT AS score
  FROM v q JOIN v b ON q.vec_id % 50 = 0 AND q.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
