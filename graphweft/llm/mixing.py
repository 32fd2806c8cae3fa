"""Mixing sources to target weights: equal-token blocks, apportioned by highest quotients.

Sizes are words. The mix is ``share`` times everything. Sources, ordered by code
point with null last, take the weights in turn; a target above ``most`` times its
source's size stops there and the excess is shared anew by weight.

The blocks of the whole mix, ``BLOCK`` words each, go one by one to the source with the highest quotient
target / (2 a + 1), a being the blocks it has (Sainte-Laguë; ties: code point order), so a source's quota is within a
block or so of its target, however many shards there are. ``apportion`` finds the quotient at which the blocks
run out by narrowing an interval over the table of sources and deals the last few in order; no row per block is made.

Documents are dealt to shards of about ``SHARD_DOCS`` rows by a seeded hash, so a
source that holds a third of all rows is spread over all shards. A shard's quota of a source is the difference of the
source's quota at the words before and after the shard, rounded down: whole words that add up to the quota. The quota
lies along the source's documents in seeded order; one above the source's size in
the shard takes whole passes first and words from the start of the order then.

Nulls: a null source is a source, a null text has size 0, a null id is ordinary.
Repeated rows are separate documents. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..ordered import dense_number, running_sum
from ..session import cut
from .common import WORD, count_words, groups_for

BLOCK = 64
SHARD_DOCS = 8192
WEIGHTS = (5, 2, 1)
SEED = "mix-1"


def _seeded(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from a row per source."""
    ranked = dense_number(sizes, [F.col("source").asc_nulls_last()], "_rank")
    ranked = cut(ranked.withColumn("_w", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words per unit of weight; every round caps more sources and raises it
    while True:
        capped = F.col("_w") * F.lit(level) > F.lit(most) * F.col("source_size")
        held, weight = ranked.agg(F.sum(F.when(capped, F.col("source_size"))), F.sum(F.when(~capped, F.col("_w")))).first()
        new = (share * total - most * (held or 0)) / weight if weight else level
        if new <= level:
            break
        level = new
    return ranked.select("source", "source_size", F.when(capped, F.lit(most) * F.col("source_size")).otherwise(F.col("_w") * F.lit(level)).cast("double").alias("target"))


def apportion(targets: DataFrame, block: int = BLOCK, most: float = 2.0) -> DataFrame:
    """``source, source_size, target, _words``: the words of every source's blocks, at most ``most`` times its size."""
    targets = cut(targets)
    total, high = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0)), F.max("target")).first()
    blocks = math.floor(total / block + 0.5)

    def above(quotient: Column) -> Column:
        """How many of the source's quotients lie above this one."""
        return F.greatest(F.ceil((F.col("target") / quotient - 1) / 2), F.lit(0)).cast("long")

    # at `least` the blocks do not suffice, at `high` they do; until no source has two quotients between
    high, least = 2.0 * (high or 1.0), 0.0
    for _ in range(64):
        spread = [least + (high - least) * i / 32 for i in range(1, 32)]
        counts = targets.agg(*[F.sum(above(F.lit(q))) for q in spread]).first() if blocks else []
        fits = [q for q, n in zip(spread, counts, strict=False) if n <= blocks]
        tight = [q for q, n in zip(spread, counts, strict=False) if n > blocks]
        narrower = (max(tight, default=least), min(fits, default=high))
        if not blocks or narrower == (least, high):
            break
        least, high = narrower
        if least and targets.where(above(F.lit(least)) - above(F.lit(high)) > 1).isEmpty():
            break
    given = targets.withColumn("_given", above(F.lit(high)) if blocks else F.lit(0).cast("long"))
    left = blocks - (given.agg(F.sum("_given")).first()[0] or 0)
    following = given.where(above(F.lit(least)) > F.col("_given")) if blocks and least else given.where("false")
    last = dense_number(following.withColumn("_quotient", F.col("target") / (2 * F.col("_given") + 1)), [F.desc("_quotient"), F.col("source").asc_nulls_last()], "_n").where(F.col("_n") <= left)
    one_more = last.select(F.col("source").alias("_source"), F.lit(1).cast("long").alias("_more"))
    joined = given.join(one_more, F.col("source").eqNullSafe(F.col("_source")), "left")
    words = F.least((F.col("_given") + F.coalesce("_more", F.lit(0))) * block, F.floor(F.lit(most) * F.col("source_size")))
    return cut(joined.select("source", "source_size", "target", words.cast("long").alias("_words")))


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5, most: float = 2.0, block: int = BLOCK, shard_docs: int = SHARD_DOCS, seed: str = SEED, keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, size, source, source_size, target, taken`` and the columns in ``keep``, a row per document.

    ``taken`` is the number of words the mix takes: ``taken div size`` whole passes
    and the first ``taken mod size`` words once more.
    """
    shards = groups_for(docs.count(), shard_docs)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), count_words(F.col(text_col)).alias("size"),
        _seeded(F.col(id_col), seed).alias("_seed"), *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
    ).withColumn("_shard", F.pmod(F.conv(F.substring("_seed", 1, 8), 16, 10).cast("long"), F.lit(shards)))
    cells = cut(rows.groupBy("_shard", "source").agg(F.sum("size").alias("_cell")))
    targets = source_targets(cells.groupBy("source").agg(F.sum("_cell").alias("source_size")), weights, share, most)
    quotas = apportion(targets, block, most)
    # a hot source has a cell in every shard; the sum runs over ranges of cells
    summed = running_sum(cells.withColumn("_named", F.col("source").isNotNull()).withColumn("source", F.coalesce("source", F.lit(""))), ["_named", "source"], ["_shard"], F.col("_cell"), "_upto")
    summed = summed.withColumn("source", F.when(F.col("_named"), F.col("source")))
    part = lambda words: F.call_function("div", F.col("_words").cast("decimal(19,0)") * words.cast("decimal(19,0)"), F.greatest(F.col("source_size"), F.lit(1)).cast("decimal(19,0)"))
    quota = cut(
        summed.alias("c").join(quotas.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select(
            "c._shard", "c.source", "c._cell", "t.source_size", "t.target", (part(F.col("_upto")) - part(F.col("_upto") - F.col("_cell"))).cast("long").alias("_quota")
        )
    )
    inside = W.partitionBy("_shard", "source").orderBy("_seed", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.alias("d").join(quota.alias("q"), (F.col("d._shard") == F.col("q._shard")) & F.col("d.source").eqNullSafe(F.col("q.source")))
    once_more = F.greatest(F.lit(0), F.least(F.col("size"), F.expr("_quota % _cell") - F.col("_before")))
    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.expr("_quota div _cell") * F.col("size") + once_more)
    return joined.select(
        "doc_id", "size", F.col("d.source").alias("source"), "source_size", "target", taken.cast("long").alias("taken"),
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
    )


def first_words(text: Column, count: Column, size: Column) -> Column:
    """A text up to the end of its ``count``-th word; whole if it has only ``size`` = ``count``."""

    @F.arrow_udf("string")
    def head(texts: pa.Array, counts: pa.Array, sizes: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), counts.to_pylist(), sizes.to_pylist(), strict=True)
        return pa.array([t if n >= s else _up_to(t, n) for t, n, s in rows], pa.string())

    return head(text, count, size)


def _up_to(text: str, n: int) -> str:
    last = next(islice(re.finditer(WORD, text), n - 1, None), None) if n > 0 else None
    return text[: last.end()] if last else ""


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS seed
  FROM documents),
n AS (SELECT greatest(1, ceil(count(*) / 8192))::BIGINT AS shards, sum(size)::BIGINT AS total FROM sized),
rows AS (SELECT sized.*, ('0x' || substr(seed, 1, 8))::BIGINT % shards AS shard FROM sized, n),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
ranked AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT total FROM n) - 2.0::DOUBLE * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS try_level
  FROM ranked WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST)),
level AS (SELECT try_level AS l FROM levels WHERE w * try_level <= 2.0::DOUBLE * source_size ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN w * l > 2.0::DOUBLE * source_size THEN 2.0::DOUBLE * source_size ELSE w * l END AS target FROM ranked, level),
total AS (SELECT floor(sum(target) / 64 + 0.5::DOUBLE) AS blocks FROM targets),
quotients AS (
  SELECT source, target / (2 * a + 1) AS quotient
  FROM (SELECT *, unnest(range(0, ceil(2.0::DOUBLE * target / 64)::BIGINT + 2)) AS a FROM targets WHERE target > 0)),
quota AS (
  SELECT source, count(*) AS quota
  FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST) AS k FROM quotients), total WHERE k <= blocks GROUP BY source),
words AS (
  SELECT t.source, source_size, target, least(coalesce(q.quota, 0) * 64, 2 * source_size)::HUGEINT AS words
  FROM targets t LEFT JOIN quota q ON t.source IS NOT DISTINCT FROM q.source),
cells AS (SELECT shard, source, cell, (sum(cell) OVER (PARTITION BY source ORDER BY shard))::HUGEINT AS upto FROM (SELECT shard, source, sum(size)::BIGINT AS cell FROM rows GROUP BY shard, source)),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY shard, source ORDER BY seed, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM rows),
cut AS (
  SELECT c.*, source_size, target, (words * upto // greatest(source_size, 1) - words * (upto - cell) // greatest(source_size, 1))::BIGINT AS words
  FROM cells c JOIN words w ON c.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (words // cell) * size + greatest(0, least(size, words % cell - before)) END::BIGINT AS taken
FROM placed p JOIN cut c ON p.shard = c.shard AND p.source IS NOT DISTINCT FROM c.source
"""
