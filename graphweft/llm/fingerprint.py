"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame functions only.

A sketch holds the ``k`` smallest of the ``BITS``-bit hashes of a text's distinct shingles of
``SHINGLE`` words, ascending. The sketch of a union is the ``k`` smallest of both sketches
together, so parts can be sketched apart and merged. From two sketches follow
resemblance, containment and the number of distinct shingles; with fewer than ``k``
shingles a sketch is the whole set and these are exact.

A text with fewer words has one shingle, all of its words; a null, empty or blank text
has none and an empty fingerprint. Two empty sketches resemble each other fully, an empty
and another one not at all. Words are what ASCII white space parts; letters keep
their case. Texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

K = 256
SHINGLE = 5
BITS = 40
_DIGITS = BITS // 4
_LOWEST = -(1 << 63)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _hash(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 64 - BITS)


def shingles(text: Column, n: int = SHINGLE) -> Column:
    """Hashes of all shingles, with repeats."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")

    def all_of(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: _hash(*[F.get(w, i + j) for j in range(n)]))
        return F.when(F.size(w) >= n, runs).when(F.size(w) > 0, F.array(_hash(w))).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), all_of)


def _smallest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def sketch(text: Column, k: int = K, n: int = SHINGLE) -> Column:
    return _smallest(F.array_distinct(shingles(text, n)), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return _smallest(F.array_union(a, b), k)


def merge_by(parts: DataFrame, keys: list[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from any number of parts; no more than ``k`` hashes of a key leave a task."""
    hashes = parts.select(*keys, F.explode_outer(sketch_col).alias("_hash")).distinct()
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.col("_hash").asc_nulls_last()))
    return hashes.withColumn("_place", place).where(F.col("_place") <= k).groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of the shingle sets, 0 to 1."""
    shared = F.size(F.array_intersect(merge(a, b, k), F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(shared / F.size(merge(a, b, k)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * float(1 << BITS) / (F.element_at(a, -1) + 1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has too; 1 for an empty first."""
    likeness = resemblance(a, b, k)
    shared = likeness / (1 + likeness) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def to_text(a: Column) -> Column:
    """A sketch as a compact string."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), _DIGITS, "0")), "")))


def from_text(s: Column) -> Column:
    digits = F.hex(F.unbase64(s))
    each = F.sequence(F.lit(0), (F.length(digits) / _DIGITS).cast("int") - 1)
    return F.when(F.length(s) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(each, lambda i: F.conv(F.substring(digits, i * _DIGITS + 1, F.lit(_DIGITS)), 16, 10).cast("long"))
    )


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at or below the key, found in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    coarse, fine = (F.array(*[F.lit(b) for b in x]) for x in (bounds[::step], bounds))
    at_or_below = lambda array: F.size(F.filter(array, lambda b: b <= key))
    return _let(at_or_below(coarse), lambda c: F.when(c == 0, F.lit(0)).otherwise((c - 1) * step + at_or_below(F.slice(fine, (c - 1) * step + 1, F.lit(step)))))


def with_next(docs: DataFrame, id_col: str, text_col: str, prepare: Callable[[DataFrame], DataFrame], next_cols: list[str]) -> DataFrame:
    """``docs`` with ``next_<col>`` of the following row in descending id order; the first row follows the last.

    Ids are integers; null comes last, equal ids go by text. Rows are dealt to id
    ranges once, and ``prepare`` adds columns behind that exchange. The first row of each
    range is also sent to the range before it, so that no range has to look into another.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx(key, shares, 20 * ranges)).first()[0] or []
    placed = docs.withColumn("_key", key).withColumn("_range", _range_of(F.col("_key"), sorted(set(bounds))))
    heads = sorted((r["_range"], r["_head"]) for r in placed.groupBy("_range").agg(F.max("_key").alias("_head")).collect())  # one row per range
    if not heads:
        heads = [(0, 0)]
    head = F.array(*[F.lit(h) for _, h in heads])
    before = F.array(*[F.lit(r) for r, _ in heads[1:]], F.lit(heads[0][0]))
    at = _range_of(F.col("_range"), [r for r, _ in heads])  # place of the range among those with rows
    copies = F.array(
        F.struct(F.col("_range").alias("r"), F.lit(False).alias("copy")),
        F.when(F.get(head, at - 1) == F.col("_key"), F.struct(F.get(before, at - 1).alias("r"), F.lit(True).alias("copy"))),
    )
    dealt = placed.withColumn("_to", F.explode(F.filter(copies, lambda c: c.isNotNull()))).withColumn("_range", F.col("_to.r")).withColumn("_copy", F.col("_to.copy")).drop("_to")
    ready = prepare(dealt.repartition("_range"))
    order = W.partitionBy("_range").orderBy("_copy", F.desc("_key"), F.col(text_col).asc_nulls_first())
    following = ready.withColumn("_next", F.lead(F.struct(*[F.col(c).alias(c) for c in next_cols])).over(order)).where("not _copy")
    return following.select(*[c for c in ready.columns if c not in ("_key", "_range", "_copy")], *[F.col("_next").getField(c).alias(f"next_{c}") for c in next_cols])
