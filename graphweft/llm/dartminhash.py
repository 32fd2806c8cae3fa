"""Near-duplicate classes by DartMinHash signatures, banded joining and an exact check.

A text is the weighted set of its word shingles, the weight being the number of
occurrences. Hashed darts fall on the plane of weight and rank at rate one: over every unit of an
element's weight the ranks of its darts are the arrivals of a Poisson process drawn from
the element's hash, so two texts that share an element share its darts. A text throws
up to the rank at which it expects ``k ln k + 2 k`` darts in its region; each dart
picks one of k coordinates and every coordinate keeps its earliest. Coordinates that stay
empty are thrown for again up to twice the rank. Two signatures agree in a coordinate
with the weighted Jaccard likeness as probability.

``BANDS`` bands of ``ROWS`` coordinates are joined: texts that agree on a band meet in a
bucket, with likeness 0.8 in at least one with probability 0.9993. Equal texts are one
node from the start. In a bucket the member with the most company over all its buckets is the
head; every other is compared with it exactly, and the links give classes. Members of
the head's class need nothing from each other. Those outside it meet the members of
other classes in blocks of about ``BLOCK`` rows, whatever the bucket's size. In a block
pair, texts of different classes whose whole signatures agree to at least 0.8 less
``MARGIN`` (with likeness 0.8 one pair in a thousand does not) are compared exactly too,
and only the links leave it.

Result: a row per row of the input with the class, the smallest id of its members. Links
inside a class are not counted, since pairs that cannot change a class are never compared. Null
and empty texts are equal; blank texts have no shingles and only equal texts join them.
Null ids have a class like others, null if all ids in it are null. Repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..graph import Graph
from ..operators.components import wcc
from ..session import cut, new_folder
from . import words
from .common import parts_of

SHINGLE = 5
NEAR = 0.8
BANDS, ROWS = 24, 6
MARGIN = 0.1
BLOCK = 256  # rows of a bucket that meet as many others at a time
MANY = 1024  # pairs of two blocks for which every text is hashed once, instead of both texts of every pair
_PART = 1 << 20  # bytes of texts signed or compared at once; the arrays of their darts are some fifty times as large
_UNIT = 2.0**-53


def _uniform(h: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((h >> np.uint64(11)).astype(float) + 1) * _UNIT


def signatures(owner: np.ndarray, item: np.ndarray, weight: np.ndarray, owners: int, k: int) -> np.ndarray:
    """An (owners, k) array of dart hashes; rows of owners without items are 0."""
    total = np.bincount(owner, weights=weight, minlength=owners)
    out = np.zeros((owners, k), np.uint64)
    # one cell per unit of weight; the last may be a part of one
    cells = np.ceil(weight).astype(np.int64)
    cell_owner, cell_item = np.repeat(owner, cells), np.repeat(item, cells)
    cell = np.arange(len(cell_owner)) - np.repeat(np.cumsum(cells) - cells, cells)
    width = np.minimum(1.0, np.repeat(weight, cells) - cell)
    cell_hash = words.combined(cell_item, cell.astype(np.uint64))
    reach = np.where(total > 0, (k * np.log(max(k, 2)) + 2 * k) / np.maximum(total, 1e-300), 0)
    missing = total > 0
    while missing.any():
        live = np.flatnonzero(missing[cell_owner])
        rank, limit, hashes = np.zeros(len(live)), reach[cell_owner[live]], cell_hash[live]
        best = np.full(owners * k, np.inf)
        slots, ranks, darts = [], [], []
        arrival = 0
        while len(live):
            arrival += 1
            dart = words.combined(hashes, np.full(len(live), arrival, np.uint64))
            rank = rank - np.log(_uniform(dart))
            near = rank < limit
            live, rank, limit, hashes, dart = live[near], rank[near], limit[near], hashes[near], dart[near]
            if not len(live):
                break
            pick = words.mixed(dart)
            inside = _uniform(words.mixed(pick + np.uint64(1))) <= width[live]
            slots.append((cell_owner[live] * k + (pick % np.uint64(k)).astype(np.int64))[inside])
            ranks.append(rank[inside])
            darts.append(dart[inside])
        slot, rank, dart = (np.concatenate(x) if x else np.zeros(0) for x in (slots, ranks, darts))
        if len(slot):
            np.minimum.at(best, slot, rank)
            hit = rank == best[slot]
            done = np.isfinite(best).reshape(owners, k).all(1) & missing
            hit &= done[slot // k]
            out.reshape(-1)[slot[hit]] = dart[hit]
            missing &= ~done
        reach = np.where(missing, 2 * reach, reach)
    return out


def _coordinates(texts: pa.Array, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of texts, and which of them have any shingle."""
    owner, shingle = words.shingle_hashes(texts, n)
    owner, shingle, times = words.counted(owner, shingle)
    return signatures(owner, shingle, times.astype(float), len(texts), k), np.bincount(owner, minlength=len(texts)) > 0


def _lists(x: np.ndarray, has: np.ndarray) -> pa.Array:
    """Rows as lists, empty where a text has no shingle."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has * x.shape[1])]), pa.int32()), pa.array(x[has].ravel()))


def _banded(texts: pa.Array, n: int, bands: int, rows: int) -> pa.Array:
    """A hash per band."""
    found, has = _coordinates(texts, n, bands * rows)
    parts = found.reshape(len(texts), bands, rows)
    keys = words.combined(*[parts[:, :, i].ravel() for i in range(rows)], np.tile(np.arange(bands, dtype=np.uint64), len(texts)))
    return _lists(keys.view(np.int64).reshape(len(texts), bands), has)


def _signs(texts: pa.Array, n: int, k: int) -> pa.Array:
    """32 bits of every coordinate."""
    found, has = _coordinates(texts, n, k)
    return _lists((found >> np.uint64(32)).astype(np.uint32).view(np.int32), has)


def likeness(left: pa.Array, right: pa.Array, n: int) -> np.ndarray:
    """Weighted Jaccard likeness of paired texts, exact; 1 for two without shingles."""
    sides = []
    for texts in (left, right):
        owner, shingle = words.shingle_hashes(texts, n)
        owner, shingle, times = words.counted(owner, shingle)
        sides.append((words.combined(owner.astype(np.uint64), shingle), owner, times, np.bincount(owner, weights=times, minlength=len(texts))))
    (a, owner, times, total_a), (b, _, other, total_b) = sides
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = np.bincount(owner[in_a], weights=np.minimum(times[in_a], other[in_b]), minlength=len(left))
    union = total_a + total_b - shared
    return np.where(union > 0, shared / np.maximum(union, 1), 1.0)


def _occurrences(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and item of every shingle, the k-th occurrence of one being an item of its own."""
    owners, items = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    step = max(1, _PART // max(1, texts.nbytes // max(1, len(texts))))
    for at in range(0, len(texts), step):
        owner, shingle, times = words.counted(*words.shingle_hashes(texts.slice(at, step), n))
        which = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        owners.append(np.repeat(owner, times).astype(np.int64) + at)
        items.append(words.combined(np.repeat(shingle, times), which.astype(np.uint64)))
    return np.concatenate(owners), np.concatenate(items)


def _grid(left: pa.Array, right: pa.Array, n: int, width: int = 2048) -> np.ndarray:
    """``likeness`` of every text of one block and every one of another: each is hashed once, items are counted ``width`` at a time."""
    sides = [_occurrences(t, n) for t in (left, right)]
    common = np.intersect1d(sides[0][1], sides[1][1])
    shared, placed = np.zeros((len(left), len(right))), []
    for owner, item in sides:
        at = np.searchsorted(common, item)
        hit = np.flatnonzero(at < len(common))
        hit = hit[common[at[hit]] == item[hit]]
        order = hit[np.argsort(at[hit], kind="stable")]
        placed.append((owner[order], at[order]))
    for low in range(0, len(common), width):
        parts = []
        for (owner, at), texts in zip(placed, (left, right), strict=True):
            some = slice(*np.searchsorted(at, [low, low + width]))
            part = np.zeros((len(texts), width), np.float32)
            part[owner[some], at[some] - low] = 1
            parts.append(part)
        shared += parts[0] @ parts[1].T
    totals = [np.bincount(owner, minlength=len(t)) for (owner, _), t in zip(sides, (left, right), strict=True)]
    union = totals[0][:, None] + totals[1] - shared
    return np.where(union > 0, shared / np.maximum(union, 1), 1.0)


def _links(left: pa.Table, right: pa.Table, near: float, n: int, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of two blocks of a bucket that are near-duplicates of different classes, each in the first band it shares."""
    ids, kinds = ([t[c].to_numpy() for t in (left, right)] for c in ("node", "class"))
    band = left["band"][0].as_py()
    one, two = (t["signs"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, bands * rows) for t in (left, right))
    found = []
    for at in range(0, len(one), 16):
        same = one[at : at + 16, None] == two[None]
        alike = np.add.reduce(same.view(np.uint8), axis=2, dtype=np.uint16 if bands * rows > 255 else np.uint8)
        # few pairs are that much alike; only for them the band in which they meet first is looked for
        some = np.nonzero((alike >= (near - MARGIN) * bands * rows) & (kinds[0][at : at + 16, None] != kinds[1]))
        shared = same[some].reshape(-1, bands, rows).all(2)
        some = [x[shared.any(1) & (shared.argmax(1) == band)] for x in some]
        found.append((some[0] + at, some[1]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    value = [np.zeros(0)]
    texts = [t["text"].combine_chunks() for t in (left, right)]
    if len(i) > MANY:
        value.append(_grid(texts[0], texts[1], n)[i, j])
    else:
        for at in range(0, len(i), 512):
            value.append(likeness(texts[0].take(pa.array(i[at : at + 512])), texts[1].take(pa.array(j[at : at + 512])), n))
    value = np.concatenate(value)
    a, b, good = ids[0][i], ids[1][j], value >= near
    return np.minimum(a, b)[good], np.maximum(a, b)[good], value[good]


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: float = NEAR, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``<id_col>, class_id, copies``: the class, and how many of its members have this very text."""
    return _labelled(docs, id_col, text_col, near, n, bands, rows).select(F.col("id").alias(id_col), "class_id", "copies")


def _labelled(docs: DataFrame, id_col: str, text_col: str, near: float = NEAR, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id, digest, class_id, stays, copies`` of every row; ``stays`` marks the text that stands for its class."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    text = F.coalesce(F.col(text_col), F.lit(""))
    digested = docs.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("digest"), text.alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, _PART):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _banded(part.column(2), n, bands, rows)], ["id", "digest", "bands"])

    signed = cut(digested.mapInArrow(sign, T.StructType().add("id", kind).add("digest", "string").add("bands", T.ArrayType(T.LongType()))))
    nodes = signed.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()))
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = cut(banded.join(shared, "key"))
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    members = cut(members.join(company, "node").select("key", "band", "node", "company"))

    # texts of the nodes that share a bucket, once each
    wanted = members.select("node").distinct().join(nodes.select("node", "digest"), "node")
    folder = new_folder(spark, "texts")
    digested.select("digest", "text").join(wanted, "digest").groupBy("node").agg(F.any_value("text").alias("text")).write.parquet(folder)
    texts = spark.read.parquet(folder)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, 2 * _PART):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(likeness(part.column(2), part.column(3), n))], ["a", "b", "near"])

    def compared(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
        return both.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long, near double")

    # first everybody meets the member of its bucket with the most company
    heads = members.groupBy("key").agg(F.max(F.struct("company", F.expr("-node").alias("m"))).alias("top")).select("key", F.expr("-top.m").alias("head"))
    star = members.join(heads, "key").where("node <> head").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    classes = cut(members.select("node").distinct().withColumn("class", F.col("node")))
    classes = _joined(classes, compared(star).where(F.col("near") >= near))
    # then those outside the head's class meet the other classes of the bucket, block by block
    placed = members.select("key", "band", "node").join(classes, "node")
    head_class = heads.join(classes.select(F.col("node").alias("head"), F.col("class").alias("head_class")), "head").select("key", "head_class")
    outside = cut(placed.join(head_class, "key").where("class <> head_class").drop("head_class"))
    blocks = outside.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("outer")).join(members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("inner")), "key")
    blocks = cut(blocks)
    open_nodes = placed.join(blocks.select("key"), "key", "left_semi").select("node").distinct()

    def sign_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, _PART):
            yield pa.RecordBatch.from_arrays([*part.columns, _signs(part.column(1), n, bands * rows)], ["node", "text", "signs"])

    data = texts.select("node", "text").join(open_nodes, "node", "left_semi").mapInArrow(sign_whole, "node long, text string, signs array<int>")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in its own block, once for every block of the other side."""
        rows = rows.join(blocks, "key").join(data, "node").withColumn(f"{own}_block", F.pmod(F.xxhash64("node"), F.col(own)))
        return rows.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).drop(own, other)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.rename_columns([c.removeprefix("r_") for c in right.column_names])
        out = [_links(left, right, near, n, bands, rows)] if left.num_rows and right.num_rows else []
        return pa.table({c: np.concatenate([x[i] for x in out]) if out else np.zeros(0, "f8" if c == "near" else "i8") for i, c in enumerate(("a", "b", "near"))})

    keys = ["key", "outer_block", "inner_block"]
    inside = dealt(placed, "inner", "outer")
    inside = inside.select(*[F.col(c).alias(f"r_{c}") for c in inside.columns])
    met = dealt(outside, "outer", "inner").groupBy(*keys).cogroup(inside.groupBy(*[f"r_{k}" for k in keys]))
    more = met.applyInArrow(meet, "a long, b long, near double")
    more = cut(more.dropDuplicates(["a", "b"]))
    classes = _joined(classes, more)
    labelled = nodes.select("digest", "node", "first", "copies").join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    least = labelled.groupBy("class").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", F.col("digest").alias("standing"))).alias("least"))
    labelled = labelled.join(least, "class").select("digest", F.col("least.first").alias("class_id"), (F.col("least.standing") == F.col("digest")).alias("stays"), "copies")
    return signed.select("id", "digest").join(labelled, "digest")


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, class`` after the classes that ``links(a, b)`` connect have become one."""
    ends = [classes.select(F.col("node").alias(x), F.col("class").alias(f"class_{x}")) for x in "ab"]
    pairs = cut(links.join(ends[0], "a").join(ends[1], "b").select(F.col("class_a").alias("src"), F.col("class_b").alias("dst")).where("src <> dst").distinct())
    if pairs.isEmpty():
        return classes
    found = wcc(Graph(classes.select(F.col("class").alias("id")).distinct(), pairs)).withColumnRenamed("id", "class")
    return cut(classes.join(found, "class").select("node", F.col("component").alias("class")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without those near an earlier one: of each class the row with the smallest id stays.

    Ids are compared with their texts, so a null or repeated id lets no other text through. Rows with a null id stay only if
    their class has no other. Of several rows with the id and the text that stay, the first by its JSON form is taken.
    """
    kept = _labelled(docs, id_col, text_col, **how).where(F.col("stays") & F.col("id").eqNullSafe(F.col("class_id"))).select(F.col("id").alias("_kept"), F.col("digest").alias("_kept_digest")).distinct()
    digest = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    kept = cut(kept)
    rows = docs.join(kept, docs[id_col].eqNullSafe(F.col("_kept")) & (digest == F.col("_kept_digest")), "left_semi")
    if rows.groupBy(id_col).count().where("count > 1").isEmpty():
        return rows
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return rows.groupBy(F.col(id_col).alias("_id"), F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("_digest")).agg(F.min_by(whole, F.to_json(whole)).alias("_row")).select("_row.*")
