"""Removal of repeated byte strings by radix refinement over shard Burrows-Wheeler transforms.

Every byte that a string of ``length`` bytes covers which also starts earlier goes.
A window (a start and its ``length`` bytes) has a key, the smallest hash of its inner
strings of ``length * 48 // 100`` bytes; equal windows have equal keys, and neighbours
mostly share theirs, so a text is a row of short segments of windows with one key.
Only keys whose inner string occurs more than once can hold a repeat. Their segments are the suffix
collection; equal ones are one, with the place of the first.

Segments are dealt to buckets by key. In a bucket, shards of the segments are sorted by
themselves, to ``CONTEXT`` symbols, into a Burrows-Wheeler transform each. The windows are then
radix-refined, without the shards' order: they start as one block, and in each round
a stable pass by the symbols of the transforms it puts together extends the common
prefix of every block by one. Blocks split at the borders that appear; a suffix alone in
its block is finished and leaves. After ``length`` rounds the blocks are the repeated
intervals, without sorting the joint suffixes. The first place in a block stays, the
windows at the others go. A kind of segment that occurs in several places loses all
windows at all but its first.

A key with more than ``MOST`` different segments would not fit a bucket: its windows are
compared one by one as 128-bit hashes in a grouped aggregation instead, which gives the same.

Documents are ordered by id, null last. Null texts are empty; texts shorter than
``length`` lose nothing. Rows with the same id are one document for the order: none is
earlier than another. Their texts are told apart by id and digest. Texts equal to an earlier
one go entirely and are left out early.
Matches are judged on the input, never across documents, on UTF-8 bytes; a span may
begin inside a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut, new_folder
from . import words
from .common import parts_of

LENGTH = 100
MOST = 20_000  # different segments of one key in a bucket
BUCKET = 8_000  # segments a bucket should have
SHARD = 2_000  # segments a transform is built from
LONGEST = 256  # windows in a segment
CONTEXT = 16  # symbols a shard is sorted by at least; the refinement supplies the rest
SIEVE_BITS = 26
_PIECE = 512 << 10
_LAST = (1 << 63) - 1


_SYMBOL = words.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_FACTOR = np.uint64(0xA0761D6478BD642F)


def _strings(x: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` bytes from each place on: a polynomial, put together by doubling."""
    cur, size, power, out, done = _SYMBOL[x], 1, _FACTOR, None, 0
    while True:
        if n & size:
            if out is None:
                out = cur
            else:
                some = max(0, len(cur) - done)
                out = out[:some] * power + cur[done:]
            done += size
        if 2 * size > n:
            return words.mixed(out)
        some = max(0, len(cur) - size)
        cur = cur[:some] * power + cur[size:]
        with np.errstate(over="ignore"):
            size, power = 2 * size, power * power


def _extreme(pick, x: np.ndarray, n: int) -> np.ndarray:
    """Minimum or maximum of the ``n`` values from each place on."""
    size = 1
    while 2 * size <= n:
        x = pick(x[:-size], x[size:])
        size *= 2
    rest = n - size
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def segments(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first window, number of windows and key of every segment, and how often its inner string occurs in it (1 or 2)."""
    data, offsets = words.text_bytes(texts)
    inner = max(1, length * 48 // 100)
    many = length - inner + 1  # inner strings of a window
    out = []
    for begin in range(0, len(data), _PIECE):
        part = data[begin : begin + _PIECE + length - 1]
        if len(part) < length:
            continue
        strings = _strings(part, inner)
        keys = _extreme(np.minimum, strings, many)
        few = slice(np.searchsorted(offsets, begin, "right") - 1, np.searchsorted(offsets, begin + len(keys)))
        text = np.repeat(np.arange(few.start, few.stop), np.diff(np.clip(offsets[few.start : few.stop + 1], begin, begin + len(keys))))
        whole = np.arange(begin + length, begin + length + len(keys)) <= offsets[text + 1]
        border = np.ones(len(keys) + 1, bool)
        border[1:-1] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1])
        at = np.flatnonzero(border)
        size, at = np.diff(at), at[:-1]
        size, at = size[whole[at]], at[whole[at]]
        parts = -(-size // LONGEST)
        piece = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.repeat(at, parts) + piece * LONGEST
        size = np.minimum(LONGEST, np.repeat(size, parts) - piece * LONGEST)
        # inner strings that are the smallest of a window: one that a segment holds twice may repeat in it
        padded = np.concatenate([np.zeros(many - 1, np.uint64), keys, np.zeros(many - 1, np.uint64)])
        least = np.flatnonzero(_extreme(np.maximum, padded, many) == strings)
        low, high = np.searchsorted(least, at), np.searchsorted(least, at + size + many - 1)
        owner = np.repeat(np.arange(len(at)), high - low)
        inside = least[np.arange(len(owner)) - np.repeat(np.cumsum(high - low) - high, high - low)]
        times = np.minimum(2, np.bincount(owner[strings[inside] == keys[at[owner]]], minlength=len(at)))
        key = (words.mixed(keys[at]) >> np.uint64(24)).astype(np.int64)
        out.append((text[at], at + begin - offsets[text[at]], size, key, times))
    if not out:
        return (np.zeros(0, np.int64),) * 5
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def transform(symbols: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order, to ``depth`` symbols at least, Burrows-Wheeler transform of texts that end in symbol 0, and its steps.

    The step of a row is the row of the suffix that is one symbol longer, the transform's last-to-first mapping.

    ``ends`` has for each place the end of its text; equal suffixes keep their order.
    """
    n = len(symbols)
    place = np.arange(n)
    rank, size = symbols.astype(np.uint64), 1
    while size < 8:  # eight symbols fit one number
        after = np.where(place + size <= ends, rank[np.minimum(place + size, n - 1)], np.uint64(0))
        rank = (rank << np.uint64(8 * size)) | after
        size *= 2
    order = np.argsort(rank, kind="stable")
    while True:
        sorted_rank = rank[order]
        number = np.cumsum(np.concatenate([[0], sorted_rank[1:] != sorted_rank[:-1]]))
        if size >= depth or number[-1] == n - 1:
            break
        rank = np.empty(n, np.uint64)
        rank[order] = number + 1
        after = np.where(place + size <= ends, rank[np.minimum(place + size, n - 1)], np.uint64(0))
        rank = (rank << np.uint64(32)) | after
        order = np.argsort(rank, kind="stable")
        size *= 2
    before = np.where(order > 0, symbols[order - 1], 0).astype(np.uint8)
    row = np.empty(n, np.int64)
    row[order] = place
    return order, before, row[order - 1]


def merge(transforms: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the joint transforms whose suffixes share their first ``depth`` symbols with another, and their block.

    A shard is its transform, the steps, and the rows to begin with: those that ``depth`` steps lead to wanted
    suffixes. The interleave starts as one shard after the other. A round is a stable pass by the
    symbols: it puts the suffixes that are one symbol longer in order and splits blocks at new borders.
    A suffix alone in its block stays alone when it grows, so it is finished and leaves.
    """
    base = np.cumsum([0, *(len(t) for t, _, _ in transforms)])
    symbol, longer, row = (np.concatenate([x[i] + (0 if i == 0 else b) for x, b in zip(transforms, base, strict=False)]) for i in range(3))
    symbol, block = symbol.astype(np.uint8), np.zeros(len(row), np.int32)
    for _ in range(depth):
        now = symbol[row]
        order = np.argsort(now, kind="stable")
        row, now, was = longer[row[order]], now[order], block[order]
        border = np.ones(len(row) + 1, bool)
        border[1:-1] = (now[1:] != now[:-1]) | (was[1:] != was[:-1])
        shared = ~(border[:-1] & border[1:])
        row, block = row[shared], np.cumsum(border[:-1], dtype=np.int32)[shared]
    return row, block


def repeated(texts: list[bytes], windows: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """Text number and window of all windows whose bytes also start earlier, in order."""
    sizes = np.array([len(t) for t in texts])
    orders, transforms, base = [], [], 0
    for at in range(0, len(texts), shard):
        joined = np.frombuffer(b"\xff".join(texts[at : at + shard]) + b"\xff", np.uint8)
        symbols = joined + np.uint8(1)  # UTF-8 has no byte 255, which becomes the end
        stop = np.cumsum(sizes[at : at + shard] + 1) - 1
        stops = np.repeat(stop, sizes[at : at + shard] + 1)
        order, before, step = transform(symbols, stops, CONTEXT)
        # windows are `length` steps from the last places of their text
        last = np.arange(len(symbols)) > stops - np.repeat(windows[at : at + shard], sizes[at : at + shard] + 1)
        orders.append(order + base)
        transforms.append((before, step, np.flatnonzero(last[order])))
        base += len(symbols)
    row, block = merge(transforms, length)
    place = np.concatenate(orders)[row]
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.searchsorted(begins, place, "right") - 1
    window = place - begins[text]
    d, s = doc[text], start[text] + window
    order = np.lexsort((s, d, block))
    text, window, block, d, s = (x[order] for x in (text, window, block, d, s))
    new = np.ones(len(block), bool)
    new[1:] = block[1:] != block[:-1]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(block)), 0))
    later = (d != d[lead]) | (s != s[lead])
    text, window = text[later], window[later]
    order = np.lexsort((window, text))
    return text[order], window[order]


def _runs(owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first and end of the runs of consecutive numbers."""
    if not len(at):
        return owner, at, at
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return owner[first], at[first], at[last] + 1


def _kept_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder."""
    folder = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, most: int = MOST, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """All rows as ``doc, digest, n_bytes, copy``, and ``doc, digest, text, spans`` of the texts that lose bytes.

    ``doc`` is the id with null as the largest, ``copy`` says that an earlier document has the
    same text of ``length`` bytes or more, ``spans`` are maximal removed byte ranges. Copies are not in the second table.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), F.sha2(text, 256).alias("digest"), text.alias("text"))
    digests = plain.select("doc", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    first = digests.groupBy("digest").agg(F.min("doc").alias("first"))
    tag = F.xxhash64("digest").alias("tag")  # tells the texts of one id apart in less room than the digest
    rows = cut(digests.join(first, "digest").select("doc", "digest", "n_bytes", ((F.col("doc") > F.col("first")) & (F.col("n_bytes") >= length)).alias("copy")))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, 4 << 20):
            *_, key, times = segments(part.column(0), length)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(key, times))], ["key"])

    again = cut(plain.select("text").mapInArrow(keyed, "key long").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    # A sieve of fixed size lets few other segments through to the exact join below.
    slot = F.col("key").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    hits = again.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow()
    bits = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    bits[hits["at"].to_numpy()] = hits["bits"].to_numpy()
    sieve = spark.sparkContext.broadcast(bits)

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, 4 << 20):
            owner, start, size, key, times = segments(part.column(2), length)
            place = key & ((1 << SIEVE_BITS) - 1)
            good = (sieve.value[place >> 6] >> (place & 63)) & 1 == 1
            doc, tags = (part.column(i).to_numpy()[owner[good]] for i in range(2))
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tags), *[pa.array(c[good]) for c in (start, size, key, times)]], ["doc", "tag", "start", "n", "key", "times"])

    met = plain.select("doc", tag, "text").mapInArrow(sifted, "doc long, tag long, start long, n long, key long, times long").join(again, "key", "left_semi")
    met = _kept_table(met.join(rows.where("copy").select("doc", tag).distinct(), ["doc", "tag"], "left_anti"), "segments")
    still = met.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1").select("key")
    listed = met.join(still, "key", "left_semi").groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "n", "key")).alias("segments"))
    held = _kept_table(plain.withColumn("tag", tag).drop("digest").join(listed, ["doc", "tag"]), "repeats").withColumn("digest", F.sha2("text", 256))  # a list is as long as its document

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, 4 << 20):
            lists = part.column(3)
            flat = lists.flatten()
            owner = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            start, size, key = (flat.field(i).to_numpy() for i in range(3))
            raw = [t.encode() for t in part.column(2).to_pylist()]
            seg = [raw[o][s : s + n + length - 1] for o, s, n in zip(owner.tolist(), start.tolist(), size.tolist(), strict=True)]
            kind = [int.from_bytes(hashlib.blake2b(s, digest_size=8).digest(), "little", signed=True) for s in seg]
            doc, tags = (part.column(i).to_numpy()[owner] for i in range(2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(kind, pa.int64()), pa.array(doc), pa.array(tags), pa.array(start), pa.array(size), pa.array(seg, pa.binary())],
                ["key", "kind", "doc", "tag", "start", "n", "seg"],
            )

    schema = "key long, kind long, doc long, tag long, start long, n long, seg binary"
    places = held.select("doc", "tag", "text", "segments").mapInArrow(cut_out, schema)
    kinds = places.groupBy("key", "kind").agg(F.min(F.struct("doc", "start")).alias("at"), F.any_value("n").alias("n"), F.any_value("seg").alias("seg"), F.count("*").alias("copies"))
    kinds = _kept_table(kinds.select("key", "kind", F.col("at.doc").alias("doc"), F.col("at.start").alias("start"), "n", "seg", "copies"), "kinds")
    crowded = cut(kinds.groupBy("key").agg(F.count("*").alias("kinds")).where(F.col("kinds") > most).select("key"))
    some = not crowded.isEmpty()
    buckets = max(1, kinds.count() // bucket)
    small = (kinds.join(crowded, "key", "left_anti") if some else kinds).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    result = "key long, kind long, doc long, start long, runs array<struct<a:long,b:long>>"

    def refine(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        n, doc, start, copies = (table[c].to_numpy() for c in ("n", "doc", "start", "copies"))
        text, window = repeated(table["seg"].to_pylist(), n, doc, start, length)
        return _with_runs(table, text, window, (copies > 1))

    found = small.groupBy("bucket").applyInArrow(refine, result)
    found = cut(found.unionAll(_by_hash(kinds.join(crowded, "key", "left_semi"), length, result)) if some else found)
    # the first place of a kind loses the runs, any other place of it everything
    first_place = (F.col("p.doc") == F.col("f.doc")) & (F.col("p.start") == F.col("f.start"))
    gone = places.drop("seg").alias("p").join(found.alias("f"), ["key", "kind"]).select(
        F.col("p.doc").alias("doc"), F.col("p.tag").alias("tag"), F.col("p.start").alias("start"),
        F.explode(F.when(first_place, F.col("runs")).otherwise(F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("p.n").alias("b"))))).alias("run"),
    )
    spans = gone.groupBy("doc", "tag").agg(F.collect_list(F.struct((F.col("start") + F.col("run.a")).alias("a"), (F.col("start") + F.col("run.b") + (length - 1)).alias("b"))).alias("spans"))
    lost = held.select("doc", "tag", "digest", "text").dropDuplicates(["doc", "tag"]).join(spans, ["doc", "tag"]).drop("tag")
    return rows, lost.withColumn("spans", _united(F.col("spans"), F.octet_length("text")))


def _united(spans, size):
    """Sorted, overlapping and touching ranges made one, ends within the text."""

    @F.arrow_udf("array<struct<a:long,b:long>>")
    def unite(lists: pa.Array, sizes: pa.Array) -> pa.Array:
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        limit = sizes.cast(pa.int64()).to_numpy(zero_copy_only=False)[owner]
        a, b = (np.minimum(flat.field(i).to_numpy(), limit) for i in range(2))
        order = np.lexsort((a, owner))
        owner, a, b = owner[order], a[order], b[order]
        if len(a):
            lane = owner * (int(b.max()) + 2)  # ranges of different owners never meet
            reach = np.maximum.accumulate(b + lane)
            new = np.ones(len(a), bool)
            new[1:] = (a + lane)[1:] > reach[:-1]
            begin = np.flatnonzero(new)
            stop = np.append(begin[1:], len(a)) - 1
            owner, a, b = owner[begin], a[begin], reach[stop] - lane[begin]
        offsets = np.searchsorted(owner, np.arange(len(lists) + 1))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]))

    return unite(spans, size)


def _with_runs(table: pa.Table, text: np.ndarray, window: np.ndarray, shown: np.ndarray) -> pa.Table:
    """Kinds that lose windows at their first place, or have more places than one."""
    owner, a, b = _runs(text, window)
    offsets = np.searchsorted(owner, np.arange(table.num_rows + 1))
    runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]))
    out = pa.table([table["key"], table["kind"], table["doc"], table["start"], runs], ["key", "kind", "doc", "start", "runs"])
    return out.filter(pa.array(shown | (np.diff(offsets) > 0)))


def _by_hash(kinds: DataFrame, length: int, result: str) -> DataFrame:
    """The same for keys with too many segments for a bucket: windows compared one by one."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seg, n = batch.column("seg").to_pylist(), batch.column("n").to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), n)
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            h = [hashlib.blake2b(seg[o][w : w + length], digest_size=16).digest() for o, w in zip(owner.tolist(), offset.tolist(), strict=True)]
            rows = batch.drop_columns(["seg", "n"]).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(offset), pa.array(h, pa.binary())], ["key", "kind", "doc", "start", "copies", "window", "h"])

    each = kinds.select("key", "kind", "doc", "start", "copies", "seg", "n").mapInArrow(windows, "key long, kind long, doc long, start long, copies long, window long, h binary")
    each = each.withColumn("at", F.struct("doc", (F.col("start") + F.col("window")).alias("place")))
    first = each.groupBy("h").agg(F.min("at").alias("first"))
    later = each.join(first, "h").groupBy("key", "kind", "doc", "start", "copies").agg(F.sort_array(F.collect_list(F.when(F.col("at") > F.col("first"), F.col("window")))).alias("w"))

    def to_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("w")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            table = _with_runs(pa.table(batch), owner, lists.flatten().to_numpy(), batch.column("copies").to_numpy() > 1)
            yield from table.combine_chunks().to_batches()

    return later.mapInArrow(to_runs, result)


def without(text: str | None, spans: list[tuple[int, int]]) -> bytes:
    """The bytes that remain."""
    raw, out, at = (text or "").encode(), [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def _kept(as_text: bool):
    @F.arrow_udf("string" if as_text else "binary")
    def kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = [without(t, [(s["a"], s["b"]) for s in sp or []]) for t, sp in zip(texts.to_pylist(), spans.to_pylist(), strict=True)]
        return pa.array([b.decode("utf-8", "ignore") for b in out] if as_text else out, pa.string() if as_text else pa.binary())

    return kept


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``<id_col>, n_bytes, n_removed, n_spans, kept_sha256`` per row."""
    rows, lost = repeats(docs, id_col, text_col, **how)
    lost = lost.select(
        "doc", "digest", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"]).alias("removed"), F.size("spans").cast("long").alias("spans"),
        F.sha2(_kept(False)(F.col("text"), F.col("spans")), 256).alias("kept"),
    )
    empty = hashlib.sha256(b"").hexdigest()
    return rows.join(lost, ["doc", "digest"], "left").select(
        F.when(F.col("doc") != _LAST, F.col("doc")).alias(id_col), "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copy"), F.lit(empty)).otherwise(F.coalesce("kept", "digest")).alias("kept_sha256"),
    )


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the texts; broken characters at the cuts go, emptied rows stay."""
    rows, lost = repeats(docs, id_col, text_col, **how)
    lost = lost.select("doc", "digest", _kept(True)(F.col("text"), F.col("spans")).alias("_new"))
    new = rows.where("copy").select("doc", "digest", F.lit("").alias("_new")).distinct().unionAll(lost).withColumnRenamed("doc", "_doc").withColumnRenamed("digest", "_digest")
    own = docs.withColumn("_doc", F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))).withColumn("_digest", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    return own.join(new, ["_doc", "_digest"], "left").withColumn(text_col, F.coalesce("_new", text_col)).select(*docs.columns)
