"""Spelling variants: words that differ by one inserted, deleted or replaced code point, found by a trie frontier.

The words form a trie, kept as a distributed table of nodes with their edges (``trie``). A state
(word, position, node, edits) says that the first ``position`` code points of a word lead to ``node`` with so many
edits. Words that begin alike share their states: the word is held as its own trie node at that position, so that a
state is a pair of nodes and the work follows the distinct beginnings. States without edit are the nodes that several words
share; every one of them starts states with one edit (another code point, or one more). Level by level the frontier
is joined with the edge table for both nodes, and only equal code points go on. A state whose nodes both end a
word makes the two neighbours. A code point is inserted behind its run of equal ones only, so each pair
comes up once. One more is one less seen from the other side, so deletions need no states.

Nodes are 64-bit hashes of their prefixes. Nodes that share one are joined, which can only add states, and every pair is compared
exactly at the end. A node has at most as many edges as the alphabet has code points, so no key is hot. The frontier of a level is
written to the shared folder and read again, so a lost executor costs a part of one level. The rounds follow the longest beginning that two words share, not the longest word.

Null texts have no words and null ids read as empty text; empty tables give empty results. Texts are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut, new_folder

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
SLIP = 199
_STATE = "a long, b long, lag int, skip string, ended boolean"


def lower_ascii(word: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def slipped(row_id: Column, word: Column, every: int = SLIP) -> Column:
    """``word`` without one code point for one in ``every`` of (row, word), chosen by their CRC-32."""
    h = F.crc32(F.concat(F.coalesce(row_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = F.pmod(h, F.length(word)).cast("int")
    cut_out = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % every == 0, cut_out).otherwise(word)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of all texts; with ``slips`` the words have one typing slip in so many."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    low = runs.where(F.length("run") >= min_length).select("id", lower_ascii(F.col("run")).alias("word"))
    if slips:
        low = low.select(slipped(F.col("id"), F.col("word"), slips).alias("word")).where(F.length("word") >= min_length)
    return low.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def trie(words: DataFrame) -> DataFrame:
    """``depth, node, words, ends, kids(ch, node, ends)`` of every beginning of ``word``."""
    at = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at"))
    prefix = lambda n: F.xxhash64(F.substring("word", F.lit(1), n))
    last = F.col("at") == F.length("word")
    edges = at.select(
        F.col("at").alias("depth"), prefix(F.col("at")).alias("node"), F.when(~last, F.substring("word", F.col("at") + 1, F.lit(1))).alias("ch"),
        F.when(~last, prefix(F.col("at") + 1)).alias("kid"), (F.col("at") + 1 == F.length("word")).alias("kid_ends"),
    )
    once = edges.groupBy("depth", "node", "ch", "kid").agg(F.count("*").alias("n"), F.max("kid_ends").alias("kid_ends"))
    kid = F.when(F.col("ch").isNotNull(), F.struct("ch", F.col("kid").alias("node"), F.col("kid_ends").alias("ends")))
    return once.groupBy("depth", "node").agg(F.sum("n").alias("words"), F.max(F.col("ch").isNull()).alias("ends"), F.collect_list(kid).alias("kids"))


def _state(a: Column, b: Column, lag: int | Column, skip: Column, ended: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"), (F.lit(lag) if isinstance(lag, int) else lag).alias("lag"), skip.cast("string").alias("skip"), ended.alias("ended"))


def _begun(nodes: DataFrame) -> DataFrame:
    """States with one edit that start at nodes of several words: one code point more, or another one."""
    nothing = F.lit(None)
    more = F.transform("kids", lambda k: _state(F.col("node"), k["node"], 1, k["ch"], F.col("ends") & k["ends"]))
    other = F.flatten(F.transform("kids", lambda k: F.transform(F.filter("kids", lambda o: o["ch"] > k["ch"]), lambda o: _state(k["node"], o["node"], 0, nothing, k["ends"] & o["ends"]))))
    return nodes.where("words > 1").select(F.explode(F.concat(more, other)).alias("s")).select("s.*")


def _followed(states: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """States one code point further: ``b`` stands at ``depth``, ``a`` at ``depth - lag``."""
    left = nodes.select((F.lit(depth) - F.col("depth")).alias("lag"), F.col("node").alias("a"), F.col("kids").alias("of_a"))
    right = nodes.where(F.col("depth") == depth).select(F.col("node").alias("b"), F.col("kids").alias("of_b"))
    met = states.drop("ended").join(left, ["a", "lag"]).join(right, "b")
    goes = lambda x, y: (x["ch"] == y["ch"]) & ~F.col("skip").eqNullSafe(x["ch"])
    on = F.flatten(F.transform("of_a", lambda x: F.transform(F.filter("of_b", lambda y: goes(x, y)), lambda y: _state(x["node"], y["node"], F.col("lag"), F.lit(None), x["ends"] & y["ends"]))))
    return met.select(F.explode(on).alias("s")).select("s.*")


def neighbours(words: DataFrame) -> DataFrame:
    """``word, near``: all ordered pairs of ``word`` one edit apart; words must be distinct."""
    spark = words.sparkSession
    place = new_folder(spark, "trie")
    trie(words).repartitionByRange("depth", "node").sortWithinPartitions("depth", "node").write.parquet(f"{place}/nodes")
    nodes = spark.read.parquet(f"{place}/nodes")
    last = nodes.where("words > 1").agg(F.max("depth")).first()[0]
    depth, levels = 0, []
    frontier = spark.createDataFrame([], _STATE)
    while last is not None and (depth <= last or not frontier.isEmpty()):
        here = nodes.where(F.col("depth").isin(depth, depth - 1))
        begun = _begun(nodes.where(F.col("depth") == depth))
        step = begun.unionByName(_followed(frontier, here, depth)) if depth else begun
        levels.append(f"{place}/level-{depth}")
        step.write.parquet(levels[-1])
        frontier = spark.read.schema(_STATE).parquet(levels[-1])
        depth += 1
    ended = (spark.read.schema(_STATE).parquet(*levels) if levels else frontier).where("ended").select("a", "b").distinct()
    ids = words.select(F.xxhash64("word").alias("id"), "word")
    named = ended.join(ids.toDF("a", "x"), "a").join(ids.toDF("b", "y"), "b").where(F.levenshtein("x", "y") == 1)
    return cut(named.select(F.explode(F.array(F.struct(F.col("x").alias("word"), F.col("y").alias("near")), F.struct(F.col("y").alias("word"), F.col("x").alias("near")))).alias("p")).select("p.*"))


def variants(words: DataFrame, ratio: float = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every ``word`` with its count ``n``.

    The form is the near word of largest count (of equal ones the first in code-point order), if it occurs
    at least ``ratio`` times as often; the root is the end of the chain of forms.
    """
    if ratio <= 1:
        raise ValueError("counts must grow along a chain of forms")
    words = cut(words.select("word", F.col("n").cast("long").alias("n")))
    near = neighbours(words).join(words.toDF("near", "near_n"), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    formed = F.col("best").isNotNull() & (-F.col("best.minus") >= F.col("n") * ratio)
    rows = words.join(best, "word", "left").select(
        "word", F.when(formed, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, -F.col("best.minus")).alias("form_n")
    )
    rows = cut(rows)
    low, high = rows.agg(F.min("n"), F.max("n")).first()
    # counts grow by the ratio at every link, so chains are short; each round doubles what a jump covers
    links = 1 + int(math.log(max(high / low, 1.0), ratio)) if low else 0
    jump = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, links - 1).bit_length()):
        jump = cut(jump.join(jump.toDF("root", "further"), "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return rows.join(jump, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) WHERE length(run) >= 6 GROUP BY ALL
),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(id || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END)) AS b
  FROM runs
),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc_table
),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING sum(n) >= 5 AND length(word) >= 6
),
shorter AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
one_less AS (SELECT DISTINCT s.word AS a, w.word AS b FROM shorter s JOIN words w ON s.rest = w.word),
near AS (
  SELECT a AS word, b AS near FROM one_less UNION ALL SELECT b, a FROM one_less
  UNION ALL SELECT x.word, y.word FROM shorter x JOIN shorter y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
),
ranked AS (
  SELECT near.word, near.near, v.n, count(*) OVER (PARTITION BY near.word) AS n_near, row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, near.near) AS k
  FROM near JOIN words v ON near.near = v.word
),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN r.near END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1
),
chain AS (SELECT word, word AS at, form AS next FROM formed UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.next = f.word)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
