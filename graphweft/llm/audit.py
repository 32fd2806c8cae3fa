"""Filter interaction audit: what every filter removes, in every order, and its fair share of the removals.

A document is a mask of the filters that it fails. The removal game gives every coalition of
filters the number of documents that it removes, v(S); it is worked out from the counts per part and mask. The
Hart-Mas-Colell potential follows by recursion over the coalitions,

    P({}) = 0,    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

and the Shapley value of filter i is P(all) - P(all without i). ``audit`` gives it times the number of
orders, which is a whole number: what the filter removes, summed over all orders. A step of an order that adds i
to S removes v(S with i) - v(S).

Nothing is gathered: equal texts meet as digests, counted per task first, and what leaves the last
shuffle is one row per part, whatever the number of documents.

Null texts count as empty; a null part as the empty string. A null id is neither smaller nor larger than another, so it
makes no document a copy and is none. A row that is repeated whole is no copy of itself (its id is not smaller) and counts as often as
it is there. Several labels of an id count as one that has every mark; a null id has no label. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD

FILTERS = "ABCDE"
MARKS = {"good_lost": "good", "toxic_lost": "toxic"}


def _bit(flag: Column, i: int) -> Column:
    return F.when(flag, F.lit(1 << i)).otherwise(F.lit(0))


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: short, repetitive, shouting, symbols (filters A to D)."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(found)
    return (
        _bit(n < 100, 0)
        + _bit(F.size(F.array_distinct(found)).cast("long") * 100 < n.cast("long") * 80, 1)
        + _bit(F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 10, 2)
        + _bit(text.rlike("[#$%&*|]"), 3)
    )


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents, and those with either label, per part and set of failed filters."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text_failures(text).alias("mask"),
    )
    each = rows.groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    marked = each.join(marks, "id", "left").withColumns({m: F.coalesce(m, F.lit(False)) for m in ("good", "toxic")})
    # rows of one text that differ in part or label only; ids are distinct within a group
    alike = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null")
    )
    least = F.min("least").over(W.partitionBy("digest"))
    first = F.col("n_null") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    both = F.array(
        F.struct(F.col("mask"), first.alias("n")), F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - first).alias("n"))
    )
    split = alike.withColumn("first", least).select("part", "good", "toxic", F.explode(both).alias("x"))
    counted = split.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("x.n")).otherwise(0)).alias("toxic")
    )
    return counted


def games(counts: DataFrame, filters: Sequence[str] = FILTERS, measures: Sequence[str] = ("n", "good", "toxic")) -> DataFrame:
    """Per part and measure an array: what each coalition (by its mask) removes; and the ``total`` of ``n``."""
    cells = counts.groupBy("part").agg(F.sum("n").alias("total"), F.collect_list(F.struct("mask", *measures)).alias("cells"))  # a cell per mask at most
    coalitions = F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1))

    def removed(c: str) -> Column:
        return F.transform(coalitions, lambda s: F.aggregate(F.filter("cells", lambda x: x["mask"].bitwiseAND(s) != 0), F.lit(0).cast("long"), lambda a, x: a + x[c]))

    return cells.select("part", "total", *[removed(c).alias(c) for c in measures])


def potentials(game: DataFrame, players: int, value: str = "n") -> DataFrame:
    """``game`` with ``potential``: the potential of every coalition times the number of orders, a whole number."""
    orders = factorial(players)

    def next_one(known: Column, s: Column) -> Column:
        smaller = [F.when(s.bitwiseAND(1 << i) != 0, F.get(known, s.bitwiseXOR(F.lit(1 << i)))).otherwise(F.lit(0)) for i in range(players)]
        return F.array_append(known, F.call_function("div", F.get(F.col(value), s) * orders + sum(smaller[1:], smaller[0]), F.bit_count(s)))

    # a coalition's potential rests on those with one filter less, whose masks are smaller numbers
    coalitions = F.sequence(F.lit(1), F.lit((1 << players) - 1))
    return game.withColumn("potential", F.aggregate(coalitions, F.array(F.lit(0).cast("long")), next_one))


def audit(counts: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """A row per part, order and step from ``counts(part, mask, n, good, toxic)``.

    ``kept, removed, redundant, unique_fails, good_lost, toxic_lost`` count documents, ``shapley`` is the filter's Shapley value
    times the number of orders.
    """
    k = len(filters)
    everyone = (1 << k) - 1
    orders = F.lit(["".join(order) for order in permutations(filters)])
    bit = f"shiftleft(1, instr('{''.join(filters)}', substring(filter_order, AT, 1)) - 1)"  # of the filter at a place of the order
    rows = potentials(games(counts, filters), k).select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
    after = f"aggregate(transform(sequence(1, step), j -> {bit.replace('AT', 'j')}), 0, (a, x) -> a + x)"
    rows = rows.withColumns({"bit": F.expr(bit.replace("AT", "step")), "after": F.expr(after)})
    rows = rows.withColumn("before", F.col("after") - F.col("bit"))
    step = {c: F.get(c, F.col("after")) - F.get(c, F.col("before")) for c in ("n", "good", "toxic")}
    rest = F.lit(everyone) - F.col("bit")
    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - F.get("n", F.col("after"))).alias("kept"), step["n"].alias("removed"), (F.get("n", F.col("bit")) - step["n"]).alias("redundant"),
        (F.get("n", F.lit(everyone)) - F.get("n", rest)).alias("unique_fails"), *[step[m].alias(c) for c, m in MARKS.items()],
        (F.get("potential", F.lit(everyone)) - F.get("potential", rest)).alias("shapley"),
    )


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
first AS (SELECT t, min(doc_id) AS lo FROM d GROUP BY t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN w.doc_id > lo THEN 16 ELSE 0 END AS mask
  FROM w JOIN first USING (t) LEFT JOIN l ON w.doc_id = l.doc_id
),
h AS (SELECT part, mask, count(*) AS n, sum(good) AS g, sum(toxic) AS x FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
o AS (
  SELECT f1.c || f2.c || f3.c || f4.c || f5.c AS filter_order, [f1.b, f2.b, f3.b, f4.b, f5.b] AS bits
  FROM f f1, f f2, f f3, f f4, f f5 WHERE f1.b + f2.b + f3.b + f4.b + f5.b = 31 AND (f1.b | f2.b | f3.b | f4.b | f5.b) = 31
),
s AS (
  SELECT filter_order, k AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INTEGER AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS k)
),
r AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN x ELSE 0 END) AS toxic_lost
  FROM h, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""
