"""Aggregation (E) and scalar function (F) queries: wide selects over whole tables."""

from pyspark.sql import functions as F

from ..functions import aggregates as A
from ..functions import json as J
from ..functions import maths as M
from ..functions import spatial as P
from ..functions import strings as S
from ..functions import temporal as T
from .data import supply, table
from .registry import query

c = F.col


def r6(x, name):
    return F.round(x, 6).alias(name)


# -- E ---------------------------------------------------------------------------------------
@query("e01_count", """
SELECT l_returnflag AS flag, CAST(count(*) AS BIGINT) AS n, CAST(count(CASE WHEN l_discount > 0.05 THEN 1 END) AS BIGINT) AS discounted,
 CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts FROM lineitem GROUP BY 1""")
def e01(spark, sf):
    return table(spark, sf, "lineitem").groupBy(c("l_returnflag").alias("flag")).agg(
        F.count("*").alias("n"), F.count(F.when(c("l_discount") > 0.05, 1)).alias("discounted"), F.countDistinct("l_partkey").alias("parts")
    )


@query("e02_sum_avg_min_max", """
SELECT l_linestatus AS status, round(sum(l_extendedprice), 2) AS s, round(avg(l_quantity), 6) AS a, min(l_extendedprice) AS lo,
 max(l_extendedprice) AS hi, round(sum(DISTINCT l_quantity), 2) AS sd, round(avg(DISTINCT l_discount), 6) AS ad FROM lineitem GROUP BY 1""")
def e02(spark, sf):
    return table(spark, sf, "lineitem").groupBy(c("l_linestatus").alias("status")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("s"), r6(F.avg("l_quantity"), "a"), F.min("l_extendedprice").alias("lo"),
        F.max("l_extendedprice").alias("hi"), F.round(F.sum_distinct("l_quantity"), 2).alias("sd"), r6(F.expr("avg(DISTINCT l_discount)"), "ad"),
    )


@query("e03_collect", """
SELECT c_name, coalesce(array_to_string(list_sort(list(o_orderkey) FILTER (WHERE o_orderkey IS NOT NULL)), ','), '') AS ids
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' GROUP BY c_custkey, c_name""")
def e03(spark, sf):
    g = supply(spark, sf)
    m = g.match().node("c", "Customer").optional(g.match().node("c").out("PLACED").node("o", "Order", status="P")).df()
    ids = A.collect(c("o_id") - F.lit(6 * 10**12))
    return m.groupBy("c_id", "c_name").agg(ids.alias("ids")).select("c_name", F.array_join(c("ids").cast("array<string>"), ",").alias("ids"))


@query("e04_stdev", """
SELECT o_custkey AS k, CASE WHEN count(*) > 1 THEN round(stddev_samp(o_totalprice), 4) ELSE 0.0 END AS s,
 round(stddev_pop(o_totalprice), 4) AS p FROM orders GROUP BY 1""")
def e04(spark, sf):
    o = table(spark, sf, "orders").groupBy(c("o_custkey").alias("k"))
    return o.agg(F.round(A.stdev(c("o_totalprice")), 4).alias("s"), F.round(A.stdevp(c("o_totalprice")), 4).alias("p"))


@query("e05_percentiles", """
SELECT l_returnflag AS flag, quantile_disc(l_extendedprice, 0.9) AS d90, round(quantile_cont(l_extendedprice, 0.9), 6) AS c90,
 quantile_disc(l_extendedprice, 0.25) AS d25 FROM lineitem GROUP BY 1""")
def e05(spark, sf):
    q = A.quantiles(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", d90=("disc", 0.9), c90=("cont", 0.9), d25=("disc", 0.25))
    return q.select(c("l_returnflag").alias("flag"), "d90", r6(c("c90"), "c90"), "d25")


@query("e06_variance", """
SELECT l_suppkey AS k, CASE WHEN count(*) > 1 THEN round(stddev_samp(l_quantity), 6) ELSE 0.0 END AS s,
 CASE WHEN count(*) > 1 THEN round(var_samp(l_quantity), 6) ELSE 0.0 END AS v FROM lineitem GROUP BY 1""")
def e06(spark, sf):
    g = table(spark, sf, "lineitem").groupBy(c("l_suppkey").alias("k"))
    return g.agg(r6(A.stdev(c("l_quantity")), "s"), r6(A.variance(c("l_quantity")), "v"))


@query("e07_mode", """
WITH n AS (SELECT l_partkey AS k, l_quantity AS x, count(*) AS n FROM lineitem GROUP BY 1, 2),
m AS (SELECT k, max(n) AS top FROM n GROUP BY 1)
SELECT n.k, CASE WHEN count(*) = 1 THEN min(x) END AS mode FROM n JOIN m ON n.k = m.k AND n.n = m.top GROUP BY n.k""")
def e07(spark, sf):
    return A.mode(table(spark, sf, "lineitem"), ["l_partkey"], "l_quantity").withColumnRenamed("l_partkey", "k")


@query("e08_median", """
SELECT l_suppkey AS k, round(median(l_extendedprice), 6) AS median FROM lineitem GROUP BY 1""")
def e08(spark, sf):
    q = A.quantiles(table(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice", median=("cont", 0.5))
    return q.select(c("l_suppkey").alias("k"), r6(c("median"), "median"))


@query("e08_median_overall", "SELECT round(median(o_totalprice), 6) AS median FROM orders")
def e08_all(spark, sf):
    return A.quantiles(table(spark, sf, "orders"), [], "o_totalprice", median=("cont", 0.5)).select(r6(c("median"), "median"))


@query("e09_quartiles", """
WITH r AS (SELECT o_custkey AS k, o_totalprice AS x, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS i,
 count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT k, round((min(x) FILTER (WHERE i >= ceil(n / 4.0)) + min(x) FILTER (WHERE i >= floor(n / 4.0) + 1)) / 2, 6) AS lower_quartile,
 round((min(x) FILTER (WHERE i >= ceil(n * 0.75)) + min(x) FILTER (WHERE i >= least(floor(n * 0.75) + 1, n))) / 2, 6) AS upper_quartile
FROM r GROUP BY k""")
def e09(spark, sf):
    q = A.quantiles(table(spark, sf, "orders"), ["o_custkey"], "o_totalprice", lower=("step", 0.25), upper=("step", 0.75))
    return q.select(c("o_custkey").alias("k"), r6(c("lower"), "lower_quartile"), r6(c("upper"), "upper_quartile"))


@query("e10_missing_group", """
SELECT CAST(count(*) AS BIGINT) AS n, sum(o_totalprice) AS s, max(o_totalprice) AS hi FROM orders WHERE o_orderstatus = 'none'""")
def e10(spark, sf):
    m = supply(spark, sf).match().node("o", "Order", status="none").df()
    return m.agg(F.count("*").alias("n"), F.sum("o_total").alias("s"), F.max("o_total").alias("hi"))


# -- F ---------------------------------------------------------------------------------------
@query("f01_id", "SELECT c_custkey + 3000000000000 AS id, CAST(c_custkey + 3000000000000 AS VARCHAR) AS element_id FROM customer")
def f01(spark, sf):
    m = supply(spark, sf).match().node("c", "Customer").df()
    return m.select(c("c_id").alias("id"), c("c_id").cast("string").alias("element_id"))


@query("f02_labels_type_graph", """
SELECT 'Customer,Party' AS labels, 'LIVES_IN' AS type, 'supply' AS graph, CAST(count(*) AS BIGINT) AS n FROM customer
UNION ALL SELECT 'Supplier,Party', 'BASED_IN', 'supply', count(*) FROM supplier""")
def f02(spark, sf):
    g = supply(spark, sf)
    m = g.match().node("p", "Party").out(["LIVES_IN", "BASED_IN"], var="r").node().df()
    keys = [F.array_join("p_labels", ",").alias("labels"), c("r_type").alias("type"), F.lit(g.name).alias("graph")]
    return m.groupBy(*keys).agg(F.count("*").alias("n"))


@query("f03_properties_keys", """
SELECT s_suppkey + 4000000000000 AS id, 'acctbal,name' AS keys, s_name AS name FROM supplier
UNION ALL SELECT r_regionkey + 1000000000000, 'name', r_name FROM region""")
def f03(spark, sf):
    g = supply(spark, sf)
    nodes = g.nodes.where(F.array_contains("labels", "Supplier") | F.array_contains("labels", "Region"))
    props = F.to_json(F.struct(*g.node_props), {"ignoreNullFields": "true"})
    m = nodes.select("id", props.alias("p"))
    return m.select("id", F.array_join(F.array_sort(F.json_object_keys("p")), ",").alias("keys"), F.get_json_object("p", "$.name").alias("name"))


@query("f04_start_end_node", """
SELECT n_name, CAST(count(*) AS BIGINT) AS n, min(c_acctbal) AS poorest FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def f04(spark, sf):
    g = supply(spark, sf)
    r = g.edges.where("type = 'LIVES_IN'")
    start = g.nodes.select(c("id").alias("src"), c("acctbal"))
    end = g.nodes.select(c("id").alias("dst"), c("name").alias("n_name"))
    return r.select("src", "dst").join(start, "src").join(end, "dst").groupBy("n_name").agg(F.count("*").alias("n"), F.min("acctbal").alias("poorest"))


@query("f05_case_trim", """
SELECT p_partkey, upper(p_name) AS u, lower(p_brand) AS l, trim('  ' || p_name || ' ') AS t, ltrim('  ' || p_name || ' ') AS lt,
 rtrim('  ' || p_name || ' ') AS rt, CAST(length(p_name) AS BIGINT) AS n FROM part""")
def f05(spark, sf):
    padded = F.concat(F.lit("  "), c("p_name"), F.lit(" "))
    return table(spark, sf, "part").select(
        "p_partkey", S.to_upper(c("p_name")).alias("u"), S.to_lower(c("p_brand")).alias("l"), F.btrim(padded).alias("t"),
        F.ltrim(padded).alias("lt"), F.rtrim(padded).alias("rt"), F.character_length("p_name").cast("long").alias("n"),
    )


@query("f06_size_is_empty", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS n, CAST(len(string_split(text, ' ')) AS BIGINT) AS words, length(text) = 0 AS empty,
 true AS null_empty, length(trim(text)) = 0 AS blank FROM documents""")
def f06(spark, sf):
    words = F.split("text", " ")
    return table(spark, sf, "documents").select(
        "doc_id", S.size_of_text(c("text")).cast("long").alias("n"), F.size(words).cast("long").alias("words"),
        S.is_empty_text(c("text")).alias("empty"), S.is_empty_text(F.lit(None).cast("string")).alias("null_empty"),
        S.is_empty_text(F.trim("text")).alias("blank"),
    )


@query("f07_reverse", "SELECT doc_id, md5(array_to_string(list_reverse(string_split(text, '')), '')) AS r FROM documents")
def f07(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(S.reverse(c("text"))).alias("r"))


@query("f08_substring", """
SELECT c_custkey, substring(c_name, 4, 6) AS mid, substring(c_name, 10) AS rest, left(c_name, 3) AS l, right(c_name, 4) AS r FROM customer""")
def f08(spark, sf):
    n = c("c_name")
    return table(spark, sf, "customer").select(
        "c_custkey", S.substring(n, 3, 6).alias("mid"), S.substring(n, 9).alias("rest"), S.left(n, 3).alias("l"), S.right(n, 4).alias("r")
    )


@query("f09_replace_split", """
SELECT page_id, replace(url, 'example.com', 'host') AS u, array_to_string(list_filter(string_split(url, '/'), lambda x: x <> ''), '|') AS parts FROM pages""")
def f09(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", S.replace(c("url"), "example.com", "host").alias("u"), F.array_join(S.split(c("url"), "/"), "|").alias("parts")
    )


@query("f10_rounding", """
SELECT c_custkey, abs(c_acctbal) AS a, CAST(ceil(c_acctbal) AS BIGINT) AS ce, CAST(floor(c_acctbal) AS BIGINT) AS fl,
 CAST(sign(c_acctbal) AS BIGINT) AS si, round(c_acctbal, 0) AS ro, round(c_acctbal, 1) AS r1 FROM customer""")
def f10(spark, sf):
    b = c("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", F.abs(b).alias("a"), M.ceil(b).alias("ce"), M.floor(b).alias("fl"), M.sign(b).alias("si"),
        F.round(b).alias("ro"), F.round(b, 1).alias("r1"),
    )


_X = "(p_size / 60.0)"


@query("f11_math", f"""
SELECT p_partkey, round(sqrt({_X}), 6) AS sq, round(ln({_X}), 6) AS lo, round(log10({_X}), 6) AS l10, round(exp({_X}), 6) AS ex,
 round(sin({_X}), 6) AS si, round(cos({_X}), 6) AS co, round(tan({_X}), 6) AS ta, round(cot({_X}), 6) AS ct, round(asin({_X}), 6) AS asi,
 round(acos({_X}), 6) AS aco, round(atan({_X}), 6) AS ata, round(atan2({_X}, 2.0), 6) AS at2, round(sinh({_X}), 6) AS sh,
 round(cosh({_X}), 6) AS ch, round(tanh({_X}), 6) AS th, round(1 / tanh({_X}), 6) AS cth, round(degrees({_X}), 6) AS de,
 round(radians({_X}), 6) AS ra, round((1 - cos({_X})) / 2, 6) AS ha, isnan({_X}) AS nan, round(pi(), 6) AS pi, round(exp(1), 6) AS e,
 true AS rand_ok FROM part""")
def f11(spark, sf):
    x = c("p_size") / 60.0
    rand = F.rand(7)
    return table(spark, sf, "part").select(
        "p_partkey", r6(F.sqrt(x), "sq"), r6(F.ln(x), "lo"), r6(F.log10(x), "l10"), r6(F.exp(x), "ex"), r6(F.sin(x), "si"),
        r6(F.cos(x), "co"), r6(F.tan(x), "ta"), r6(F.cot(x), "ct"), r6(F.asin(x), "asi"), r6(F.acos(x), "aco"), r6(F.atan(x), "ata"),
        r6(F.atan2(x, F.lit(2.0)), "at2"), r6(F.sinh(x), "sh"), r6(F.cosh(x), "ch"), r6(F.tanh(x), "th"), r6(M.coth(x), "cth"),
        r6(F.degrees(x), "de"), r6(F.radians(x), "ra"), r6(M.haversin(x), "ha"), F.isnan(x).alias("nan"), r6(F.pi(), "pi"),
        r6(F.e(), "e"), ((rand >= 0) & (rand < 1)).alias("rand_ok"),
    )


@query("f12_library_math", f"""
SELECT p_partkey, round(acosh(1 + {_X}), 6) AS ach, round(asinh({_X}), 6) AS ash, round(atanh({_X}), 6) AS ath,
 round(atan2({_X}, p_size), 6) AS at2, round(pow({_X}, 3), 6) AS po, pow(CAST(NULL AS DOUBLE), 2) AS pn, CAST(p_size * p_size AS BIGINT) AS sq FROM part""")
def f12(spark, sf):
    x = c("p_size") / 60.0
    return table(spark, sf, "part").select(
        "p_partkey", r6(F.acosh(1 + x), "ach"), r6(F.asinh(x), "ash"), r6(F.atanh(x), "ath"), r6(F.atan2(x, c("p_size")), "at2"),
        r6(M.power(x, F.lit(3)), "po"), M.power(F.lit(None).cast("double"), F.lit(2)).alias("pn"), M.square(c("p_size").cast("long")).alias("sq"),
    )


@query("f13_replicate_proper", """
SELECT p_partkey, repeat(p_brand, p_size % 3) AS r,
 array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || lower(substring(w, 2))), ' ') AS p FROM part""")
def f13(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", S.replicate(c("p_brand"), c("p_size") % 3).alias("r"), S.proper(c("p_name")).alias("p")
    )


@query("f14_padding", """
SELECT p_partkey, CASE WHEN length(p_name) < 12 THEN lpad(p_name, 12, ' ') ELSE p_name END || '|' AS l,
 CASE WHEN length(p_name) < 12 THEN rpad(p_name, 12, ' ') ELSE p_name END || '|' AS r,
 repeat(' ', greatest(12 - length(p_name), 0) // 2) || p_name || repeat(' ', greatest(12 - length(p_name), 0) - greatest(12 - length(p_name), 0) // 2) || '|' AS m
FROM part""")
def f14(spark, sf):
    n, bar = c("p_name"), F.lit("|")
    return table(spark, sf, "part").select(
        "p_partkey", F.concat(S.padl(n, 12), bar).alias("l"), F.concat(S.padr(n, 12), bar).alias("r"), F.concat(S.padc(n, 12), bar).alias("m")
    )


@query("f15_charindex", """
SELECT doc_id, CAST(instr(text, 'la') AS BIGINT) AS a,
 CAST(CASE WHEN instr(substring(text, 10), 'la') = 0 THEN 0 ELSE instr(substring(text, 10), 'la') + 9 END AS BIGINT) AS b,
 CAST(0 AS BIGINT) AS e, left(text, 5) AS l, right(text, 5) AS r FROM documents""")
def f15(spark, sf):
    t = c("text")
    return table(spark, sf, "documents").select(
        "doc_id", S.charindex("la", t).cast("long").alias("a"), S.charindex("la", t, 10).cast("long").alias("b"),
        S.charindex("", t).cast("long").alias("e"), S.left(t, 5).alias("l"), S.right(t, 5).alias("r"),
    )


@query("f16_strfilter", "SELECT doc_id, md5(regexp_replace(text, '[^aeiou ]', '', 'g')) AS vowels FROM documents")
def f16(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(S.strfilter(c("text"), "aeiou ")).alias("vowels"))


def _soundex_sql(x):
    letters = f"regexp_replace(translate({x}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[^A-Z]', '', 'g')"
    codes = f"translate({letters}, 'BFPVCGJKQSXZDTLMNRAEHIOUWY', '111122222222334556')"
    return f"CASE WHEN {letters} = '' THEN '?000' ELSE left({letters}, 1) || rpad(left({codes}, 3), 3, '0') END"


@query("f17_difference", f"""
SELECT p_partkey, CAST((a[1] = b[1])::INT + (a[2] = b[2])::INT + (a[3] = b[3])::INT + (a[4] = b[4])::INT AS BIGINT) AS d
FROM (SELECT p_partkey, {_soundex_sql('p_name')} AS a, {_soundex_sql('p_type')} AS b FROM part)""")
def f17(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.difference(c("p_name"), c("p_type")).cast("long").alias("d"))


@query("f18_conversions", """
SELECT c_custkey, CAST(c_acctbal AS VARCHAR) AS s, CAST(trunc(c_acctbal) AS BIGINT) AS i, CAST(NULL AS BIGINT) AS bad, c_acctbal + 0.0 AS f,
 CAST(NULL AS DOUBLE) AS bad_f, c_acctbal > 0 AS b, CAST(NULL AS BOOLEAN) AS bad_b FROM customer""")
def f18(spark, sf):
    text = M.to_string(c("c_acctbal"))
    return table(spark, sf, "customer").select(
        "c_custkey", text.alias("s"), M.to_integer(text).alias("i"), M.to_integer(c("c_name")).alias("bad"), M.to_float(text).alias("f"),
        M.to_float(c("c_name")).alias("bad_f"), M.to_boolean(F.when(c("c_acctbal") > 0, "TRUE").otherwise("false")).alias("b"),
        M.to_boolean(c("c_name")).alias("bad_b"),
    )


@query("f19_coalesce_nullif", """
SELECT doc_id, coalesce(quality, -1) AS q, nullif(lang, 'fr') AS l, CASE WHEN quality IS NULL THEN 'NULL' ELSE 'INTEGER' END AS tq,
 'STRING' AS tt, 'FLOAT' AS tf, 'BOOLEAN' AS tb, true AS uuid_ok FROM documents LEFT JOIN labels USING (doc_id)""")
def f19(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select(
        "doc_id", F.coalesce("quality", F.lit(-1)).alias("q"), M.null_if(c("lang"), F.lit("fr")).alias("l"), M.value_type(c("quality")).alias("tq"),
        M.value_type(c("lang")).alias("tt"), M.value_type(c("n_chars") * 1.5).alias("tf"), M.value_type(c("n_chars") > 0).alias("tb"),
        F.uuid().rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("uuid_ok"),
    )


@query("f20_lists", """
SELECT doc_id, w[1] AS h, w[-1] AS l, md5(array_to_string(w[2:], ' ')) AS t, array_to_string(range(1, length(lang) * 4 + 1, 3), ',') AS r,
 array_to_string(range(5, 0, -2), ',') AS d FROM (SELECT doc_id, lang, string_split(text, ' ') AS w FROM documents)""")
def f20(spark, sf):
    w = F.split("text", " ")
    up = M.int_range(F.lit(1).cast("long"), (F.length("lang") * 4).cast("long"), 3)
    down = M.int_range(F.lit(5).cast("long"), F.lit(1).cast("long"), -2)
    text = lambda x: F.array_join(x.cast("array<string>"), ",")
    return table(spark, sf, "documents").select(
        "doc_id", M.head(w).alias("h"), M.last(w).alias("l"), F.md5(F.array_join(M.tail(w), " ")).alias("t"), text(up).alias("r"), text(down).alias("d")
    )


@query("f21_temporal_constructors", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(make_date(year(o_orderdate), 1, 1), '%Y-%m-%d') AS y,
 strftime(make_timestamp(year(o_orderdate), month(o_orderdate), 15, 7, 30, 0), '%Y-%m-%d %H:%M:%S') AS ts, '07:05:00' AS t,
 strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS p, true AS now_ok FROM orders""")
def f21(spark, sf):
    at = c("o_orderdate")
    made = T.datetime(year=F.year(at), month=F.month(at), day=15, hour=7, minute=30)
    fmt = "yyyy-MM-dd HH:mm:ss"
    return table(spark, sf, "orders").select(
        "o_orderkey", T.date(F.date_format(at, "yyyy-MM-dd")).cast("string").alias("d"), T.date(year=F.year(at)).cast("string").alias("y"),
        F.date_format(made, fmt).alias("ts"), T.time(hour=7, minute=5).alias("t"), F.date_format(T.datetime(F.date_format(at, fmt)), fmt).alias("p"),
        (T.timestamp_ms() > 1_600_000_000_000).alias("now_ok"),
    )


@query("f22_from_epoch", """
SELECT event_id, strftime(make_timestamp((1704067200 + event_id * 61) * 1000000), '%Y-%m-%d %H:%M:%S') AS s,
 strftime(make_timestamp((1704067200000 + event_id * 61) * 1000), '%Y-%m-%d %H:%M:%S') AS ms FROM events""")
def f22(spark, sf):
    fmt = "yyyy-MM-dd HH:mm:ss"
    n = c("event_id") * 61
    return table(spark, sf, "events").select(
        "event_id", F.date_format(T.from_epoch(n + F.lit(1704067200)), fmt).alias("s"),
        F.date_format(T.from_epoch_millis(n + F.lit(1704067200000)), fmt).alias("ms"),
    )


@query("f23_truncate", """
SELECT event_id, strftime(date_trunc('year', ts), '%Y-%m-%d') AS y, strftime(date_trunc('month', ts), '%Y-%m-%d') AS m,
 strftime(date_trunc('day', ts), '%Y-%m-%d') AS d FROM events""")
def f23(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", *[T.truncate(u, c("ts")).cast("string").alias(u[0]) for u in ("year", "month", "day")]
    )


@query("f24_durations", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(trunc(d / 86400000000) AS BIGINT) AS days, CAST(trunc(d / 1000000) AS BIGINT) AS seconds,
 CAST(trunc(d / 86400000000.0 / 30.44) AS BIGINT) AS months, CAST(trunc(d / 86400000000) AS BIGINT) AS b_days,
 CAST(trunc((d % 86400000000) / 1000000) AS BIGINT) AS b_seconds
FROM (SELECT l_orderkey, l_linenumber, l_partkey, epoch_us(l_shipdate) - epoch_us(o_orderdate + INTERVAL 5 HOUR) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def f24(spark, sf):
    m = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), c("l_orderkey") == c("o_orderkey"))
    a, b = c("o_orderdate") + F.expr("INTERVAL 5 HOURS"), c("l_shipdate")
    between = T.between(a, b)
    return m.select(
        "l_orderkey", "l_linenumber", "l_partkey", T.in_days(a, b).alias("days"), T.in_seconds(a, b).alias("seconds"), T.in_months(a, b).alias("months"),
        between["days"].cast("long").alias("b_days"), between["seconds"].cast("long").alias("b_seconds"),
    )


@query("f25_date_add_sub", """
SELECT o_orderkey, strftime(o_orderdate + INTERVAL 14 MONTH + INTERVAL 10 DAY + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS a,
 strftime(o_orderdate - INTERVAL 40 DAY - INTERVAL 90 SECOND, '%Y-%m-%d %H:%M:%S') AS s FROM orders""")
def f25(spark, sf):
    fmt = "yyyy-MM-dd HH:mm:ss"
    at = c("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.date_format(T.date_add(at, T.duration(years=1, months=2, days=10, hours=3)), fmt).alias("a"),
        F.date_format(T.date_sub(at, T.duration(days=40, seconds=90)), fmt).alias("s"),
    )


_LAT, _LON = "(c_acctbal / 200)", "(c_nationkey * 10 - 120.0)"


@query("f26_points", f"""
SELECT c_custkey, round(6371000.0 * 2 * asin(sqrt((1 - cos(radians(48.85 - {_LAT}))) / 2 + cos(radians({_LAT})) * cos(radians(48.85))
  * (1 - cos(radians(2.35 - {_LON}))) / 2)), 3) AS metres, round(sqrt(pow(3 - c_acctbal, 2) + pow(4 - c_nationkey, 2)), 6) AS plane,
 {_LAT} BETWEEN 0 AND 40 AND {_LON} BETWEEN -50 AND 60 AS inside, CAST(4326 AS BIGINT) AS srid FROM customer""")
def f26(spark, sf):
    here = P.point(latitude=c("c_acctbal") / 200, longitude=c("c_nationkey") * 10 - 120.0)
    flat = P.point(x=c("c_acctbal"), y=c("c_nationkey"))
    return table(spark, sf, "customer").select(
        "c_custkey", F.round(P.distance(here, P.point(latitude=48.85, longitude=2.35)), 3).alias("metres"),
        r6(P.distance(flat, P.point(x=3.0, y=4.0)), "plane"),
        P.within_bbox(here, P.point(latitude=0.0, longitude=-50.0), P.point(latitude=40.0, longitude=60.0)).alias("inside"),
        here["srid"].cast("long").alias("srid"),
    )


@query("f27_json", """
SELECT event_id, props->>'$.k' AS k, array_to_string(json_keys(props), ',') AS keys, 'object' AS t, 'integer' AS tk FROM events""")
def f27(spark, sf):
    p = c("props")
    return table(spark, sf, "events").select(
        "event_id", J.json_get(p, "k").alias("k"), F.array_join(J.json_keys(p), ",").alias("keys"), J.json_type(p).alias("t"), J.json_type(p, "$.k").alias("tk")
    )
