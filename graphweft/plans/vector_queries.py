"""Vector queries (H)."""

import numpy as np
from pyspark.sql import functions as F

from ..functions import bits, vectors as V
from ..operators import ivf, neighbour_graph
from ..operators.knn import knn, knn_join
from ..operators.rescore import add_codes, rescore
from ..session import cut, new_folder
from ..sources import vectors as S
from .data import table
from .registry import query

c = F.col

# The query vector of single searches: the vector with the smallest id.
Q = "(SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1)"
E = "embedding::DOUBLE[]"
L1 = f"list_sum(list_transform(list_zip({E}, q), lambda p: abs(p[1] - p[2])))"
BITS = "list_transform({v}, lambda x, i: CASE WHEN x {op} 0 THEN 1::UBIGINT << (i - 1)::UBIGINT ELSE 0::UBIGINT END)"


def _word(op, v="embedding"):
    return f"CAST(list_sum({BITS.format(v=v, op=op)}) AS UBIGINT)"


INT8 = "list_transform({v}, lambda x: CAST(trunc(greatest(-128.0, least(127.0, (x::DOUBLE + 1.0) / (2.0 / 255.0) - 128.0))) AS INTEGER))"


def base(spark, sf):
    return table(spark, sf, "embeddings")


def first_vector(spark, sf):
    return base(spark, sf).orderBy("vec_id").first().embedding


def literal(values, kind="array<float>"):
    return F.array(*[F.lit(float(x)) for x in values]).cast(kind)


def r6(x, name):
    return F.round(x, 6).alias(name)


@query("h01_distance_l2", f"SELECT vec_id, round(list_distance({E}, {Q}), 6) AS d FROM embeddings")
def h01(spark, sf):
    return base(spark, sf).select("vec_id", r6(V.distance_l2(c("embedding"), literal(first_vector(spark, sf))), "d"))


@query("h02_distance_l1", f"SELECT vec_id, round({L1}, 6) AS d FROM (SELECT *, {Q} AS q FROM embeddings)")
def h02(spark, sf):
    return base(spark, sf).select("vec_id", r6(V.distance_l1(c("embedding"), literal(first_vector(spark, sf))), "d"))


@query("h03_distance_cosine", f"SELECT vec_id, abs(round(list_cosine_distance({E}, {Q}), 6)) AS d FROM embeddings")
def h03(spark, sf):
    return base(spark, sf).select("vec_id", F.abs(F.round(V.distance_cosine(c("embedding"), literal(first_vector(spark, sf))), 6)).alias("d"))


@query("h04_distance_hamming", f"""
SELECT vec_id, CAST(bit_count(xor(w, (SELECT {_word('>')} FROM embeddings ORDER BY vec_id LIMIT 1))) AS BIGINT) AS d
FROM (SELECT vec_id, {_word('>')} AS w FROM embeddings)""")
def h04(spark, sf):
    target = V.quantize_binary(literal(first_vector(spark, sf)))
    return base(spark, sf).select("vec_id", V.distance_hamming(V.quantize_binary(c("embedding")), target).cast("long").alias("d"))


@query("h05_length_type_json", """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n, 'float32' AS t, 'int8' AS t8, 'bit' AS tb,
 '[' || array_to_string(list_transform(embedding, lambda x: CAST(CAST(round(x * 100) AS INTEGER) AS VARCHAR)), ',') || ']' AS js,
 CAST(64 AS BIGINT) AS nb, CAST(64 AS BIGINT) AS nw, 'bit' AS tp, '[' || array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), ',') || ']' AS jb FROM embeddings""")
def h05(spark, sf):
    v = c("embedding")
    return base(spark, sf).select(
        "vec_id", V.vec_length(v).cast("long").alias("n"), V.vec_type(v).alias("t"), V.vec_type(V.quantize_int8(v)).alias("t8"),
        V.vec_type(V.quantize_binary(v)).alias("tb"), V.vec_to_json(F.transform(v, lambda x: F.round(x * 100).cast("int"))).alias("js"),
        bits.length(bits.quantize(v)).cast("long").alias("nb"), V.vec_length(V.quantize_binary(v)).cast("long").alias("nw"), bits.kind(bits.quantize(v)).alias("tp"), bits.to_json(bits.quantize(v)).alias("jb"),
    )


_FOLD = "round(list_sum(list_transform({v}, lambda x, i: x::DOUBLE * i)), 6)"


def _fold(v):
    """A position-weighted sum: one checkable number per vector."""
    return F.round(F.aggregate(F.transform(v, lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x), 6)


@query("h06_add_sub", f"""
SELECT vec_id, {_FOLD.format(v='list_transform(list_zip(e, q), lambda p: p[1] + p[2])')} AS added,
 {_FOLD.format(v='list_transform(list_zip(e, q), lambda p: p[1] - p[2])')} AS subtracted FROM (SELECT vec_id, {E} AS e, {Q} AS q FROM embeddings)""")
def h06(spark, sf):
    v, q = c("embedding").cast("array<double>"), literal(first_vector(spark, sf), "array<double>")
    return base(spark, sf).select("vec_id", _fold(V.vec_add(v, q)).alias("added"), _fold(V.vec_sub(v, q)).alias("subtracted"))


@query("h07_slice", f"""SELECT vec_id, {_FOLD.format(v='embedding[9:24]')} AS part, CAST(16 AS BIGINT) AS n,
 '[' || array_to_string(list_transform(embedding[9:24], lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), ',') || ']' AS bits FROM embeddings""")
def h07(spark, sf):
    part = V.vec_slice(c("embedding"), 8, 24)
    return base(spark, sf).select("vec_id", _fold(part).alias("part"), F.size(part).cast("long").alias("n"), bits.to_json(bits.part(bits.quantize(c("embedding")), 8, 24)).alias("bits"))


@query("h08_normalize", f"""
SELECT vec_id, {_FOLD.format(v='list_transform(e, lambda x: x / n)')} AS unit FROM
 (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM
   (SELECT vec_id, list_transform({E}, lambda x, i: x * (i + 1)) AS e FROM embeddings))""")
def h08(spark, sf):
    stretched = F.transform(c("embedding"), lambda x, i: x.cast("double") * (i + 2))
    return base(spark, sf).select("vec_id", stretched.alias("v")).select("vec_id", _fold(V.vec_normalize(c("v"))).alias("unit"))


@query("h09_constructors", f"""
SELECT vec_id, {_FOLD.format(v='embedding')} AS f, {_FOLD.format(v='list_transform(embedding, lambda x: CAST(trunc(x::DOUBLE * 100) AS INTEGER))')} AS i8,
 CAST(1 AS BIGINT) AS words, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS from_text, true AS packed FROM embeddings""")
def h09(spark, sf):
    v = c("embedding")
    small = F.transform(v, lambda x: (x.cast("double") * 100).cast("int"))
    packed = base(spark, sf).select(
        "vec_id", _fold(V.vec_f32(F.to_json(v), parse=True)).alias("f"), _fold(V.vec_int8(F.to_json(small), parse=True)).alias("i8"),
        V.quantize_binary(v).alias("w"), bits.quantize(v).alias("q"),
    )
    text = packed.withColumn("text", bits.to_json(c("q")))
    again = text.withColumn("b", bits.vec_bit(c("text"), parse=True))
    return again.select(
        "vec_id", "f", "i8", F.size("w").cast("long").alias("words"),
        F.array_join(bits.each(c("b")).cast("array<string>"), "").alias("from_text"), (bits.words(bits.vec_bit(c("q"))) == c("w")).alias("packed"),
    )


@query("h10_quantize_int8", f"SELECT vec_id, array_to_string({INT8.format(v='embedding')}, ',') AS code FROM embeddings")
def h10(spark, sf):
    return base(spark, sf).select("vec_id", F.array_join(V.quantize_int8(c("embedding")).cast("array<string>"), ",").alias("code"))


@query("h11_quantize_binary", f"""
SELECT vec_id, CAST(CASE WHEN w >= 9223372036854775808 THEN w::HUGEINT - 18446744073709551616 ELSE w::HUGEINT END AS BIGINT) AS word
FROM (SELECT vec_id, {_word('>')} AS w FROM embeddings)""")
def h11(spark, sf):
    return base(spark, sf).select("vec_id", V.quantize_binary(c("embedding"))[0].alias("word"))


@query("h12_each", """
SELECT vec_id, CAST(i - 1 AS BIGINT) AS pos, round(embedding[i]::DOUBLE, 6) AS value FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def h12(spark, sf):
    each = base(spark, sf).select("vec_id", V.vec_each(c("embedding")))
    return each.select("vec_id", c("pos").cast("long").alias("pos"), r6(c("col").cast("double"), "value"))


def _knn_sql(distance, k, where="true", bound="true"):
    return f"""
SELECT vec_id AS id, abs(round(d, 6)) AS distance FROM (SELECT vec_id, {distance} AS d FROM (SELECT *, {Q} AS q FROM embeddings) WHERE {where})
WHERE {bound} ORDER BY d, vec_id LIMIT {k}"""


def _rounded(df):
    return df.select("id", F.abs(F.round("distance", 6)).alias("distance"))


def _one(spark, sf, k, metric, **more):
    return _rounded(knn(base(spark, sf), first_vector(spark, sf), k, metric, "vec_id", "embedding", **more))


@query("h13_knn_l2", _knn_sql(f"list_distance({E}, q)", 20))
def h13_l2(spark, sf):
    return _one(spark, sf, 20, "l2")


@query("h13_knn_l1", _knn_sql(L1, 20))
def h13_l1(spark, sf):
    return _one(spark, sf, 20, "l1")


@query("h13_knn_cosine", _knn_sql(f"list_cosine_distance({E}, q)", 20))
def h13_cosine(spark, sf):
    return _one(spark, sf, 20, "cosine")


@query("h13_knn_hamming", f"""
SELECT vec_id AS id, CAST(bit_count(xor(w, (SELECT {_word('>')} FROM embeddings ORDER BY vec_id LIMIT 1))) AS DOUBLE) AS distance
FROM (SELECT vec_id, {_word('>')} AS w FROM embeddings) ORDER BY distance, id LIMIT 20""")
def h13_hamming(spark, sf):
    coded = base(spark, sf).withColumn("code", V.quantize_binary(c("embedding")))
    target = coded.orderBy("vec_id").first().code
    return knn(coded, target, 20, "hamming", "vec_id", "code")


@query("h14_knn_metadata", _knn_sql(f"list_distance({E}, q)", 15, "label IN (1, 3, 4) AND label <> 4 AND label >= 1"))
def h14(spark, sf):
    return _one(spark, sf, 15, "l2", where=c("label").isin(1, 3, 4) & (c("label") != 4) & (c("label") >= 1))


@query("h15_knn_partition", _knn_sql(f"list_distance({E}, q)", 15, "label > 2 AND label <= 6"))
def h15(spark, sf):
    path = new_folder(spark, "vectors")
    S.write_table(base(spark, sf), path, ["label"], "vec_id")
    stored = S.read_table(spark, path)
    return _rounded(knn(stored, first_vector(spark, sf), 15, "l2", "vec_id", "embedding", where=(c("label") > 2) & (c("label") <= 6)))


@query("h16_knn_candidates", _knn_sql(f"list_distance({E}, q)", 15, "vec_id IN (SELECT doc_id FROM labels WHERE quality = 1)"))
def h16(spark, sf):
    return _one(spark, sf, 15, "l2", ids=table(spark, sf, "labels").where("quality = 1").select("doc_id"))


@query("h17_knn_bounds", _knn_sql(f"list_distance({E}, q)", 25, "true", "d > 1.0 AND d <= 1.3"))
def h17(spark, sf):
    return _one(spark, sf, 25, "l2", bounds=(c("distance") > 1.0) & (c("distance") <= 1.3))


@query("h18_knn_join", """
SELECT query_id, id, CAST(rank AS BIGINT) AS rank FROM (
 SELECT a.vec_id AS query_id, b.vec_id AS id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) AS rank
 FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE rank <= 5""")
def h18(spark, sf):
    e = base(spark, sf)
    pairs = knn_join(e, e, 5, query_id="vec_id", base_id="vec_id", skip_self=True)
    return pairs.select("query_id", "id", c("rank").cast("long").alias("rank"))


@query("h18_knn_join_blocks", """
SELECT query_id, id, round(d, 6) AS distance FROM (
 SELECT a.vec_id AS query_id, b.vec_id AS id, list_cosine_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) AS rank
 FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE rank <= 3""")
def h18_blocks(spark, sf):
    e = base(spark, sf)
    pairs = knn_join(e, e, 3, "cosine", "vec_id", "vec_id", skip_self=True, chunk_rows=100)
    return pairs.select("query_id", "id", r6(c("distance"), "distance"))


@query("h19_point_lookup", f"SELECT vec_id, label, {_FOLD.format(v='embedding')} AS f FROM embeddings WHERE vec_id = 137")
def h19(spark, sf):
    return S.point_lookup(base(spark, sf), "vec_id", 137).select("vec_id", "label", _fold(c("embedding")).alias("f"))


@query("h19_full_scan", f"SELECT vec_id, label, {_FOLD.format(v='embedding')} AS f FROM embeddings")
def h19_scan(spark, sf):
    return base(spark, sf).select("vec_id", "label", _fold(c("embedding")).alias("f"))


@query("h20_insert_update_delete", f"""
SELECT vec_id, label, CASE WHEN label = 4 THEN {_FOLD.format(v='list_transform(embedding, lambda x: x::DOUBLE * 2)')} ELSE {_FOLD.format(v='embedding')} END AS f
 FROM embeddings WHERE label <> 7
UNION ALL SELECT vec_id + 1000000000, label, {_FOLD.format(v='embedding')} FROM embeddings WHERE label = 2""")
def h20(spark, sf):
    e = base(spark, sf)
    grown = S.insert(e, e.where("label = 2").withColumn("vec_id", c("vec_id") + F.lit(1_000_000_000)), "vec_id")
    doubled = e.where("label = 4").select("vec_id", F.transform("embedding", lambda x: x * 2).alias("embedding"))
    changed = S.update(grown, doubled, "vec_id", partition_keys=("label",))
    kept = S.delete(changed, e.where("label = 7").select("vec_id"), "vec_id")
    return kept.select("vec_id", "label", _fold(c("embedding")).alias("f"))


def _rescore_sql(coarse):
    return f"""
WITH q AS (SELECT embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1),
coarse AS (SELECT vec_id, embedding, {coarse} AS cd, q FROM embeddings, q ORDER BY cd, vec_id LIMIT 80)
SELECT vec_id AS id, round(list_distance({E}, q::DOUBLE[]), 6) AS distance FROM coarse ORDER BY list_distance({E}, q::DOUBLE[]), vec_id LIMIT 10"""


@query("h21_rescore_bit", _rescore_sql(f"bit_count(xor({_word('>=')}, {_word('>=', 'q')}))"))
def h21(spark, sf):
    return _rounded(rescore(add_codes(base(spark, sf), "bit"), first_vector(spark, sf), 10, "bit", "l2", 8, "vec_id"))


@query("h21_rescore_int8", _rescore_sql(f"list_distance({INT8.format(v='embedding')}::DOUBLE[], {INT8.format(v='q')}::DOUBLE[])"))
def h21_int8(spark, sf):
    return _rounded(rescore(add_codes(base(spark, sf), "int8"), first_vector(spark, sf), 10, "int8", "l2", 8, "vec_id"))


# Centroids that SQL can compute too: the mean vector of each label.
_CENTRES = """
dims AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings),
centre AS (SELECT label AS cell, list(m ORDER BY i) AS v FROM (SELECT label, i, avg(x) AS m FROM dims GROUP BY 1, 2) GROUP BY 1),
near AS (SELECT vec_id, embedding::DOUBLE[] AS e, cell, row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(embedding::DOUBLE[], v), cell) AS r
 FROM embeddings, centre),
cells AS (SELECT vec_id, e, cell FROM near WHERE r = 1)
"""


def label_centres(spark, sf):
    each = base(spark, sf).select("label", F.posexplode("embedding"))
    means = each.groupBy("label", "pos").agg(F.avg(c("col").cast("double")).alias("m"))
    rows = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("v")).orderBy("label").collect()
    return np.array([[x.m for x in r.v] for r in rows])  # one row per label


@query("h22_ivf_train", """
SELECT CAST(16 AS BIGINT) AS cells, CAST(count(*) AS BIGINT) AS vectors, true AS nearer_than_mean FROM embeddings""")
def h22(spark, sf):
    e = base(spark, sf)
    centres = ivf.train(e, 16)
    mean = np.array([neighbour_graph.mean_vector(e)])
    spread = {}
    for name, m in (("trained", centres), ("mean", mean)):
        rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "id long, embedding array<double>")
        spread[name] = knn_join(e, rows, 1, query_id="vec_id").agg(F.avg("distance")).first()[0]
    nearer = spread["trained"] < spread["mean"]
    return e.agg(F.lit(len(centres)).cast("long").alias("cells"), F.count("*").alias("vectors"), F.lit(nearer).alias("nearer_than_mean"))


@query("h23_ivf_assign", f"WITH {_CENTRES} SELECT vec_id, CAST(cell AS BIGINT) AS cell FROM cells")
def h23(spark, sf):
    return ivf.assign(base(spark, sf), label_centres(spark, sf)).select("vec_id", c("cell").cast("long").alias("cell"))


def _ivf_sql(nprobe, k):
    return f"""
WITH {_CENTRES}, pairs AS (SELECT n.vec_id AS query_id, b.vec_id AS id, list_distance(n.e, b.e) AS d FROM near n JOIN cells b ON b.cell = n.cell WHERE n.r <= {nprobe})
SELECT query_id, id, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS rank FROM pairs) WHERE rank <= {k}"""


def _ivf(spark, sf, nprobe, k, **more):
    e, centres = base(spark, sf), label_centres(spark, sf)
    path = new_folder(spark, "ivf")
    ivf.write(ivf.assign(e, centres), path, "vec_id")
    found = ivf.search(e, ivf.read(spark, path), centres, k, nprobe, query_id="vec_id", base_id="vec_id", **more)
    return found.select("query_id", "id", c("rank").cast("long").alias("rank"))


@query("h24_ivf_search", _ivf_sql(2, 5))
def h24(spark, sf):
    return _ivf(spark, sf, 2, 5)


@query("h24_ivf_search_blocks", _ivf_sql(3, 4))
def h24_blocks(spark, sf):
    return _ivf(spark, sf, 3, 4, chunk_rows=150)


@query("h24_ivf_all_probes_exact", """
SELECT query_id, id, CAST(rank AS BIGINT) AS rank FROM (
 SELECT a.vec_id AS query_id, b.vec_id AS id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) AS rank
 FROM embeddings a, embeddings b) WHERE rank <= 5""")
def h24_exact(spark, sf):
    return _ivf(spark, sf, 10, 5)


def _recall(found, exact, k):
    """Share of the exact neighbours that were found."""
    hits = found.select("query_id", "id").join(exact.select("query_id", "id"), ["query_id", "id"])
    return hits.count() / max(exact.count(), 1)


@query("h24_ivf_quantized", """
SELECT CAST(count(*) AS BIGINT) AS queries, true AS int8_ok, true AS binary_ok FROM embeddings""")
def h24_quantized(spark, sf):
    e, centres = base(spark, sf), label_centres(spark, sf)
    index = cut(ivf.assign(e, centres))
    exact = cut(knn_join(e, e, 10, query_id="vec_id", base_id="vec_id"))
    ok = {}
    for kind, oversample, floor in (("int8", 8, 0.95), ("binary", 64, 0.9)):
        found = ivf.search(e, index, centres, 10, 10, query_id="vec_id", base_id="vec_id", quantizer=kind, oversample=oversample)
        ok[kind] = _recall(found, exact, 10) >= floor
    return e.agg(F.count("*").alias("queries"), F.lit(ok["int8"]).alias("int8_ok"), F.lit(ok["binary"]).alias("binary_ok"))


@query("h25_neighbour_graph", """
SELECT CAST(count(*) AS BIGINT) AS queries, true AS recall_ok, true AS degree_ok FROM embeddings""")
def h25(spark, sf):
    e = base(spark, sf)
    graph, start = neighbour_graph.build(e, id_col="vec_id")
    found = neighbour_graph.search(e, graph, start, e, 10, beam=48, query_id="vec_id", id_col="vec_id")
    exact = knn_join(e, e, 10, query_id="vec_id", base_id="vec_id")
    widest = graph.where(c("src") != start).agg(F.max(F.size("neighbours"))).first()[0]
    return e.agg(
        F.count("*").alias("queries"), F.lit(_recall(found, exact, 10) >= 0.9).alias("recall_ok"),
        F.lit(widest <= neighbour_graph.DEGREE).alias("degree_ok"),
    )


@query("h26_search_tuning", """
SELECT CAST(count(*) AS BIGINT) AS queries, true AS more_probes_never_worse, true AS oversample_never_worse FROM embeddings""")
def h26(spark, sf):
    e, centres = base(spark, sf), label_centres(spark, sf)
    index = cut(ivf.assign(e, centres))
    exact = cut(knn_join(e, e, 10, query_id="vec_id", base_id="vec_id"))
    recalls = [_recall(ivf.search(e, index, centres, 10, n, query_id="vec_id", base_id="vec_id"), exact, 10) for n in (1, 3, 10)]
    many = [
        _recall(ivf.search(e, index, centres, 10, 10, query_id="vec_id", base_id="vec_id", quantizer="binary", oversample=o), exact, 10)
        for o in (1, 4, 16)
    ]
    return e.agg(F.count("*").alias("queries"), F.lit(recalls == sorted(recalls)).alias("more_probes_never_worse"), F.lit(many == sorted(many)).alias("oversample_never_worse"))
