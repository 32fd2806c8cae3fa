"""Vector functions and searches: the hand fixture and brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphweft.functions import vectors as V
from graphweft.operators import ivf, knn as knn_module, neighbour_graph
from graphweft.operators.knn import knn, knn_join
from graphweft.operators.rescore import add_codes, int8_codes, pack_bits, rescore
from graphweft.sources import vectors as S

from conftest import rows

# The sample vectors and query of the fixture.
SAMPLE = [
    (1, [-0.200, 0.250, 0.341, -0.211, 0.645, 0.935, -0.316, -0.924]),
    (2, [0.443, -0.501, 0.355, -0.771, 0.707, -0.708, -0.185, 0.362]),
    (3, [0.716, -0.927, 0.134, 0.052, -0.669, 0.793, -0.634, -0.162]),
    (4, [-0.710, 0.330, 0.656, 0.041, -0.990, 0.726, 0.385, -0.958]),
]
QUERY = [0.890, 0.544, 0.825, 0.961, 0.358, 0.0196, 0.521, 0.175]
c = F.col


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(SAMPLE, "id long, embedding array<float>")


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(300, 16)).astype("float32")
    m[50:60] = m[50]  # exact copies: ties must go to the smaller id
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(m)], "id long, embedding array<float>, part int").repartition(5)
    return m.astype("float64"), df


def brute(m, q, k, metric="l2"):
    d = {"l2": lambda: np.sqrt(((m - q) ** 2).sum(1)), "l1": lambda: np.abs(m - q).sum(1),
         "cosine": lambda: 1 - (m @ q) / np.linalg.norm(m, axis=1) / np.linalg.norm(q)}[metric]()
    return [int(i) for i in np.lexsort((np.arange(len(m)), np.round(d, 12)))[:k]]


def test_distances(sample):
    q = F.array(*[F.lit(x) for x in QUERY]).cast("array<float>")
    got = sample.select("id", *[F.round(f(c("embedding"), q), 6) for f in (V.distance_l2, V.distance_l1, V.distance_cosine)])
    assert rows(got) == [(1, 2.389785, 6.1784, 1.01449), (2, 2.386874, 5.6636, 1.044498), (3, 2.568725, 6.5374, 1.09613), (4, 2.664404, 6.2264, 1.053262)]


def test_quantisers(sample):
    first = sample.where("id = 1").select(V.quantize_int8(c("embedding")).alias("q")).first().q
    assert first == [-26, 31, 42, -27, 81, 118, -40, -118] == int8_codes(np.array(SAMPLE[0][1])).tolist()
    bits = {r.id: format(r.w & 0xFF, "08b")[::-1] for r in sample.select("id", V.quantize_binary(c("embedding"))[0].alias("w")).collect()}
    assert bits == {1: "01101100", 2: "10101001", 3: "10110100", 4: "01110110"}
    inclusive = sample.select("id", V.quantize_binary_inclusive(F.transform("embedding", lambda x: x * 0)).alias("w")).first().w
    assert inclusive == [255] == pack_bits(np.zeros(8))


def test_quantised_words_beyond_64(spark):
    v = [1.0 if i in (0, 63, 64, 71) else -1.0 for i in range(72)]
    got = spark.createDataFrame([(v,)], "v array<float>").select(V.quantize_binary(c("v")).alias("w")).first().w
    assert got == pack_bits(np.array(v)) == [1 - 2**63, 1 + 2**7]


def test_errors(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0])], "a array<float>, b array<float>")
    for bad in (V.distance_l2(c("a"), c("b")), V.vec_add(c("a"), c("b")), V.quantize_binary(c("a")), V.vec_slice(c("a"), 1, 4)):
        with pytest.raises(Exception):
            df.select(bad).collect()
    with pytest.raises(ValueError):
        V.vec_slice(c("a"), 2, 2)
    assert df.select(V.vec_slice(c("a"), 1, 3).alias("s"), V.vec_each(c("b"))).first().s == [2.0, 3.0]


def test_json_and_blobs(spark):
    df = spark.createDataFrame([(1, "[1, 2.5, -3]"), (2, None)], "id int, t string")
    parsed = df.select("id", S.from_json_text(c("t"), 3).alias("v"))
    assert [r.v for r in parsed.orderBy("id").collect()] == [[1.0, 2.5, -3.0], None]
    with pytest.raises(Exception):
        df.select(S.from_json_text(c("t"), 4)).collect()
    packed = parsed.select("id", S.to_blob(c("v")).alias("b"))
    assert [r.v for r in packed.select(S.from_blob(c("b"), 3).alias("v"), "id").orderBy("id").collect()] == [[1.0, 2.5, -3.0], None]
    with pytest.raises(Exception):
        packed.select(S.from_blob(c("b"), 2)).collect()
    small = spark.createDataFrame([([1, -2, 127],)], "v array<tinyint>")
    assert small.select(S.from_blob(S.to_blob(c("v"), "int8"), 3, "int8").alias("v")).first().v == [1, -2, 127]


def test_fixture_search(sample):
    got = knn(sample, QUERY, 2).collect()
    assert [r.id for r in got] == [2, 1]
    assert [r.distance for r in got] == pytest.approx([2.38687372, 2.38978505], abs=1e-6)
    assert knn(sample, QUERY, 0).collect() == []
    with pytest.raises(ValueError):
        knn(sample, QUERY, 1, "l3")


@pytest.mark.parametrize("metric", ["l2", "l1", "cosine"])
def test_knn_against_brute_force(many, metric):
    m, df = many
    for q in (0, 50, 57):
        assert [r.id for r in knn(df, m[q], 15, metric).collect()] == brute(m, m[q], 15, metric)


def test_filters_come_first(many, spark):
    m, df = many
    keep = [i for i in range(300) if i % 3 == 1]
    got = [r.id for r in knn(df, m[7], 5, where=c("part") == 1).collect()]
    assert got == [keep[i] for i in brute(m[keep], m[7], 5)]
    ids = spark.createDataFrame([(3,), (9,), (11,), (9,)], "x long")
    assert sorted(r.id for r in knn(df, m[7], 5, ids=ids).collect()) == [3, 9, 11]
    near = knn(df, m[7], 300, bounds=(c("distance") > 0) & (c("distance") <= 4.0)).collect()
    d = np.sqrt(((m - m[7]) ** 2).sum(1))
    assert [r.id for r in near] == [int(i) for i in np.argsort(d, kind="stable") if 0 < d[i] <= 4.0]


@pytest.mark.parametrize("chunk", [None, 64])
@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_batches(many, metric, chunk):
    m, df = many
    got = knn_join(df, df, 4, metric, chunk_rows=chunk, skip_self=False)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.id)
    assert found == {i: brute(m, m[i], 4, metric) for i in range(300)}


def test_rescore_with_full_oversample_is_exact(many):
    m, df = many
    for kind in ("bit", "int8"):
        got = rescore(add_codes(df, kind), m[20].tolist(), 5, kind, oversample=128)
        assert [r.id for r in got.collect()] == brute(m, m[20], 5)


def test_ivf(many, spark):
    m, df = many
    centres = ivf.train(df, 8, seed=2)
    assert centres.shape == (8, 16)
    index = ivf.assign(df, centres)
    nearest = np.sqrt(((m[:, None] - centres[None]) ** 2).sum(2)).argmin(1)
    assert {r.id: r.cell for r in index.select("id", "cell").collect()} == dict(enumerate(nearest.tolist()))
    exact = rows(knn_join(df, df, 3), "query_id", "id")
    for chunk in (None, 90):
        assert rows(ivf.search(df, index, centres, 3, nprobe=8, chunk_rows=chunk), "query_id", "id") == exact
        few = rows(ivf.search(df, index, centres, 3, nprobe=2, chunk_rows=chunk), "query_id", "id")
        assert len(set(few) & set(exact)) >= 0.5 * len(exact)
    assert rows(ivf.search(df, ivf.clear(index), centres, 3, nprobe=1), "query_id", "id") == exact  # unassigned rows are always read
    assert rows(ivf.search(df, ivf.assign(df, None), centres, 3, 1), "query_id", "id") == exact
    for chunk in (None, 90):
        for kind, oversample in (("int8", 16), ("binary", 100)):  # 300 candidates are all rows
            found = ivf.search(df, index, centres, 3, 8, quantizer=kind, oversample=oversample, chunk_rows=chunk)
            assert rows(found, "query_id", "id") == exact


def test_neighbour_graph(many):
    m, df = many
    graph, start = neighbour_graph.build(df, degree=12, beam=24, hubs=8)
    assert graph.where(c("src") != start).agg(F.max(F.size("neighbours"))).first()[0] <= 12
    found = rows(neighbour_graph.search(df, graph, start, df, 5, beam=48), "query_id", "id")
    exact = rows(knn_join(df, df, 5), "query_id", "id")
    assert len(set(found) & set(exact)) >= 0.9 * len(exact)


def test_table_changes(spark, sample):
    more = spark.createDataFrame([(9, [0.0] * 8)], "id long, embedding array<float>")
    assert S.insert(sample, more).count() == 5
    with pytest.raises(Exception):
        S.insert(sample, sample.where("id = 1")).collect()
    with pytest.raises(ValueError):
        S.update(sample.withColumn("p", F.lit(1)), more.withColumn("p", F.lit(2)), partition_keys=("p",))
    assert S.update(sample, more.withColumn("id", F.lit(4).cast("long"))).where("id = 4").first().embedding == [0.0] * 8
    assert rows(S.delete(sample, spark.createDataFrame([(1,), (1,)], "id long")), "id") == [(2,), (3,), (4,)]


def test_rescore_has_no_bound(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(6000, 4)))], "id long, embedding array<double>")
    assert rescore(add_codes(df, "int8"), [0.0] * 4, 5000, "int8", oversample=1).count() == 5000


def test_cells_in_blocks(many, monkeypatch):
    m, df = many
    centres = m[::3] + 0.25
    whole = rows(ivf.assign(df, centres), "id", "cell")
    monkeypatch.setattr(ivf, "_CENTRES_AT_ONCE", 7)
    assert rows(ivf.assign(df, centres), "id", "cell") == whole
    wanted = np.argsort(np.sqrt(((m[:, None] - centres[None]) ** 2).sum(2)), axis=1, kind="stable")[:, :4]
    got = df.select("id", ivf.cell_of(c("embedding"), centres, "l2", 4).alias("n")).collect()
    assert {r.id: r.n for r in got} == dict(enumerate(wanted.tolist()))


def test_neighbour_graph_from_exact_candidates(many):
    m, df = many
    graph, start = neighbour_graph.build(df, degree=12, beam=24, hubs=8, candidates=knn_join(df, df, 24, skip_self=True))
    found = rows(neighbour_graph.search(df, graph, start, df, 5, beam=64), "query_id", "id")
    exact = rows(knn_join(df, df, 5), "query_id", "id")
    assert len(set(found) & set(exact)) >= 0.9 * len(exact)


def test_large_partitions_are_split(many, spark):
    from graphweft.session import new_folder

    m, df = many
    path = new_folder(spark, "split")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these parts are tiny
    try:
        S.write_table(df, path, ["part"], rows_per_file=20)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = S.read_table(spark, path)
    assert rows(back, "id") == [(i,) for i in range(300)]
    files = back.withColumn("f", F.input_file_name()).groupBy("part").agg(F.countDistinct("f").alias("n"))
    assert all(r.n > 1 for r in files.collect())


def test_long_vectors_close_together(spark):
    # squared distances far below the rounding of the fast product
    rng = np.random.default_rng(9)
    m = np.round(1e4 + rng.normal(size=(400, 8)) * 0.01, 6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, embedding array<double>").repartition(3)
    found = {}
    for r in knn_join(df, df, 5).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.id)
    assert found == {i: brute(m, m[i], 5) for i in range(400)}


def test_ivf_training_leaves_no_empty_cell(spark):
    draw = np.random.default_rng(3)
    spots = draw.normal(size=(12, 6)) * 50
    m = np.concatenate([spot + draw.normal(size=(n, 6)) for spot, n in zip(spots, [400, *[5] * 11], strict=True)])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)] + [(9999, None)], "id long, embedding array<double>").repartition(5, "id")
    for seed in range(3):
        centres = ivf.train(df, 12, seed=seed)
        nearest = np.square(m[:, None] - centres[None]).sum(2).argmin(1)
        assert centres.shape == (12, 6) and (np.bincount(nearest, minlength=12) > 0).all()
        assert np.array_equal(centres, ivf.train(df, 12, seed=seed))
    # a plain version of the rounds from the same start: bad on purpose, all in one spot
    start = np.repeat(m[:1], 12, axis=0)
    got, kept = start, ivf._spread_start
    ivf._spread_start = lambda sample, nlist, seed: start
    try:
        got = ivf.train(df, 12, iterations=20)
    finally:
        ivf._spread_start = kept
    want = start
    for _ in range(40):
        d = np.square(m[:, None] - want[None]).sum(2)
        cell = d.argmin(1)
        own = np.square(m - want[cell]).sum(1)
        sizes = np.bincount(cell, minlength=12)
        new = np.array([m[cell == c].mean(0) if sizes[c] else want[c] for c in range(12)])
        far = np.array([own[cell == c].max() if sizes[c] else -1.0 for c in range(12)])
        empty = np.flatnonzero(sizes == 0)
        donors = [c for c in np.argsort(-far, kind="stable") if far[c] > 0][: len(empty)]
        for e, c in zip(empty, donors, strict=False):
            new[e] = m[np.flatnonzero(cell == c)[own[cell == c].argmax()]]
        if not len(empty) and np.square(new - want).sum(1).max() <= ivf.TOLERANCE:
            break
        want = new
    assert got.shape == want.shape and np.allclose(got, want)


def test_ivf_training_of_few_vectors(spark):
    few = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(30)], "id long, embedding array<double>")
    assert sorted(map(tuple, ivf.train(few, 8))) == [(0.0, 1.0), (1.0, 1.0), (2.0, 1.0)]
    assert ivf.train(few.where("false"), 8).shape == (0, 0)


def test_blocks_share_a_scan(many, monkeypatch):
    m, df = many
    scans = []
    monkeypatch.setattr(knn_module, "query_chunks", lambda *a, real=knn_module.query_chunks: (scans.append(1) or x for x in real(*a)))
    got = rows(knn_join(df, df, 4, "cosine", chunk_rows=10, skip_self=True), "query_id", "id")
    assert len(scans) == 1  # 30 blocks, one scan
    monkeypatch.setattr(knn_module, "CHUNK_CELLS", 100 * (16 + 8))
    assert rows(knn_join(df, df, 4, "cosine", skip_self=True), "query_id", "id") == got
    assert len(scans) == 4  # what the chunk's numbers allow, lists included


@pytest.mark.parametrize("metric", ["l2", "cosine", "l1", "hamming"])
@pytest.mark.parametrize("offset", [0.0, 3000.0])
def test_best_lists_in_blocks(metric, offset):
    draw = np.random.default_rng(4)
    base = (draw.normal(size=(400, 16)) + offset).astype("float32") if metric != "hamming" else draw.integers(-(2**63), 2**63, size=(400, 2))
    base[100:200], base[300:330] = base[:100], base[5]  # equal vectors: ties go to the smaller id
    ids = draw.permutation(400)
    own = ids[:60]
    top = knn_module.TopK(metric, base[:60], 7, block=11)
    for at in range(0, 400, 90):
        top.add(ids[at : at + 90], base[at : at + 90], skip_self=own)
    for i in range(60):
        if metric in ("l2", "cosine"):
            d = knn_module._pair_distances(metric, np.repeat(base[i : i + 1], 400, axis=0), base)
        else:
            d = knn_module.distances(metric, base[i : i + 1], base)[0]
        other = ids != own[i]
        best = np.lexsort((ids[other], d[other]))[:7]
        assert top.ids[i].tolist() == ids[other][best].tolist() and top.dist[i].tolist() == d[other][best].tolist()


def test_lists_keep_undefined_distances_last():
    base = np.array([[0.0, 1.0], [np.nan, 0.0], [2.0, 0.0], [0.0, 4.0]])
    top = knn_module.TopK("l2", base[:1], 4)
    top.add(np.arange(4), base)
    assert top.lists()[0].tolist() == [0, 2, 3, 1]
