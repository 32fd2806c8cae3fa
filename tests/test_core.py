"""Global order and skew helpers against brute force."""

import random

from pyspark.sql import functions as F

from graphweft import skew
from graphweft.operators.clauses import explain
from graphweft.ordered import dense_number, running_sum, with_next
from graphweft.session import fits

from conftest import rows


def sample(spark, n=400, seed=3):
    rng = random.Random(seed)
    data = [(i, None if rng.random() < 0.1 else rng.choice("abc") if rng.random() < 0.5 else "hot", rng.randint(0, 50)) for i in range(n)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "id long, g string, v int").repartition(7)


def test_dense_number(spark):
    data, df = sample(spark)
    want = {r[0]: 10 + i for i, r in enumerate(sorted(data, key=lambda r: (r[2], -r[0])))}
    assert {r.id: r.n for r in dense_number(df, ["v", F.desc("id")], "n", start=10).collect()} == want


def test_dense_number_empty(spark):
    assert dense_number(spark.createDataFrame([], "id long"), ["id"], "n").collect() == []


def test_with_next(spark):
    data, df = sample(spark)
    order = sorted(data, key=lambda r: (r[2], r[0]))
    want = {a[0]: b[0] for a, b in zip(order, order[1:])} | {order[-1][0]: None}
    got = with_next(df, ["v", "id"], ["id"]).collect()
    assert {r.id: (r.next.id if r.next else None) for r in got} == want


def test_running_sum(spark):
    data, df = sample(spark)
    for inclusive in (True, False):
        want, sums = {}, {}
        for i, g, v in sorted(data, key=lambda r: (r[2], r[0])):
            before = sums.get(g, 0)
            sums[g] = before + v
            want[i] = sums[g] if inclusive else before
        got = running_sum(df, ["g"], ["v", "id"], F.col("v"), "s", inclusive)
        assert {r.id: r.s for r in got.collect()} == want


def test_fits(spark):
    assert fits(spark.range(10), 10) and not fits(spark.range(11), 10)


def test_fanout_splits_hot_sources(spark):
    edges = [(0, i) for i in range(1, 60)] + [(i, 0) for i in range(1, 20)] + [(1, 2), (1, 2)]
    df = spark.createDataFrame(edges, "src long, dst long")
    state = spark.createDataFrame([(i, i * 10) for i in range(60)], "id long, x long")
    plain, split, placed = skew.Fanout(df), skew.Fanout(df, chunk=5), skew.Fanout(df, chunk=5, resident=True)
    assert plain.hot is None and split.hot is not None
    assert split.edges.where("src = 0").select("_salt").distinct().count() > 5
    want = rows(plain.send(state), "id", "x", "dst")
    assert rows(split.send(state), "id", "x", "dst") == want == rows(placed.send(state), "id", "x", "dst")


def test_resident_edges_are_not_shuffled_again(spark):
    df = spark.createDataFrame([(i % 50, i) for i in range(500)], "src long, dst long")
    state = spark.createDataFrame([(i, i) for i in range(50)], "id long, x long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for chunk in (None, 3):  # without and with split sources
            moved = [explain(skew.Fanout(df, chunk, resident).send(state), "simple").count("Exchange hashpartitioning(") for resident in (False, True)]
            assert moved == [2, 1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_join_spread(spark):
    df = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 1), (3, 1)], "k long, v long")
    small = df.groupBy("k").agg(F.max("v").alias("m"), F.count("*").alias("n"))
    want = rows(df.join(small.drop("n"), "k"), "k", "v", "m")
    assert rows(skew.join_spread(df, small, "k", "n", 52, [F.col("v")], chunk=4), "k", "v", "m") == want


def test_ranges_of_with_next_grow_with_the_rows(spark, monkeypatch):
    """A range is sorted by one task: 3 000 rows of at most 250 need twelve of them, where four shuffle partitions gave four."""
    from graphweft import ordered

    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", 250)
    placed = []
    plain = ordered.sort_into_ranges
    monkeypatch.setattr(ordered, "sort_into_ranges", lambda *a, **b: placed.append(plain(*a, **b)) or placed[-1])
    rng = random.Random(5)
    data = [(i, rng.choice([None, *range(40)])) for i in range(3000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "id long, v int")
    ordered_ids = [r[0] for r in sorted(data, key=lambda r: (-1 if r[1] is None else r[1], r[0]))]
    got = ordered.with_next(df, ["v", "id"], ["id"])
    assert {r.id: r.next and r.next.id for r in got.collect()} == dict(zip(ordered_ids, [*ordered_ids[1:], None]))
    sizes = [r["count"] for r in placed[0].groupBy("_range").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 700
