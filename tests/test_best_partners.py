"""Best partners by neighbourhood: counting and searching against plain sets, hubs and ties among them."""

import random

import pytest

from graphweft.operators import similarity


def plain_best(sets, k, larger_only=False):
    out = set()
    for a, x in sets.items():
        scored = [(-len(x & y) / len(x | y), b) for b, y in sets.items() if (b > a if larger_only else b != a) and x & y]
        out |= {(a, b, i + 1) for i, (_, b) in enumerate(sorted(scored)[:k])}
    return out


def graphs():
    rnd = random.Random(5)
    yield {a: {rnd.randrange(100, 130) for _ in range(rnd.randrange(1, 9))} for a in range(60)}
    yield {a: {999} | {rnd.randrange(100, 400) for _ in range(rnd.randrange(0, 5))} for a in range(70)}  # everybody knows one hub
    yield {a: {999, 1000 + a} for a in range(50)} | {a: {999, 998, 997} for a in range(50, 80)} | {a: {999} for a in range(80, 90)}  # only ties
    yield {a: set(range(100, 101 + a)) for a in range(40)}  # nested sets


@pytest.mark.parametrize("look", [2, 5, 256])
@pytest.mark.parametrize("k", [1, 4])
def test_best_partners(spark, look, k):
    for sets in graphs():
        adj = spark.createDataFrame([(a, nb) for a, x in sets.items() for nb in x], "a long, nb long")
        got = similarity._best_partners(adj, adj, k, first_look=look)
        assert {(r.a, r.b, r["rank"]) for r in got.collect()} == plain_best(sets, k)


def test_best_pairs(spark, plain):
    sets = next(graphs())
    g = plain(range(200), [(a, nb) for a, x in sets.items() for nb in x])
    every = sorted((-len(x & y) / len(x | y), a, b) for a, x in sets.items() for b, y in sets.items() if a < b and x & y)
    got = [(-r.similarity, r.a, r.b) for r in similarity.node_similarity(g, top_k=25).collect()]
    assert got == every[:25]


def test_a_hub_is_not_paired(spark):
    """600 nodes with twins and one common hub: the search looks at a few of its 1 200 holders only."""
    sets = {a: {9999, 10000 + a // 2, 20000 + a // 2} for a in range(1200)}
    adj = spark.createDataFrame([(a, nb) for a, x in sets.items() for nb in x], "a long, nb long")
    seen = []
    count = similarity._count_shared

    def counting(pairs, full):
        seen.append(pairs.count())
        return count(pairs, full)

    similarity._count_shared = counting
    try:
        got = similarity._best_partners(adj, adj, 1, first_look=8)
        assert {(r.a, r.b) for r in got.collect()} == {(a, a ^ 1) for a in range(1200)}
    finally:
        similarity._count_shared = count
    assert len(seen) == 1 and sum(seen) <= 1200 * 8


def test_three_ways_agree(spark):
    """Counting, comparing blocks and searching give the same lists, over batches and blocks of any size."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "7")
    sizes = similarity.LEFT_BLOCK, similarity.RIGHT_BLOCK
    similarity.LEFT_BLOCK, similarity.RIGHT_BLOCK = 20, 30
    try:
        for sets in list(graphs())[:1]:
            adj = spark.createDataFrame([(a, nb) for a, x in sets.items() for nb in x], "a long, nb long")
            for larger, look, few in ((False, 1, 0), (True, 3, 256)):
                got = similarity._best_partners(adj, adj, 3, larger, look, few)
                assert {(r.a, r.b, r["rank"]) for r in got.collect()} == plain_best(sets, 3, larger)
    finally:
        similarity.LEFT_BLOCK, similarity.RIGHT_BLOCK = sizes
        spark.conf.unset(name)


def test_no_row_for_a_pair_moves(spark):
    """Lists of holders are moved, not a row for every pair that shares a neighbour, and hubs are compared without candidates."""
    adj = spark.createDataFrame([(a, 1000 + (a * j) % 40) for a in range(300) for j in range(1, 6)], "a long, nb long").distinct()
    for look in (256, 1):
        plan = similarity._best_partners(adj, adj, 2, first_look=look)._jdf.queryExecution().optimizedPlan().toString()
        assert ("MapInArrow" in plan) and ("FlatMapCoGroupsInArrow" in plan) == (look == 1)
        assert "AS shared" not in plan
