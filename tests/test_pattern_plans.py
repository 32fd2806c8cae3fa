"""Cyclic patterns joined by size, and hops that only ask what is reachable."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from graphweft.graph import Graph
from graphweft.operators.joinorder import Part, estimate, sizes
from graphweft.operators.match import exists_pattern
from graphweft.operators.paths import expand, reachable

from conftest import rows


@pytest.fixture(scope="module")
def web(spark):
    """Typed random edges among coloured nodes, with loops and parallel edges."""
    rng = random.Random(11)
    nodes = [(i, ["Red"] if i % 3 else ["Blue", "Red"], i % 2) for i in range(9)]
    edges = [(i, rng.randrange(9), rng.randrange(9), rng.choice("XY")) for i in range(40)]
    g = Graph(spark.createDataFrame(nodes, "id long, labels array<string>, odd int"), spark.createDataFrame(edges, "id long, src long, dst long, type string"))
    return g, nodes, edges


def test_triangle_against_brute_force(web):
    g, nodes, edges = web
    m = g.match().node("a", "Blue").out("X", var="e").node("b").into("Y", var="f").node("c", odd=1).path().node("c").either(var="h").node("a").df()
    want = []
    for e, f, h in itertools.product(edges, edges, edges):
        a, b, c = e[1], e[2], f[1]
        ends = {(h[1], h[2]), (h[2], h[1])}
        if e[3] == "X" and f[3] == "Y" and f[2] == b and a % 3 == 0 and c % 2 == 1 and (c, a) in ends and h[0] not in (e[0], f[0]):
            want.append((a, b, c, e[0], f[0], h[0]))
    assert rows(m, "a_id", "b_id", "c_id", "e_id", "f_id", "h_id") == sorted(want) and want
    assert {(r.f_src, r.f_dst) for r in m.collect()} == {(r.c_id, r.b_id) for r in m.collect()}
    assert {"a_labels", "c_odd", "e_type"} <= set(m.columns) and not [x for x in m.columns if x.startswith("_")]


def test_loop_and_two_way_pair(web):
    g, nodes, edges = web
    m = g.match().node("a").out().node("a").path().node("a").out(var="e").node("b").out(var="f").node("a").df()
    want = [(e[1], e[2], e[0], f[0]) for x, e, f in itertools.product(edges, edges, edges)
            if x[1] == x[2] == e[1] == f[2] and e[2] == f[1] and len({x[0], e[0], f[0]}) == 3]
    assert rows(m, "a_id", "b_id", "e_id", "f_id") == sorted(want) and want


def test_selection_reduces_the_other_hops(make):
    people = [(f"p{i}", "P", {"town": "here" if i == 0 else "there"}) for i in range(40)]
    things = [(f"t{i}", "T", {}) for i in range(20)]
    links = [(f"p{i}", kind, f"t{(i + shift) % 20}", {}) for i in range(40) for kind, shift in (("OWNS", 0), ("LENDS", 0), ("LENDS", 3))]
    g = make(people + things, links, node_schema="town string")
    m = g.match().node("p", "P", town="here").out("OWNS").node("t", "T").into("LENDS").node("p").df()
    assert rows(m, "p_name", "t_name") == [("p0", "t0")]
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_cycle_closes_on_both_variables(plain):
    g = plain(range(6), [(i, j) for i in range(6) for j in range(6) if i != j])
    m = g.match().node("a").out("E").node("b").out("E").node("c").out("E").node("d").out("E").node("a").df()
    joins = [line for line in m._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert any(line.count(" = ") == 2 for line in joins)
    walks = [w for w in itertools.product(range(6), repeat=4) if all(x != y for x, y in zip(w, w[1:] + w[:1]))]
    assert m.count() == sum(w[:2] != w[2:] for w in walks)  # a-b-a-b would bind the edge from a to b twice


def test_sizes_and_estimates(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "a_id long, b_id long")
    assert sizes([(df, ["a_id", "b_id"]), (df.where("a_id = 9"), ["a_id"]), (df, [])]) == [(3, [2, 2]), (0, [0]), (3, [])]
    x, y = Part(df, 100.0, {"a": 10.0, "b": 50.0}, []), Part(df, 30.0, {"b": 5.0, "c": 30.0}, [])
    assert estimate(x, y) == 60.0 and estimate(x, Part(df, 1.0, {"z": 1.0}, [])) == float("inf")
    x.limit("a", 1.0)
    assert x.rows == 10.0 and x.ids == {"a": 1.0, "b": 10.0}


@pytest.mark.parametrize("low,high", [(0, None), (1, None), (1, 2), (0, 3), (1, 6), (0, 0)])
def test_reachable_equals_ends_of_paths(plain, low, high):
    rng = random.Random(low * 10 + (high or 9))
    g = plain(range(9), [(rng.randrange(9), rng.randrange(9)) for _ in range(13)] + [(0, 0), (0, 1), (0, 1)])
    starts = g.nodes.where("id < 5").select("id")
    assert rows(reachable(g.edges, starts, low, high)) == rows(expand(g.edges, starts, low, high).select("start", "end").distinct())


def test_unbounded_on_a_dense_cycle_ends(plain):
    # 14 nodes, all joined to all: some 10^10 simple paths from each, 13 reachable ends
    g = plain(range(14), [(i, j) for i in range(14) for j in range(14) if i != j])
    m = g.match().node("a", "N").out("E", length=(1, None)).node("b", "N")
    assert rows(m.distinct("a_id", "b_id").groupBy("a_id").agg(F.count("*"))) == [(i, 13) for i in range(14)]
    people = g.match().node("a", "N").df()
    assert exists_pattern(people, g.match().node("a").out("E", length=(0, None)).node("b", "N"), ["a"]).count() == 14
    assert exists_pattern(people, g.match().node("a").out("E", length=(1, None)).node("b", "Nobody"), ["a"], negate=True).count() == 14


def test_named_ways_and_long_ones_are_still_listed(plain):
    g = plain(range(4), [(0, 1), (1, 2), (0, 2), (2, 3)])
    start = lambda: g.match().node("a", "N")
    assert rows(start().out("E", length=(1, None), path="p").node("b").distinct("a_id", "p_length").where("a_id = 0")) == [(0, 1), (0, 2), (0, 3)]
    assert rows(start().out("E", length=(2, None)).node("b").distinct("a_id", "b_id").where("a_id = 0")) == [(0, 2), (0, 3)]
    assert start().out("E", length=(1, None)).node("b").df().where("a_id = 0").count() == 5  # a row per way
    with pytest.raises(ValueError):
        reachable(g.edges, g.nodes.select("id"), 2)
