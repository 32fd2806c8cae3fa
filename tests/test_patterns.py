"""Pattern matching and clauses on hand-made graphs with hand-made answers."""

import pytest
from pyspark.sql import functions as F

from graphweft.functions import expressions as X
from graphweft.operators import clauses as K
from graphweft.operators.match import exists_pattern, pattern_list
from graphweft.operators.paths import expand, shortest_paths

from conftest import rows

c = F.col


@pytest.fixture(scope="module")
def fleet(make):
    ship = lambda name, tonnage, home=None: (name, "Ship", {"tonnage": tonnage, "home": home})
    good = lambda name, price: (name, "Good", {"price": price})
    return make(
        [ship("Orla", 120, "Cork"), ship("Petrel", 80, "Brest"), ship("Quill", 120, "Brest"), ship("Rook", 45), ship("Sable", 300), ship("Tern", 45, "Cork"),
         ("North pier", "Pier", {"berths": 4}), ("South pier", "Pier", {"berths": 9}), good("Rope", 3.5), good("Tar", 12.25), good("Salt", 0.75), good("Tin", 40.0)],
        node_schema="tonnage long, home string, berths long, price double",
    )


def names(df, col="n_name"):
    return sorted(r[0] for r in df.select(col).collect())


def test_node_scans(fleet):
    m = lambda *a, **k: fleet.match().node("n", *a, **k)
    assert len(names(m("Ship").df())) == 6
    assert names(m("ship").df()) == []
    assert names(m(tonnage=120).df()) == ["Orla", "Quill"]
    assert names(m(name="Tern", tonnage=45).df()) == ["Tern"]
    assert names(m(price=12.25).df()) == ["Tar"]
    assert names(m("Ship", home=None).df()) == ["Rook", "Sable"]


def test_where(fleet):
    w = lambda cond: names(fleet.match().node("n", "Ship").where(cond).df())
    assert w(c("n_tonnage") >= 120) == ["Orla", "Quill", "Sable"]
    assert w((c("n_tonnage") >= 120) & (c("n_home") == "Brest")) == ["Quill"]
    assert w((c("n_tonnage") < 50) | (c("n_home") == "Brest")) == ["Petrel", "Quill", "Rook", "Tern"]
    assert w(~(c("n_tonnage") == 45)) == ["Orla", "Petrel", "Quill", "Sable"]


@pytest.fixture(scope="module")
def labs(make):
    e = lambda a, t, b, **p: (a, t, b, p)
    person = lambda name, rank: (name, "Researcher", {"rank": rank})
    lab = lambda name, opened: (name, "Lab", {"opened": opened})
    return make(
        [person("Iva", 3), person("Jon", 1), person("Kei", 5), person("Lou", 2), person("Mae", 4), person("Nils", 1),
         lab("Optics", 1988), lab("Acoustics", 2015), lab("Soils", 2003), ("Laser", "Device", {}), ("Turin", "Town", {}), ("Ghent", "Town", {})],
        [e("Iva", "IN_LAB", "Optics", since="2019"), e("Jon", "IN_LAB", "Optics", since="2024"), e("Kei", "IN_LAB", "Acoustics", since="2016"),
         e("Lou", "IN_LAB", "Soils", since="2021"), e("Mae", "IN_LAB", "Soils", since="2010"), e("Kei", "TUTORS", "Iva"), e("Mae", "TUTORS", "Lou"),
         e("Mae", "TUTORS", "Jon"), e("Iva", "USES", "Laser"), e("Jon", "USES", "Laser"), e("Mae", "OWNS", "Laser"), e("Iva", "FROM", "Turin"),
         e("Lou", "FROM", "Ghent"), e("Kei", "FROM", "Turin"), e("Optics", "AT", "Turin"), e("Soils", "AT", "Ghent"), e("Nils", "VISITS", "Acoustics")],
        "rank long, opened long", "since string",
    )


def test_two_hops(labs):
    m = labs.match().node("p", "Researcher").out("IN_LAB").node("l", "Lab").out("AT").node("t").df()
    assert rows(m, "p_name", "l_name", "t_name") == [("Iva", "Optics", "Turin"), ("Jon", "Optics", "Turin"), ("Lou", "Soils", "Ghent"), ("Mae", "Soils", "Ghent")]


def test_grouping(labs):
    m = labs.match().node("m", "Researcher").out("TUTORS").node("e", "Researcher").df()
    assert rows(K.returning(m, "m_name", n=F.count("e_id"))) == [("Kei", 1), ("Mae", 2)]
    m = labs.match().node("p", "Researcher").out("IN_LAB").node("l", "Lab").df()
    assert rows(K.returning(m, "l_name", n=F.count("p_id"))) == [("Acoustics", 1), ("Optics", 2), ("Soils", 2)]
    assert rows(m.where((c("p_rank") > 2) & (c("l_opened") < 2005)), "p_name", "l_name") == [("Iva", "Optics"), ("Mae", "Soils")]


def test_shared_variables(labs):
    together = (
        labs.match().node("a", "Researcher").out("IN_LAB").node("l", "Lab").path().node("b", "Researcher").out("IN_LAB").node("l")
        .where(c("a_name") != c("b_name")).df()
    )
    assert rows(together, "a_name", "l_name", "b_name") == [("Iva", "Optics", "Jon"), ("Jon", "Optics", "Iva"), ("Lou", "Soils", "Mae"), ("Mae", "Soils", "Lou")]
    home = labs.match().node("p", "Researcher").out("FROM").node("t").path().node("p").out("IN_LAB").node("l").out("AT").node("t").df()
    assert rows(home, "p_name", "t_name", "l_name") == [("Iva", "Turin", "Optics"), ("Lou", "Ghent", "Soils")]


def test_directions_and_edge_filters(labs):
    both = labs.match().node("a").either("TUTORS").node("b").df()
    assert rows(both, "a_name", "b_name") == [("Iva", "Kei"), ("Jon", "Mae"), ("Kei", "Iva"), ("Lou", "Mae"), ("Mae", "Jon"), ("Mae", "Lou")]
    users = labs.match().node("o").out("OWNS").node("d").into("USES", var="w").node("u").df()
    assert rows(users, "o_name", "d_name", "u_name") == [("Mae", "Laser", "Iva"), ("Mae", "Laser", "Jon")]
    assert rows(users, "w_src", "w_dst") == [(1, 10), (2, 10)]  # stored direction, though matched backwards
    recent = labs.match().node("p").out("IN_LAB", var="r").node("l").where(c("r_since") >= "2019").df()
    assert names(recent, "p_name") == ["Iva", "Jon", "Lou"]
    assert names(labs.match().node("p").out("IN_LAB", since="2016").node().df(), "p_name") == ["Kei"]


def test_optional_keeps_rows(labs):
    works = labs.match().node("p").out("IN_LAB", var="w").node("l", "Lab")
    m = labs.match().node("p", "Researcher").optional(works, where=c("l_opened") > 2000).df()
    assert rows(m.select("p_name", F.coalesce("l_name", F.lit("-")))) == [
        ("Iva", "-"), ("Jon", "-"), ("Kei", "Acoustics"), ("Lou", "Soils"), ("Mae", "Soils"), ("Nils", "-")]


def test_exists_and_comprehension(labs):
    staff = labs.match().node("p", "Researcher").df()
    tutors = lambda: labs.match().node("p").out("TUTORS").node("x")
    assert names(exists_pattern(staff, tutors(), ["p"]), "p_name") == ["Kei", "Mae"]
    assert names(exists_pattern(staff, tutors(), ["p"], negate=True), "p_name") == ["Iva", "Jon", "Lou", "Nils"]
    lists = pattern_list(staff, labs.match().node("p").out(["IN_LAB", "VISITS"]).node("l"), "p", c("l_name"), "where_to")
    assert {r.p_name: r.where_to for r in lists.collect()} == {
        "Iva": ["Optics"], "Jon": ["Optics"], "Kei": ["Acoustics"], "Lou": ["Soils"], "Mae": ["Soils"], "Nils": ["Acoustics"]}


def test_edges_bind_once(plain):
    g = plain([1, 2], [(1, 2), (2, 1), (1, 1)])
    both = g.match().node("a").either("E").node("b").either("E").node("c").df()
    assert (1, 1, 1) not in rows(both, "a_id", "b_id", "c_id")  # the loop cannot be used twice
    free = g.match(unique_edges=False).node("a").either("E").node("b").either("E").node("c").df()
    assert (1, 1, 1) in rows(free, "a_id", "b_id", "c_id")


def test_loose_parts(fleet):
    m = fleet.match().node("a", "Good").path(on=c("a_price") > c("b_berths")).node("b", "Pier").df()
    assert rows(m, "a_name", "b_name") == [("Tar", "North pier"), ("Tar", "South pier"), ("Tin", "North pier"), ("Tin", "South pier")]
    empty = fleet.match().node("a", "Good").path(on=c("a_id") != c("b_id")).node("b", "Nobody").df()
    assert empty.count() == 0 and "b_name" in empty.columns
    with pytest.raises(ValueError):
        fleet.match().node("a", "Good").path().node("b", "Pier").df()


def test_open_ended_paths_have_no_bound(plain):
    g = plain(range(13), [(i, i + 1) for i in range(12)])
    assert expand(g.edges, g.nodes.where("id = 0").select("id"), 1, None).agg(F.max("depth")).first()[0] == 12
    far = shortest_paths(g.edges, g.nodes.where("id = 0").select("id"))
    assert (far.count(), far.agg(F.max("depth")).first()[0]) == (12, 12)


@pytest.fixture(scope="module")
def tree(make):
    n = lambda *xs: [(x, "Node" if len(x) == 1 else "Tree", {}) for x in xs]
    return make(
        n("A", "B", "C", "D", "E", "Root", "Child1", "Child2", "Grandchild"),
        [("A", "NEXT", "B", {}), ("B", "NEXT", "C", {}), ("C", "NEXT", "D", {}), ("D", "NEXT", "E", {}),
         ("Root", "PARENT_OF", "Child1", {}), ("Root", "PARENT_OF", "Child2", {}), ("Child1", "PARENT_OF", "Grandchild", {})],
    )


@pytest.mark.parametrize("length,want", [
    (1, "B"), (2, "C"), (3, "D"), (4, "E"), (10, ""), ((1, 2), "BC"), ((1, 3), "BCD"), ((2, 4), "CDE"), ((0, 1), "AB"), ((1, None), "BCDE"), ((6, None), ""),
])
def test_variable_length(tree, length, want):
    m = tree.match().node("a", name="A").out("NEXT", length=length, path="p").node("b").df()
    assert "".join(names(m, "b_name")) == want


def test_variable_length_forms(tree):
    m = lambda q: names(q.node("b").df(), "b_name")
    assert m(tree.match().node("a", name="Root").out("PARENT_OF", length=(1, None))) == ["Child1", "Child2", "Grandchild"]
    assert m(tree.match().node("a", name="E").into("NEXT", length=(1, 2))) == ["C", "D"]
    assert m(tree.match().node("a", name="C").either("NEXT", length=1)) == ["B", "D"]
    lengths = tree.match().node("a", name="A").out("NEXT", length=(1, 3), path="p").node("b").df()
    assert rows(lengths, "b_name", "p_length") == [("B", 1), ("C", 2), ("D", 3)]


def test_paths_do_not_repeat_nodes(plain):
    g = plain([1, 2, 3], [(1, 2), (2, 3), (3, 1), (1, 1)])
    p = expand(g.edges, g.nodes.select("id").where("id = 1"), 0, 100)
    assert sorted(tuple(r.node_ids) for r in p.collect()) == [(1,), (1, 2), (1, 2, 3)]


def test_shortest(plain):
    g = plain(range(1, 6), [(1, 2), (1, 3), (2, 4), (3, 4), (4, 5), (1, 2)])
    one = shortest_paths(g.edges, g.nodes.select("id").where("id = 1"))
    assert {r.end: (r.depth, r.node_ids, r.edge_ids) for r in one.collect()} == {
        2: (1, [1, 2], [1]), 3: (1, [1, 3], [2]), 4: (2, [1, 2, 4], [1, 3]), 5: (3, [1, 2, 4, 5], [1, 3, 5])}
    every = shortest_paths(g.edges, g.nodes.select("id").where("id = 1"), all_ties=True)
    assert every.where("end = 4").count() == 3 and every.where("end = 2").count() == 2


def test_clauses(spark):
    df = spark.createDataFrame([("Alice", 30), ("Bob", 25), ("Charlie", 35), ("Alice", 28), ("David", 40), ("Nil", None)], "name string, age int")
    assert [r.name for r in K.page(K.order_by(df, ("age", "desc")), limit=1).collect()] == ["David"]
    assert [r.name for r in K.order_by(df, "age").collect()][0] == "Nil"  # NULL is the smallest
    assert [r.name for r in K.page(K.order_by(df, "name"), 1, 2).collect()] == ["Alice", "Bob"]
    assert K.returning(df, "name", distinct=True).count() == 5
    assert K.union_rows(df, df).count() == 6 and K.union_rows(df, df, keep_all=True).count() == 12
    lists = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, xs array<int>")
    assert rows(K.unwind(lists, c("xs"), "x"), "id", "x") == [(1, 1), (1, 2)]


def test_expressions(spark):
    one = lambda col: spark.range(1).select(col.alias("x")).first().x
    xs = F.array(*[F.lit(i) for i in (1, 2, 3, 4)])
    assert one(X.list_item(xs, 0)) == 1 and one(X.list_item(xs, -1)) == 4 and one(X.list_item(xs, 9)) is None
    assert one(X.list_slice(xs, 1, 3)) == [2, 3] and one(X.list_slice(xs, -2)) == [3, 4] and one(X.list_slice(xs, 3, 1)) == []
    assert one(X.comprehension(xs, lambda x: x > 2, lambda x: x * 10)) == [30, 40]
    assert one(X.reduce_list(xs, F.lit(0), lambda a, x: a + x)) == 10
    assert one(X.single_of(xs, lambda x: x == 3)) is True and one(X.none_of(xs, lambda x: x > 9)) is True
    assert one(X.int_divide(F.lit(-7), F.lit(2))) == -3 and one(X.modulo(F.lit(-7), F.lit(2))) == -1 and one(X.int_divide(F.lit(1), F.lit(0))) is None
    assert one(X.xor(F.lit(True), F.lit(None).cast("boolean"))) is None
    assert one(X.nested(F.lit('{"a":{"b":5}}'), "a", "b")) == "5"
