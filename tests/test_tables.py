"""Diff and patch, sequences, sources, updates, streams and functions on small tables."""

import pytest
from pyspark.sql import Row, functions as F

from graphweft.functions import aggregates as A
from graphweft.functions import json as J
from graphweft.functions import maths as M
from graphweft.functions import spatial as P
from graphweft.functions import strings as S
from graphweft.functions import temporal as T
from graphweft.operators import mutate as D
from graphweft.operators import sequence, sync
from graphweft.session import new_folder
from graphweft.sources import tables
from graphweft.streaming.feeds import EdgeMerger, FeedTable, run_available

from conftest import rows

c = F.col


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


# -- diff and patch --------------------------------------------------------------------------
@pytest.fixture(scope="module")
def stations(spark):
    schema = "code long, place string, line string, depth double"
    a = spark.createDataFrame([(40, "Århus", "L2", 12.5), (41, "Łódź", "L7", None), (52, "Évora", "L2", 3.0), (77, "Sète", "L9", 8.25), (90, "Zürich", "L1", 1.0)], schema)
    b = spark.createDataFrame([(40, "Århus", "L2", 12.5), (41, "Łódź", "L8", 6.0), (77, "Sète", "L9", 8.25), (83, "Kraków", "L3", 0.5), (90, "Zürich", "L1", None), (95, "Åre", None, 4.0)], schema)
    return a, b


def test_diff(stations):
    a, b = stations
    d = {r.code: r for r in sync.diff(a, b, ["code"]).collect()}
    assert {k: r.op for k, r in d.items()} == {41: "UPDATE", 52: "DELETE", 83: "INSERT", 90: "UPDATE", 95: "INSERT"}
    assert sorted(d[41].changed) == ["depth", "line"] and (d[41].old.depth, d[41].new.line) == (None, "L8")
    assert d[90].changed == ["depth"] and d[90].new.depth is None
    assert (d[83].old, d[95].new.place, d[52].old.place, d[52].new) == (None, "Åre", "Évora", None)
    assert set(map(tuple, sync.apply_all(a, sync.diff(a, b, ["code"]), ["code"]).collect())) == set(map(tuple, b.collect()))
    assert sync.diff(b, b, ["code"]).count() == 0


def test_patch_refuses_what_does_not_fit(stations, spark):
    a, b = stations
    changes = sync.diff(a, b, ["code"])
    moved = a.where("code <> 52").withColumn("depth", F.when(c("code") == 90, 2.0).otherwise(c("depth")))
    result = sync.patch(moved, changes, ["code"])
    assert sorted((r.op, r.code) for r in result.conflicts.collect()) == [("DELETE", 52), ("UPDATE", 90)]
    assert {r.code: r.depth for r in result.table.collect()} == {40: 12.5, 41: 6.0, 77: 8.25, 83: 0.5, 90: 2.0, 95: 4.0}
    with pytest.raises(ValueError):
        sync.apply_all(moved, changes, ["code"])
    assert sorted((r.op, r.code) for r in sync.patch(b, changes, ["code"]).conflicts.collect()) == [("DELETE", 52), ("INSERT", 83), ("INSERT", 95), ("UPDATE", 41), ("UPDATE", 90)]


def test_diff_nulls_and_keys(spark):
    a = spark.createDataFrame([(1, 1, None), (1, 2, 5), (2, 1, 7)], "x int, y int, v int")
    b = spark.createDataFrame([(1, 1, 4), (1, 2, None), (2, 1, 7)], "x int, y int, v int")
    d = sync.diff(a, b, ["x", "y"])
    assert rows(d, "op", "x", "y") == [("UPDATE", 1, 1), ("UPDATE", 1, 2)]
    assert set(map(tuple, sync.apply_all(a, d, ["x", "y"]).collect())) == set(map(tuple, b.collect()))
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    other = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(sync.apply_all(keys, sync.diff(keys, other, ["k"]), ["k"])) == [(2,), (3,)]
    with pytest.raises(ValueError):
        sync.diff(a, b.drop("v"), ["x", "y"])
    with pytest.raises(ValueError, match="nokey"):
        sync.diff_tables({"nokey": a}, {"nokey": b}, {})


# -- sequences -------------------------------------------------------------------------------
def test_sequence(spark):
    marks = sequence.new_marks(spark, {"seq": 0})
    got, marks = sequence.nextval(spark.createDataFrame([("b",), ("a",)], "name string"), marks, "seq", ["name"])
    assert rows(got, "id", "name") == [(1, "a"), (2, "b")]
    assert sequence.curval(marks, "seq") == 2
    third, marks = sequence.nextval(spark.createDataFrame([("c",)], "name string"), marks, "seq", ["name"])
    assert third.first().id == 3 == sequence.curval(marks, "seq")
    nothing, marks = sequence.nextval(spark.createDataFrame([], "name string"), marks, "seq", ["name"])
    assert nothing.count() == 0 and sequence.curval(marks, "seq") == 3 and sequence.curval(marks, "none") is None


# -- updates ---------------------------------------------------------------------------------
@pytest.fixture()
def pair(make):
    return make([("Alice", "Person", {}), ("Bob", "Person", {})])


def test_match_create_delete(pair):
    a = pair.match().node("a", name="Alice").path(on=c("a_id") != c("b_id")).node("b", name="Bob").df()
    g = D.create_edges(pair, a, "a_id", "b_id", "KNOWS", ["a_id"])
    assert (g.nodes.count(), g.edges.count()) == (2, 1)
    none = pair.match().node("a", name="Nobody").df()
    assert D.create_edges(pair, none, "a_id", "a_id", "KNOWS", ["a_id"]).edges.count() == 0
    assert (D.delete_edges(g, g.edges.select("id")).edges.count(), g.nodes.count()) == (0, 2)
    alice = g.nodes.where("name = 'Alice'").select("id")
    with pytest.raises(ValueError):
        D.delete_nodes(g, alice)
    left = D.delete_nodes(g, alice, detach=True)
    assert (left.nodes.count(), left.edges.count()) == (1, 0)
    assert D.mutation_stats(g, left).first().asDict() == {
        "nodes_created": 0, "nodes_deleted": 1, "edges_created": 0, "edges_deleted": 1, "properties_set": 0}


def test_merge(pair, spark):
    new = spark.createDataFrame([("Alice", 1), ("Carol", 3), ("Carol", 2)], "name string, age int")
    g = D.merge_nodes(pair, new, "Person", ["name"], on_create={"age": c("age")}, on_match={"seen": F.lit(True)})
    assert rows(g.nodes.na.fill({"age": -1, "seen": False}), "name", "age", "seen") == [("Alice", -1, True), ("Bob", -1, False), ("Carol", 2, False)]
    again = D.merge_nodes(g, new, "Person", ["name"])
    assert again.nodes.count() == 3
    ends = spark.createDataFrame([(1, 2), (1, 2), (2, 1)], "src long, dst long")
    once = D.merge_edges(pair, ends, "KNOWS")
    assert rows(D.merge_edges(once, ends, "KNOWS").edges, "src", "dst") == [(1, 2), (2, 1)]


def test_set_and_remove(pair):
    alice = pair.nodes.where("name = 'Alice'")
    g = D.set_props(pair, alice, age=F.lit(30), name=F.upper("name"))
    assert {r.id: (r.name, r.age) for r in g.nodes.collect()} == {1: ("ALICE", 30), 2: ("Bob", None)}
    assert D.set_map(g, alice, {"name": F.lit("X")}, replace=True).nodes.where("id = 1").first().age is None
    assert D.set_map(g, alice, {"name": F.lit("X")}, replace=False).nodes.where("id = 1").first().age == 30
    labelled = D.add_label(D.add_label(pair, alice, "Admin"), alice, "Admin")
    assert labelled.nodes.where("id = 1").first().labels == ["Person", "Admin"]
    assert D.remove_label(labelled, alice, "Person").nodes.where("id = 1").first().labels == ["Admin"]
    assert D.remove_props(g, alice, "age").nodes.where("age is not null").count() == 0


# -- sources ---------------------------------------------------------------------------------
def test_eav_and_json(make, spark):
    g = make([("A", ["X", "Y"], {"n": 1, "ok": True}), ("B", "X", {"n": None, "ok": False})], [("A", "E", "B", {"w": 1.5})], "n long, ok boolean", "w double")
    eav = tables.to_eav(g.nodes)
    assert rows(eav.where("key = 'n'"), "entity", "int") == [(1, 1)]
    back = tables.from_eav(eav, {"name": "string", "n": "bigint", "ok": "boolean"})
    assert set(map(str, back.select("entity", "name", "n", "ok").collect())) == set(map(str, g.nodes.select(c("id").alias("entity"), "name", "n", "ok").collect()))
    assert tables.nodes_to_json(g).where("id = 2").first().json == '{"id":2,"labels":["X"],"properties":{"name":"B","ok":false}}'
    assert tables.edges_to_json(g).first().json == '{"id":1,"type":"E","start":1,"end":2,"properties":{"w":1.5}}'
    assert tables.rows_to_json(spark.createDataFrame([(1, "x")], "a int, b string")).first().json == '{"a":1,"b":"x"}'
    assert g.stats().first().node_count == 2


# -- streams ---------------------------------------------------------------------------------
def test_feed_is_idempotent_and_ordered(spark):
    start = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    feed = FeedTable(spark, new_folder(spark, "t"), ["k"], start)
    schema = "op string, seq long, k int, v string"
    first = spark.createDataFrame([("UPDATE", 5, 1, "new"), ("DELETE", 6, 2, None), ("INSERT", 1, 3, "c")], schema)
    late = spark.createDataFrame([("UPDATE", 2, 1, "old"), ("UPDATE", 3, 2, "late"), ("UPDATE", 4, 3, "d")], schema)
    feed.apply(first, 0)
    feed.apply(first, 0)  # a repeated batch
    feed.apply(late, 1)
    want = [(1, "new"), (3, "d")]
    assert rows(feed.table()) == want
    feed.compact()
    assert rows(feed.table()) == want
    feed.apply(spark.createDataFrame([("UPDATE", 9, 1, "newest")], schema), 2)
    again = FeedTable(spark, feed.folder, ["k"], start)  # a restart finds base and changes
    again.apply(spark.createDataFrame([("INSERT", 10, 4, "e")], schema), 3)
    assert rows(again.table()) == [(1, "newest"), (3, "d"), (4, "e")]


def test_edge_merge_stream(spark):
    path = new_folder(spark, "feed")
    spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "src long, dst long").coalesce(1).write.parquet(path)
    spark.createDataFrame([(1, 3), (3, 2)], "src long, dst long").coalesce(1).write.mode("append").parquet(path)
    merger = EdgeMerger(spark, new_folder(spark, "edges"))
    stream = spark.readStream.schema("src long, dst long").option("maxFilesPerTrigger", 1).parquet(path)
    run_available(stream, merger.apply, new_folder(spark, "progress"))
    assert rows(merger.edges()) == [(1, 2), (1, 3), (3, 2)]
    assert rows(merger.degrees()) == [(1, 2), (2, 2), (3, 2)]


# -- functions -------------------------------------------------------------------------------
@pytest.mark.parametrize("expr,want", [
    (lambda: S.padc(F.lit("ab"), 5), " ab  "), (lambda: S.padl(F.lit("abcdef"), 3), "abcdef"), (lambda: S.padr(F.lit("a"), 3), "a  "),
    (lambda: S.charindex("b", F.lit("abcb"), 3), 4), (lambda: S.charindex("", F.lit("abc")), 0), (lambda: S.charindex("z", F.lit("abc")), 0),
    (lambda: S.strfilter(F.lit("a-b]c^d"), "^]-"), "-]^"), (lambda: S.strfilter(F.lit("abc"), ""), ""),
    (lambda: S.simple_soundex(F.lit("Robert")), "R616"), (lambda: S.simple_soundex(F.lit("12")), "?000"),
    (lambda: S.difference(F.lit("Robert"), F.lit("Rupert")), 4), (lambda: S.split(F.lit("a..b."), "."), ["a", "b"]),
    (lambda: S.substring(F.lit("hello"), 1, 3), "ell"), (lambda: S.reverse(F.lit("aé")), "éa"), (lambda: S.proper(F.lit("hello wORLD")), "Hello World"),
    (lambda: S.is_empty_list(F.array()), True), (lambda: S.is_empty_text(F.lit("a")), False),
    (lambda: M.to_integer(F.lit("abc")), None), (lambda: M.to_integer(F.lit(" 42 ")), 42), (lambda: M.to_integer(F.lit("-3.9")), -3),
    (lambda: M.to_integer(F.lit("9223372036854775807")), 2**63 - 1), (lambda: M.to_float(F.lit("1f")), None), (lambda: M.to_float(F.lit("1e3")), 1000.0),
    (lambda: M.to_boolean(F.lit("TRUE")), True), (lambda: M.to_boolean(F.lit("yes")), None),
    (lambda: M.value_type(F.lit(1.5)), "FLOAT"), (lambda: M.value_type(F.lit(None)), "NULL"), (lambda: M.value_type(F.array()), "ANY"),
    (lambda: M.int_range(F.lit(1), F.lit(10), 4), [1, 5, 9]), (lambda: M.int_range(F.lit(3), F.lit(1)), []), (lambda: M.int_range(F.lit(3), F.lit(1), -1), [3, 2, 1]),
    (lambda: M.head(F.array().cast("array<int>")), None), (lambda: M.tail(F.array(F.lit(1))), []), (lambda: M.tail(F.array(F.lit(1), F.lit(2))), [2]),
    (lambda: T.truncate("month", F.lit("2024-03-15 10:00:00").cast("timestamp")).cast("string"), "2024-03-01"),
    (lambda: T.date(year=2024).cast("string"), "2024-01-01"), (lambda: T.time(hour=7), "07:00:00"),
    (lambda: T.in_days(F.lit("2024-01-03"), F.lit("2024-01-01 12:00:00")), -1),
    (lambda: T.between(F.lit("2024-01-01"), F.lit("2024-01-03 00:00:05")), Row(years=0, months=0, days=2, hours=0, minutes=0, seconds=5)),
    (lambda: T.in_months(F.lit("2024-01-01"), F.lit("2024-03-01")), 1),
    (lambda: F.round(P.distance(P.point(x=0, y=0), P.point(x=3, y=4)), 6), 5.0),
    (lambda: F.round(P.distance(P.point(latitude=0, longitude=0), P.point(latitude=0, longitude=180))), 20015087.0),
    (lambda: J.json_type(F.lit('{"a":[1]}'), "$.a"), "array"), (lambda: J.json_type(F.lit("1.5")), "real"), (lambda: J.json_type(F.lit("true")), "true"),
    (lambda: J.json_get(F.lit('{"a":{"b":2}}'), "$.a.b"), "2"),
])
def test_scalar(spark, expr, want):
    assert one(spark, expr()) == want


def test_replicate_rejects_negative(spark):
    assert one(spark, S.replicate(F.lit("ab"), F.lit(2))) == "abab"
    with pytest.raises(Exception):
        one(spark, S.replicate(F.lit("ab"), F.lit(-1)))


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 4.0), ("n", None)], "g string, x double")
    assert {r.g: r.mode for r in A.mode(df, ["g"], "x").collect()} == {"a": 1.0, "b": None}
    q = A.quantiles(df, ["g"], "x", m=("cont", 0.5), d=("disc", 0.5), lo=("step", 0.25), hi=("step", 0.75))
    assert {r.g: (r.m, r.d, r.lo, r.hi) for r in q.collect()} == {"a": (1.0, 1.0, 1.0, 2.0), "b": (3.5, 3.0, 3.0, 4.0)}
    even = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4)], "x double")
    assert A.quantiles(even, [], "x", lo=("step", 0.25), hi=("step", 0.75)).first() == (1.5, 3.5)
    stats = {r.g: (r.s, r.p) for r in df.groupBy("g").agg(A.stdev(c("x")).alias("s"), A.stdevp(c("x")).alias("p")).collect()}
    assert stats["n"] == (0.0, 0.0) and stats["b"][1] == 0.5
    assert df.where("g = 'n'").agg(A.collect(c("x")).alias("l")).first().l == []
