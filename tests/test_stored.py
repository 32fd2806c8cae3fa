"""Stored marks, tables that change together, statistics of edges: conflicts, other writers, restarts."""

import threading

import pytest
from pyspark.sql import functions as F

from graphweft.graph import Graph
from graphweft.operators import mutate, sync
from graphweft.operators.sequence import StoredMarks
from graphweft.versions import Versions


def test_a_version_is_published_once(spark, tmp_path):
    first, second = (Versions(spark, f"{tmp_path}/v") for _ in range(2))
    assert first.latest() == (0, None)
    assert first.publish(1, "a") and not second.publish(1, "b")
    assert second.latest() == (1, "a") and second.publish(2, "") and first.latest() == (2, "")
    (tmp_path / "v" / "draft-dead").write_text("left by a writer that died")
    assert first.latest() == (2, "") and first.change(lambda t: t + "x") == (3, "x")


def test_writers_never_share_a_number(spark, tmp_path):
    taken, lock = [], threading.Lock()

    def take():
        marks = StoredMarks(spark, f"{tmp_path}/m")
        for n in (1, 3, 0, 2):
            first = marks.take("ids", n)
            with lock:
                taken.extend(range(first, first + n))

    threads = [threading.Thread(target=take) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(taken) == list(range(1, 25))
    marks = StoredMarks(spark, f"{tmp_path}/m")
    assert marks.curval("ids") == 24 and marks.curval("other") is None
    marks.at_least("ids", 10)
    marks.at_least("other", 5)
    assert marks.curval("ids") == 24 and marks.take("other", 1) == 6
    with pytest.raises(ValueError):
        marks.take("ids", -1)


def test_numbers_for_rows_and_graphs(spark, make, tmp_path):
    marks = StoredMarks(spark, f"{tmp_path}/m")
    rows = spark.createDataFrame([("b",), ("a",)], "name string")
    assert {r.name: r.id for r in marks.nextval(rows, "s", ["name"]).collect()} == {"a": 1, "b": 2}
    assert marks.nextval(rows.where("false"), "s", ["name"]).count() == 0 and marks.curval("s") == 2
    g = make([("x", "Ship", {}), ("y", "Ship", {})], [("x", "TOWS", "y", {})])
    marks.at_least("nodes", 2)
    marks.at_least("edges", 1)
    one = mutate.create_nodes(g, rows, "Pier", ["name"], marks, name=F.col("name"))
    two = mutate.create_nodes(g, rows, "Pier", ["name"], marks, name=F.col("name"))  # a second writer from the same state
    ids = [r.id for r in one.nodes.where("id > 2").collect()] + [r.id for r in two.nodes.where("id > 2").collect()]
    assert sorted(ids) == [3, 4, 5, 6]
    linked = mutate.create_edges(one, spark.createDataFrame([(1, 3), (2, 4)], "s long, d long"), "s", "d", "AT", ["s"], marks)
    assert sorted(tuple(r) for r in linked.edges.where("type = 'AT'").select("id", "src", "dst").collect()) == [(2, 1, 3), (3, 2, 4)]


def test_tables_change_together_or_not_at_all(spark, tmp_path):
    ships = spark.createDataFrame([(1, "ada", 10), (2, "bob", None), (3, None, 30)], "id long, name string, tons int")
    piers = spark.createDataFrame([(1, 5), (2, 6)], "pier long, depth int")
    store = sync.TableSet(spark, f"{tmp_path}/t")
    assert store.read() == {}
    store.write({"ships": ships, "piers": piers})
    new_ships = spark.createDataFrame([(1, "ada", 11), (3, None, 30), (4, "dee", 1)], ships.schema)
    new_piers = spark.createDataFrame([(1, 7), (2, 6)], piers.schema)
    keys = {"ships": ["id"], "piers": ["pier"]}
    changes = sync.diff_tables({"ships": ships, "piers": piers}, {"ships": new_ships, "piers": new_piers}, keys)
    content = lambda: {n: sorted(map(tuple, d.collect()), key=str) for n, d in sync.TableSet(spark, f"{tmp_path}/t").read().items()}
    before = content()

    # the second table has moved on: neither changes
    moved = spark.createDataFrame([(1, 8), (2, 6)], piers.schema)
    store.write({"piers": moved})
    with pytest.raises(sync.PatchConflict) as raised:
        store.patch(changes, keys)
    assert [r.pier for r in raised.value.conflicts["piers"].collect()] == [1] and list(raised.value.conflicts) == ["piers"]
    assert content() == before | {"piers": [(1, 8), (2, 6)]}

    # a run that dies after staging: nothing changes, and the next one goes through
    store.write({"piers": piers})
    dying = sync.TableSet(spark, f"{tmp_path}/t")
    dying._versions.publish = lambda *_: (_ for _ in ()).throw(KeyboardInterrupt)
    with pytest.raises(KeyboardInterrupt):
        dying.patch(changes, keys)
    assert content() == before
    store.patch(changes, keys)
    after = {"ships": sorted(map(tuple, new_ships.collect()), key=str), "piers": [(1, 7), (2, 6)]}
    assert content() == after
    with pytest.raises(sync.PatchConflict):
        store.patch(changes, keys)
    with pytest.raises(ValueError):
        store.patch({"boats": changes["ships"]}, {"boats": ["id"]})
    assert content() == after


def test_a_patch_meets_another_writer(spark, tmp_path):
    keys = {"t": ["k"]}
    old = spark.createDataFrame([(1, 1, 1)], "k long, a int, b int")
    store = sync.TableSet(spark, f"{tmp_path}/t")
    store.write({"t": old})
    mine = sync.diff(old, old.withColumn("a", F.lit(2)), ["k"])
    other = sync.diff(old, old.withColumn("b", F.lit(3)), ["k"])
    publish, met = store._versions.publish, []

    def late(number, text):
        if not met:
            met.append(sync.TableSet(spark, f"{tmp_path}/t").patch({"t": other}, keys))
        return publish(number, text)

    store._versions.publish = late
    store.patch({"t": mine}, keys)
    assert [tuple(r) for r in store.read()["t"].collect()] == [(1, 2, 3)]


def test_statistics_count_edge_properties(make):
    g = make([("x", "Ship", {}), ("y", "Ship", {})], [("x", "TOWS", "y", {"w": 1}), ("y", "TOWS", "x", {"w": 2})], "", "w int")
    changed = mutate.set_edge_props(g, g.edges.where("id = 1"), w=F.lit(5), note=F.lit("n"))
    stats = mutate.mutation_stats(g, changed).first()
    assert (stats.nodes_created, stats.edges_created, stats.edges_deleted, stats.properties_set) == (0, 0, 0, 2)
    assert mutate.mutation_stats(changed, g).first().properties_set == 2


def test_merges_with_stored_marks(spark, make, tmp_path):
    """Null keys never match, parallel edges are all updated, new properties appear, ids come from the marks."""
    marks = StoredMarks(spark, f"{tmp_path}/m")
    marks.at_least("nodes", 10)
    marks.at_least("edges", 20)
    g = make([("x", "Ship", {}), ("y", "Ship", {}), ("x", "Pier", {})], [("x", "TOWS", "y", {}), ("x", "TOWS", "y", {}), ("x", "SEES", "y", {})])
    g = mutate.set_props(g, g.nodes.where("id = 2"), name=F.lit(None).cast("string"))
    src, dst = g.edges.select("src", "dst").where("id = 1").first()
    new = spark.createDataFrame([("x", 7), ("x", 5), (None, 1), ("z", 2)], "name string, n int")
    merged = mutate.merge_nodes(g, new, "Ship", ["name"], on_create={"fresh": F.lit(True)}, on_match={"seen": F.col("n")}, marks=marks)
    got = sorted((tuple(r) for r in merged.nodes.select("id", "name", "seen", "fresh", F.col("labels")[0]).collect()), key=str)
    ships = {r[0] for r in g.nodes.where("array_contains(labels, 'Ship') and name = 'x'").select("id").collect()}
    assert {r[0] for r in got if r[2] == 5} == ships and [r[0] for r in got if r[3]] == [11, 12] and {r[1] for r in got if r[3]} == {None, "z"}
    ends = spark.createDataFrame([(src, dst, 1), (dst, src, 2)], "src long, dst long, n int")
    linked = mutate.merge_edges(g, ends, "TOWS", on_create={"born": F.col("n")}, on_match={"met": F.col("n")}, marks=marks)
    assert sorted((r.id, r.type, r.met, r.born) for r in linked.edges.collect()) == [(1, "TOWS", 1, None), (2, "TOWS", 1, None), (3, "SEES", None, None), (21, "TOWS", None, 2)]


def test_merge_spreads_what_cannot_match(spark, make, monkeypatch):
    """Nodes of other labels and nodes without the key do not meet in one task."""
    g = make([("x", "Ship", {}), ("y", "Pier", {})], [])
    many = spark.range(100, 4100).select("id", F.array(F.when(F.col("id") % 2 == 0, F.lit("Ship")).otherwise(F.lit("Buoy"))).alias("labels"), F.lit(None).cast("string").alias("name"))
    g = Graph(g.nodes.select("id", "labels", "name").unionByName(many), g.edges)
    joined = []
    monkeypatch.setattr(mutate, "cut", lambda df, real=mutate.cut: joined.append(real(df)) or joined[-1])
    monkeypatch.setattr(mutate, "dense_number", lambda rows, order, out, start: rows.withColumn(out, F.lit(start)))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        new = spark.createDataFrame([("x",), ("y",), (None,)], "name string").where("name is null or name <> 'none'")
        merged = mutate.merge_nodes(g, new, "Ship", ["name"], on_match={"seen": F.lit(True)})
        most = joined[0].groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert most < 2000
    assert merged.nodes.count() == 4002 + 2  # no Ship is named y, and none has the null name
    assert [r.name for r in merged.nodes.where("seen").collect()] == ["x"]
