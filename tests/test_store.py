"""Stored labels: writes of what changes, restarts, other writers."""

import json

import pytest
from pyspark.sql import functions as F

from lattix.model import Graph
from lattix.operators import stored, write
from lattix.sources.store import CommitConflict, LabelStore
from lattix.streaming import feeds

LABID = 3


def vertices(spark, n):
    return spark.range(n).select((F.lit(LABID << 48) + F.col("id") + 1).alias("id"), F.to_json(F.struct(F.col("id").alias("k"), F.concat(F.lit("name of "), F.sha2(F.col("id").cast("string"), 256)).alias("name"))).alias("properties"))


def rows_of(frame):
    return sorted((r["id"], json.dumps(json.loads(r["properties"]), sort_keys=True)) for r in frame.collect())


def test_a_small_update_writes_little_and_reads_as_a_rewrite(spark, tmp_path):
    base = vertices(spark, 20_000)
    store = LabelStore.create(spark, str(tmp_path / "label"), LABID, base)
    g = Graph(spark, "g").with_label("v", "v", base, labid=LABID)
    some = spark.range(200).select((F.col("id") * 100).alias("k"), F.concat(F.lit("new name of "), F.sha2(F.col("id").cast("string"), 256)).alias("name"))
    more = spark.range(5).select((F.col("id") + 50_000).alias("k"), F.lit("x").alias("name"))
    rows = some.union(more)
    g, *counts = write.upsert_vertices(g, "v", rows, "k", ["k"], "update", require_unique=False)
    before = store.state
    assert stored.upsert_vertices(store, rows, "k", ["k"], "update") == tuple(counts) == (5, 200)
    assert rows_of(store.frame()) == rows_of(g.frames["v"])
    whole = store.bytes(before.base)
    own = sum(store.bytes(f) for f in (*store.state.changes, *store.state.inserts))
    assert store.state.base == before.base and own < whole * 0.02 + 20_000  # a hundredth of the rows; some kB are footers
    one, two = F.col("id") % 97 == 0, F.col("id") % 89 == 0
    g, n = write.set_properties(g, "v", one, F.lit('{"seen": 1.50}'))
    assert stored.set_properties(store, one, F.lit('{"seen": 1.50}')) == n.updated_properties
    g, n = write.remove_property(g, "v", two, "name")
    assert stored.remove_property(store, two, "name") == n.updated_properties
    doomed = base.where(F.col("id") % 7 == 0).select("id")
    g, n = write.delete_vertices(g, "v", doomed)
    assert stored.delete_elements(store, doomed) == n.deleted_vertices
    assert rows_of(store.frame()) == rows_of(g.frames["v"])
    again = LabelStore(spark, str(tmp_path / "label"))  # another driver finds the same
    assert rows_of(again.frame()) == rows_of(g.frames["v"]) and '"seen":1.50' in "".join(r.properties for r in again.frame().where(one).limit(3).collect()).replace(" ", "")
    again.compact()
    assert rows_of(LabelStore(spark, again.path).frame()) == rows_of(g.frames["v"]) and not again.state.changes
    again.clear()
    assert rows_of(again.frame()) == rows_of(g.frames["v"])
    # who was deleted may come again, under a new identity
    assert stored.upsert_vertices(again, spark.createDataFrame([(5, "back")], "k long, name string"), "k", ["k"], "skip") in ((1, 0), (0, 0))


def test_promoted_columns_and_edges(spark, tmp_path):
    v = spark.createDataFrame([((LABID << 48) + 1, "a", 1, '{"x":1}'), ((LABID << 48) + 2, "b", None, "{}")], "id long, code string, size int, properties string")
    store = LabelStore.create(spark, str(tmp_path / "v"), LABID, v)
    rows = spark.createDataFrame([("a", 7, 2), ("c", 8, 3), ("c", 9, 4), ("a", 6, 5)], "code string, size int, n int")
    g = Graph(spark, "g").with_label("v", "v", v, labid=LABID)
    g, *counts = write.upsert_vertices(g, "v", rows, "code", ["n"], "update", require_unique=False)
    assert stored.upsert_vertices(store, rows, "code", ["n"], "update") == tuple(counts)
    key = lambda r: (r.id, r.code, r["size"], json.dumps(json.loads(r.properties), sort_keys=True))
    assert sorted(map(key, store.frame().collect())) == sorted(map(key, g.frames["v"].select("id", "code", "size", "properties").collect()))
    with pytest.raises(ValueError, match="held twice"):
        stored.upsert_vertices(store, rows, "code", ["n"], "update")
    with pytest.raises(ValueError, match="without code"):
        stored.upsert_vertices(store, spark.createDataFrame([(None, 1, 1)], "code string, size int, n int"), "code", ["n"])

    e = spark.createDataFrame([((4 << 48) + 1, 1, 2, '{"w":1}'), ((4 << 48) + 2, 2, 3, "{}")], "id long, start long, end long, properties string")
    edges = LabelStore.create(spark, str(tmp_path / "e"), 4, e)
    g = Graph(spark, "g").with_label("e", "e", e, labid=4)
    rows = spark.createDataFrame([(1, 2, '{"w":2}', 1), (1, 2, '{"u":3}', 2), (5, 6, None, 3), (5, 6, '{"z":1}', 4), (2, 3, None, 5)], "start long, end long, properties string, n int")
    g, *counts = write.upsert_edges(g, "e", rows, ["n"], "update", require_unique=False)
    assert stored.upsert_edges(edges, rows, ["n"], "update") == tuple(counts)
    key = lambda r: (r.id, r.start, r.end, r.properties)
    assert sorted(map(key, edges.frame().collect())) == sorted(map(key, g.frames["e"].collect()))
    doomed = spark.createDataFrame([((LABID << 48) + 1,)], "id long")
    loops = LabelStore.create(spark, str(tmp_path / "l"), 5, spark.createDataFrame([((5 << 48) + 1, (LABID << 48) + 1, (LABID << 48) + 1, "{}")], "id long, start long, end long, properties string"))
    with pytest.raises(ValueError, match="1 edges"):
        stored.delete_vertices(store, [edges, loops], doomed)
    assert stored.delete_vertices(store, [edges, loops], doomed, detach=True) == (1, 1)
    assert loops.frame().count() == 0 and store.frame().where(F.col("id") == (LABID << 48) + 1).count() == 0


def test_a_feed_goes_on_after_its_driver_stopped(spark, tmp_path, monkeypatch):
    """The driver ends once between data and commit, and once between commit and the stream's own mark."""
    source, checkpoint, where = str(tmp_path / "in"), str(tmp_path / "mark"), str(tmp_path / "label")
    for k in range(4):
        spark.range(k * 10, k * 10 + 15).select(F.col("id").alias("k"), F.lit(k).alias("n")).coalesce(1).write.mode("append").parquet(source)
    empty = spark.createDataFrame([], "id long, properties string")
    LabelStore.create(spark, where, LABID, empty)

    def run(session, breaks=None):
        stream = session.readStream.schema("k long, n int").option("maxFilesPerTrigger", 1).parquet(source)
        store = LabelStore(session, where)
        feed = feeds.stored_vertex_feed(store, "k", ["k"], "update", compact_every=3)
        if breaks:
            monkeypatch.setattr(store, breaks[0], breaks[1](getattr(store, breaks[0])))
        feed.start(stream, checkpoint).awaitTermination()

    def before(own):
        def commit(state):
            if state.feeds.get("vertices", [-1])[0] == 1:
                raise RuntimeError("the driver ends")
            own(state)

        return commit

    def after(own):
        def apply(*args, **more):
            own(*args, **more)
            if more.get("batch") == 2:
                raise RuntimeError("the driver ends")

        return apply

    with pytest.raises(Exception, match="the driver ends"):
        run(spark.newSession(), ("_commit", before))
    assert LabelStore(spark, where).frame().count() == 15
    with pytest.raises(Exception, match="the driver ends"):
        run(spark.newSession(), ("apply", after))
    run(spark.newSession())
    held = LabelStore(spark, where)
    got = sorted(json.loads(r.properties)["k"] for r in held.frame().collect())
    assert got == list(range(45)) and held.state.feeds["vertices"][0] == 3
    assert held.frame().select("id").distinct().count() == 45 and held.state.serial == 45


def test_one_of_two_writers_wins(spark, tmp_path):
    store = LabelStore.create(spark, str(tmp_path / "label"), LABID, vertices(spark, 10))
    other = LabelStore(spark, store.path)
    stored.set_properties(store, F.col("id") % 2 == 0, F.lit('{"a":1}'))
    with pytest.raises(CommitConflict):
        stored.set_properties(other, F.col("id") % 2 == 0, F.lit('{"a":2}'))
    assert store.frame().where("properties LIKE '%\"a\":2%'").count() == 0
    with pytest.raises(ValueError, match="already"):
        LabelStore.create(spark, store.path, LABID, vertices(spark, 1))


def test_counts_follow_deletes_and_updates(spark, tmp_path):
    """Counts that are carried on by signed changes are those of a new gathering, after inserts, updates, deletes and a new base."""
    start = F.when(F.col("id") % 3 == 0, F.lit(3 << 48)).otherwise(F.lit(5 << 48)) + F.col("id")
    e = spark.range(300).select((F.lit(4 << 48) + F.col("id") + 1).alias("id"), start.alias("start"), (F.lit(6 << 48) + F.col("id") % 7).alias("end"), F.lit("{}").alias("properties"))
    store = LabelStore.create(spark, str(tmp_path / "e"), 4, e)
    counts, triples = feeds.element_counts(store.frame()), feeds.triples(store.frame())
    told = lambda df: sorted(map(tuple, df.collect()))
    since = store.state.version
    assert told(feeds.carried_on(triples, store.signed(since), "edge_count")) == told(triples)
    more = spark.range(40).select((F.lit(3 << 48) + F.col("id") + 5000).alias("start"), F.lit(6 << 48).alias("end"), F.lit('{"w":1}').alias("properties"))
    assert stored.upsert_edges(store, more, ["start"]) == (40, 0)
    assert stored.upsert_edges(store, more.limit(5), ["start"], "update") == (0, 5)
    stored.set_properties(store, F.col("id") % 2 == 0, F.lit('{"z":1}'))
    store.compact()
    counts, triples, since = feeds.carried_on(counts, store.signed(since), "elements"), feeds.carried_on(triples, store.signed(since), "edge_count"), store.state.version
    assert told(counts) == told(feeds.element_counts(store.frame())) and told(triples) == told(feeds.triples(store.frame()))
    assert stored.delete_elements(store, store.frame().where(F.col("start") < F.lit(4 << 48)).select("id")) == 140
    assert told(feeds.carried_on(triples, store.signed(since), "edge_count")) == told(feeds.triples(store.frame())) == [(5, 4, 6, 200)]
    assert told(feeds.carried_on(counts, store.signed(since), "elements")) == [(4, 200)]
