"""Small graphs: upserts, constraints, walks, description and export, against rows that are written down."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from lattix.functions import ids, props
from lattix.model import Graph
from lattix.operators import constraints, describe, export, match, nearest, write
from lattix.plans import scalar_queries
from lattix.sources import ingest
from lattix.streaming import feeds


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def vertices(g, label):
    return sorted((json.loads(r.properties)["k"], json.loads(r.properties)["v"]) for r in g.frames[label].collect())


def loaded(spark):
    g, n = ingest.load_vertices(Graph(spark, "g").with_label("doc", "v"), "doc", keyed(spark, [(f"k{i}", 0) for i in range(5)]), ["k"])
    assert n == 5
    return g


def test_serials_have_no_gaps(spark):
    df = spark.range(1000).repartition(7)
    got = sorted(r.serial for r in ingest.with_serials(df, ["id"]).collect())
    assert got == list(range(1, 1001))


def test_an_empty_load_gives_nothing(spark):
    g, n = ingest.load_vertices(Graph(spark, "g").with_label("doc", "v"), "doc", keyed(spark, []), ["k"])
    assert n == 0 and g.frames["doc"].count() == 0


def test_upsert_twice_is_upsert_once(spark):
    g = loaded(spark)
    rows = keyed(spark, [("k3", 1), ("k4", 1), ("k5", 1), ("k6", 1)])
    once, inserted, updated = write.upsert_vertices(g, "doc", rows, "k", ["k"], "update", require_unique=False)
    assert (inserted, updated) == (2, 2)
    twice, inserted, updated = write.upsert_vertices(once, "doc", rows, "k", ["k"], "update", require_unique=False)
    assert (inserted, updated) == (0, 4)
    assert vertices(once, "doc") == vertices(twice, "doc") == [("k0", 0), ("k1", 0), ("k2", 0), ("k3", 1), ("k4", 1), ("k5", 1), ("k6", 1)]
    _, inserted, updated = write.upsert_vertices(g, "doc", rows, "k", ["k"], "skip", require_unique=False)
    assert (inserted, updated) == (2, 0)


def test_new_vertices_that_repeat_stay_and_edges_do_not(spark):
    g = loaded(spark)
    _, inserted, _ = write.upsert_vertices(g, "doc", keyed(spark, [("n", 1), ("n", 2)]), "k", ["v"], require_unique=False)
    assert inserted == 2
    e = Graph(spark, "g").with_label("link", "e")
    rows = spark.createDataFrame([(1, 2, '{"w":1}', 0), (1, 2, '{"w":2}', 1), (2, 1, None, 2)], "start long, end long, properties string, o int")
    e, inserted, _ = write.upsert_edges(e, "link", rows, ["o"], require_unique=False)
    assert inserted == 2
    assert sorted((r.start, r.end, r.properties) for r in e.frames["link"].collect()) == [(1, 2, '{"w":1}'), (2, 1, "{}")]
    again = spark.createDataFrame([(1, 2, '{"x":3}', 0), (2, 1, "{}", 1)], "start long, end long, properties string, o int")
    e, inserted, updated = write.upsert_edges(e, "link", again, ["o"], "update", require_unique=False)
    assert (inserted, updated) == (0, 1)
    assert list(json.loads(r.properties).items() for r in e.frames["link"].where("start = 1").collect()) == [{"w": 1, "x": 3}.items()]


def test_upserts_are_guarded(spark):
    g = loaded(spark)
    rows = keyed(spark, [("k1", 1)])
    with pytest.raises(ValueError, match="unique"):
        write.upsert_vertices(g, "doc", rows, "k", ["k"])
    with pytest.raises(ValueError, match="on_existing"):
        write.upsert_vertices(g, "doc", rows, "k", ["k"], "replace")
    with pytest.raises(ValueError, match="without"):
        write.upsert_vertices(g, "doc", keyed(spark, [(None, 1)]), "k", ["k"], require_unique=False)
    g, done = constraints.ensure_constraints(g, [constraints.unique("doc", "k")])
    assert done == [("create", "doc_k_unique")]
    assert write.upsert_vertices(g, "doc", rows, "k", ["k"])[1:] == (0, 0)


def test_constraints_are_reconciled(spark):
    g = loaded(spark)
    with pytest.raises(ValueError, match="break"):
        constraints.ensure_constraints(g, [constraints.unique("doc", "v")])
    long = constraints.unique("doc", "k", name="n" * 80)
    assert len(long.name) == 63
    g, _ = constraints.ensure_constraints(g, [constraints.unique("doc", "k"), long])
    _, planned = constraints.ensure_constraints(g, [constraints.unique("doc", "k")], drop_extra=True, dry_run=True)
    assert planned == [("drop", "n" * 63)]
    assert constraints.ensure_constraints(g, [constraints.unique("doc", "k")])[1] == []


def test_identity_maps(spark):
    mixed = spark.createDataFrame([((3 << 48) + 1, '{"k":1}'), ((3 << 48) + 2, '{"k":"2"}'), ((3 << 48) + 3, '{"k":"03"}')], "id long, properties string")
    g = Graph(spark, "g").with_label("doc", "v", mixed)
    assert {r.key: ids_ & 15 for r in ingest.identity_map(g, "doc", "k").collect() for ids_ in [r.id]} == {"1": 1, "2": 2, "03": 3}
    asked = spark.createDataFrame([(1,), (2,), (3,), (None,)], "key int")
    assert sorted(r.key for r in ingest.identity_map_keys(g, "doc", asked, "k").collect()) == ["1", "2"]
    twice = g.with_frame("doc", mixed.unionAll(mixed.limit(1)))
    with pytest.raises(ValueError, match="more than once"):
        ingest.identity_map(twice, "doc", "k")


def test_edges_need_both_ends(spark):
    rows = spark.createDataFrame([(None, 1, 0)], "start long, end long, o int")
    with pytest.raises(Exception, match="start"):
        ingest.load_edge_frame(Graph(spark, "g").with_label("r", "e"), "r", rows, ["o"])


def chain(spark):
    v = spark.createDataFrame([(i,) for i in range(5)], "id long")
    e = spark.createDataFrame([(10, 0, 1), (11, 1, 2), (12, 2, 0), (13, 2, 3), (14, 3, 3)], "id long, start long, end long")
    return v, e


def test_walks(spark):
    v, e = chain(spark)
    got = {(r.start_id, r.end_id, tuple(r.edge_ids)) for r in match.walk(v.where("id = 0"), e, 1, 5).collect()}
    assert got == {(0, 1, (10,)), (0, 2, (10, 11)), (0, 0, (10, 11, 12)), (0, 3, (10, 11, 13)), (0, 3, (10, 11, 13, 14))}
    assert {r.end_id for r in match.walk(v.where("id = 4"), e, 0, 2).collect()} == {4}
    assert {(r.start_id, r.end_id) for r in match.reachable(v.where("id in (0, 3)"), e).collect()} == {(0, 0), (0, 1), (0, 2), (0, 3), (3, 3)}
    paths = {(r.start_id, r.end_id): r.hops for r in match.shortest_path(v, v, e, 10).collect()}
    assert paths == {(0, 0): 0, (0, 1): 1, (0, 2): 2, (0, 3): 3, (1, 1): 0, (1, 2): 1, (1, 0): 2, (1, 3): 2, (2, 2): 0, (2, 0): 1, (2, 3): 1, (2, 1): 2, (3, 3): 0, (4, 4): 0}
    both = match.expand(e, None, None, "both")
    assert both.count() == 9 and both.where("r_id = 14").count() == 1


def test_deletes(spark):
    v, e = chain(spark)
    g = Graph(spark, "g").with_label("n", "v", v.withColumn("properties", F.lit("{}"))).with_label("r", "e", e.withColumn("properties", F.lit("{}")))
    with pytest.raises(ValueError, match="still meet"):
        write.delete_vertices(g, "n", v.where("id = 3"))
    g2, counts = write.delete_vertices(g, "n", v.where("id = 3"), detach=True)
    assert (counts.deleted_vertices, counts.deleted_edges, counts.total) == (1, 2, 3)
    assert constraints.check_referential(g2).isEmpty()
    gone = g.with_frame("n", g.frames["n"].where("id <> 3"))
    assert {(r.id, r.side) for r in constraints.check_referential(gone).collect()} == {(13, "end"), (14, "start"), (14, "end")}


def described(spark):
    v = spark.createDataFrame([((3 << 48) + 1, '{"name":"a","age":1,"score":1.0,"tags":[1],"ok":true,"nothing":null}'), ((3 << 48) + 2, '{"name":"b","age":"x"}')], "id long, properties string")
    e = spark.createDataFrame([((4 << 48) + 1, (3 << 48) + 1, (3 << 48) + 2, '{"since":2020}')], "id long, start long, end long, properties string")
    return Graph(spark, "g").with_label("person", "v", v).with_label("knows", "e", e).with_label("employee", "v", parent="person")


def test_descriptions(spark):
    g = described(spark)
    assert {(r.name, r.kind) for r in describe.property_shapes(g, "person").collect()} == {("name", "string"), ("age", "string"), ("score", "float"), ("tags", "array"), ("ok", "boolean"), ("nothing", "null")}
    assert {(r.label, r.elements) for r in describe.element_counts(g).collect()} == {("person", 2), ("knows", 1)}
    assert [tuple(r) for r in describe.triples(g).collect()] == [("person", "knows", "person", 1)]
    assert g.family("person") == ["person", "employee"] and g.ancestry("employee") == ["employee", "person"]
    g, stored = describe.gather_triples(g)
    assert describe.meta_is_current(g, stored)
    assert not describe.meta_is_current(g.with_frame("person", g.frames["person"]), stored)


def test_counting_never_reads_the_maps(spark):
    g = described(spark)
    for df in (describe.element_counts(g), describe.triples(g)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "properties" not in plan.split("LocalRelation")[-1].split("\n")[0]


def test_keyed_lookups_are_semi_joins(spark):
    g = loaded(spark)
    plan = ingest.identity_map_keys(g, "doc", spark.createDataFrame([("k1",)], "key string"), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_exports(spark):
    g = described(spark)
    lines = [json.loads(r.value) for r in export.to_json_records(g.frame("knows"), edge=True).collect()]
    assert lines == [{"id": "4.1", "label": "knows", "start": "3.1", "end": "3.2", "properties": {"since": 2020}}]
    df = spark.createDataFrame([(2.5,)], "v double")
    with pytest.raises(Exception, match="not a int"):
        export.export_with_schema(df, "v int").collect()
    with pytest.raises(ValueError, match="columns"):
        export.export_with_schema(df, "w double")
    assert export.export_with_schema(spark.createDataFrame([(2.0,)], "v double"), "v int").first()[0] == 2
    with pytest.raises(ValueError, match="held twice"):
        export.column_lists(df.select("v", F.col("v")))
    typed = export.export_typed_column(spark.createDataFrame([('{"a":1}',), ("[1]",)], "v string"), "v")
    assert typed.schema["v"].dataType.simpleString() == "string"


def test_cells_find_nearly_all(spark):
    import random

    random.seed(1)
    df = spark.createDataFrame([(i, [random.gauss(i % 5, 1) for _ in range(8)]) for i in range(600)], "id long, v array<float>")
    asked = df.where("id % 50 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("query"))
    exact = {(r.query_id, r.id) for r in nearest.nearest_join(asked, df, "v", 5).collect()}
    cells = nearest.Cells(df, "v", lists=6)
    assert {(r.query_id, r.id) for r in cells.search(asked, 5, probes=6).collect()} == exact
    assert len(exact & {(r.query_id, r.id) for r in cells.search(asked, 5, probes=4).collect()}) >= 0.9 * len(exact)


def test_replayed_batches_write_nothing(spark):
    feed = feeds.vertex_feed(Graph(spark, "g").with_label("doc", "v"), "doc", "k", ["k"])
    batch = keyed(spark, [("a", 1), ("b", 2)])
    feed(batch, 0)
    feed(batch, 0)
    feed(keyed(spark, [("b", 3)]), 1)
    assert feed.done == {0: (2, 0), 1: (0, 1)} and vertices(feed.graph, "doc") == [("a", 1), ("b", 3)]


def test_properties_prefer_typed_columns(spark):
    df = spark.createDataFrame([(1, '{"v":"map"}', 7)], "id long, properties string, v int")
    assert df.select(props.prop(df, "v")).first()[0] == 7 and df.drop("v").select(props.prop(df.drop("v"), "v")).first()[0] == "map"
    assert ids.MAX_LABID == 65535


def test_property_writes_are_spread_and_edges_meet_stored_ones_once(spark, monkeypatch):
    """One small file of many maps was one task's work; an update read its rows three times and the stored edges four times."""
    monkeypatch.setattr(write, "_ROWS", 10)
    p = F.col("properties")
    frame = spark.range(100).coalesce(1).select("id", F.to_json(F.struct(F.col("id").alias("k"))).alias("properties"))
    g = Graph(spark, "g").with_label("doc", "v", frame)
    g, counts = write.set_properties(g, "doc", F.col("id") < 30, F.lit('{"s":"x"}'))
    assert counts.updated_properties == 30 and g.frames["doc"].rdd.getNumPartitions() == 10
    told = {r.id: r.properties for r in g.frames["doc"].collect()}
    assert told == {k: f'{{"k":{k},"s":"x"}}' if k < 30 else f'{{"k":{k}}}' for k in range(100)}
    g, counts = write.remove_property(g, "doc", F.col("id") < 40, "s")
    assert counts.updated_properties == 30 and g.frames["doc"].where(props.property_text(p, "s").isNotNull()).count() == 0

    edges = [(1, 10, 20, '{"a":1}'), (2, 10, 20, '{"b":1}'), (3, 11, 20, "{}"), (4, 12, 20, '{"a":5}')]
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    stored = spark.createDataFrame(edges, "id long, start long, end long, properties string").mapInArrow(counted, "id long, start long, end long, properties string")
    rows = [(10, 20, '{"a":2}', 1), (10, 20, None, 9), (10, 20, '{"a":3}', 2), (11, 20, "{}", 3), (13, 21, '{"c":1}', 5), (13, 21, '{"c":2}', 4), (14, 21, None, 6)]
    given = spark.createDataFrame(rows, "start long, end long, properties string, o long")
    g = Graph(spark, "g").with_label("link", "e", stored)
    g, inserted, updated = write.upsert_edges(g, "link", given, ["o"], "update", require_unique=False)
    assert (inserted, updated) == (2, 4)  # two rows with properties, over each of two edges
    told = sorted((r.start, r.end, r.properties) for r in g.frames["link"].collect())
    assert told == [(10, 20, '{"a":3}'), (10, 20, '{"b":1,"a":3}'), (11, 20, "{}"), (12, 20, '{"a":5}'), (13, 21, '{"c":2}'), (14, 21, "{}")]
    assert reads.value <= 2 * len(edges)  # once for the greatest serial, once to meet the rows


def test_a_stream_has_files_as_its_rows_need(spark, monkeypatch):
    folders, real = [], scalar_queries.shared_folder
    monkeypatch.setattr(scalar_queries, "shared_folder", lambda s: folders.append(real(s)) or folders[-1])
    monkeypatch.setattr(scalar_queries, "_FILE_ROWS", 10)
    stream, checkpoint = scalar_queries._stream(spark, spark.range(95), "n")
    sizes = []
    stream.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count())).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    files = glob.glob(f"{folders[0].removeprefix('file:')}/*.parquet")
    assert len(files) == 10 and len(sizes) == 2 and sum(sizes) == 95  # four files before, however many rows
