"""Export layouts over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lattix.functions import vectors
from lattix.operators import export, match
from lattix.plans.commerce import LABID, edges, graph, sid, vertices
from lattix.plans.registry import query

_TEXT = lambda label, key: f"'{LABID[label]}.' || ({key} + 1)"


def _events(spark, sf):
    return vertices(spark, sf, "event").select("id", F.lit("event").alias("label"), "properties", "event_id")


def _did(spark, sf):
    return edges(spark, sf, "did").select("id", F.lit("did").alias("label"), "start", "end", F.lit('{"w":1}').alias("properties"))


@query("export_struct", f"SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN {_TEXT('event', 'event_id')} END AS id, CASE WHEN event_id % 5 <> 0 THEN props END AS properties, event_id % 5 = 0 AS nothing FROM events")
def export_struct(spark, sf):
    e = _events(spark, sf).withColumn("id", F.when(F.col("event_id") % 5 != 0, F.col("id"))).withColumn("n", export.element_struct())
    return e.select("event_id", "n.id", "n.properties", F.col("n").isNull().alias("nothing"))


@query("export_columns", f"SELECT {_TEXT('did', 'event_id')} AS \"r.id\", 'did' AS \"r.label\", {_TEXT('user', 'user_id')} AS \"r.start\", {_TEXT('event', 'event_id')} AS \"r.end\", '{{\"w\":1}}' AS \"r.properties\" FROM events")
def export_columns(spark, sf):
    return export.export_columns(_did(spark, sf), "r", edge=True)


@query("export_identity", f"SELECT {sid('customer', 'c_custkey')}::DECIMAL(20,0)::VARCHAR AS packed, {_TEXT('customer', 'c_custkey')} AS text, {_TEXT('customer', 'c_custkey')} || ',' || {_TEXT('nation', 'c_nationkey')} AS list FROM customer")
def export_identity(spark, sf):
    d = edges(spark, sf, "lives_in")
    return d.select(export.export_identity(F.col("start"), "packed").cast("string").alias("packed"), export.export_identity(F.col("start")).alias("text"), F.array_join(export.export_identities(F.array("start", "end")), ",").alias("list"))


@query("export_properties", "SELECT event_id, (props->>'k')::BIGINT AS k, NULL::VARCHAR AS missing, props AS as_text FROM events")
def export_properties(spark, sf):
    e = _events(spark, sf).withColumn("p", export.export_properties(F.col("properties"), {"k": "bigint", "missing": "string"}))
    return e.select("event_id", "p.k", "p.missing", export.export_properties(F.col("properties")).alias("as_text"))


@query("export_vectors", "SELECT vec_id, CASE WHEN vec_id % 4 <> 0 THEN 64 END::INT AS width, round(embedding[64]::DOUBLE, 6) * CASE WHEN vec_id % 4 <> 0 THEN 1 END AS last FROM embeddings")
def export_vectors(spark, sf):
    e = vertices(spark, sf, "emb").withColumn("v", export.export_vectors(F.when(F.col("vec_id") % 4 != 0, F.col("embedding")), 64))
    return e.select("vec_id", F.when(F.col("v").isNotNull(), F.size("v")).alias("width"), F.round(F.col("v")[63].cast("double"), 6).alias("last"))


@query("export_sparse", "WITH s AS (SELECT vec_id, embedding, list_filter(range(1, len(embedding) + 1), lambda i: abs(embedding[i]) > 0.1::FLOAT) AS pos FROM embeddings) SELECT vec_id, '{' || array_to_string(list_transform(pos, lambda i: i || CASE WHEN embedding[i] > 0 THEN ':9' ELSE ':-9' END), ',') || '}/64' AS text, pos[1] - 1 AS at, array_to_string(list_transform(embedding, lambda x: CASE WHEN abs(x) <= 0.1::FLOAT THEN '0' WHEN x > 0 THEN '9' ELSE '-9' END), ',') AS dense FROM s")
def export_sparse(spark, sf):
    """The signs of components beyond a tenth in size; the rest are zeros."""
    signs = F.transform("embedding", lambda x: F.when(F.abs(x) > F.lit(0.1).cast("float"), F.signum(x) * 9).otherwise(0).cast("float"))
    e = vertices(spark, sf, "emb").select("vec_id", vectors.sparse_from_dense(signs).alias("s"))
    dense = F.array_join(F.transform(export.export_sparse(F.col("s"), "dense"), lambda x: x.cast("int").cast("string")), ",")
    return e.select("vec_id", export.export_sparse(F.col("s"), "text").alias("text"), F.get(export.export_sparse(F.col("s"))["indices"], F.lit(0)).cast("long").alias("at"), dense.alias("dense"))


def _paths(spark, sf):
    n = vertices(spark, sf, "nation").select("id", F.lit("nation").alias("label"), F.to_json(F.struct("n_name")).alias("properties"))
    r = vertices(spark, sf, "region").select("id", F.lit("region").alias("label"), F.to_json(F.struct("r_name")).alias("properties"))
    e = edges(spark, sf, "in_region").select("id", F.lit("in_region").alias("label"), "start", "end", F.lit("{}").alias("properties"))
    p = match.walk(n, e, 1, 1).withColumn("key", F.element_at("edge_ids", 1))
    return match.path_elements(p, n.unionAll(r), e, "key")


@query("export_element_lists", f"SELECT n_nationkey::BIGINT AS n_nationkey, {_TEXT('nation', 'n_nationkey')} || ',' || '-' || ',' || {_TEXT('region', 'n_regionkey')} AS elements FROM nation")
def export_element_lists(spark, sf):
    some = F.array(F.col("vertices")[0], F.lit(None), F.col("vertices")[1])
    made = _paths(spark, sf).select("key", export.export_element_list(some).alias("list"))
    return made.select((F.col("key").bitwiseAND(F.lit((1 << 48) - 1)) - 1).alias("n_nationkey"), F.array_join(F.transform("list", lambda e: F.coalesce(e["id"], F.lit("-"))), ",").alias("elements"))


@query("export_paths", f"SELECT {_TEXT('nation', 'n_nationkey')} AS first, {_TEXT('region', 'n_regionkey')} AS last, {_TEXT('in_region', 'n_nationkey')} AS edge, {_TEXT('nation', 'n_nationkey')} AS edge_start FROM nation")
def export_paths(spark, sf):
    p = export.export_paths(_paths(spark, sf).select("vertices", "edges"))
    v, e = F.col("p.vertices"), F.col("p.edges")
    return p.select(v[0]["id"].alias("first"), v[1]["id"].alias("last"), e[0]["id"].alias("edge"), e[0]["start"].alias("edge_start"))


@query("export_with_schema", "SELECT c_custkey::INT AS c_custkey, c_name, c_nationkey::DOUBLE AS c_nationkey FROM customer")
def export_with_schema(spark, sf):
    c = vertices(spark, sf, "customer").select("c_name", "c_custkey", "c_nationkey")
    return export.export_with_schema(c, "c_custkey int, c_name string, c_nationkey double")


@query("export_typed_column", "SELECT event_id, (props->>'k')::BIGINT AS k, value AS v, event_id AS first FROM events")
def export_typed_column(spark, sf):
    e = vertices(spark, sf, "event")
    raw = e.select("event_id", F.get_json_object("properties", "$.k").alias("k"), F.to_json(F.array("event_id", F.lit(1))).alias("list"), "value")
    typed = export.export_typed_column(export.export_typed_column(raw, "k"), "list")
    return typed.select("event_id", "k", F.col("value").alias("v"), F.col("list")[0].alias("first"))


@query("write_chunked", "SELECT o_orderkey, o_totalprice FROM orders")
def write_chunked(spark, sf):
    from lattix.tables import shared_folder

    path = shared_folder(spark)
    export.write_chunked(vertices(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path)
    return spark.read.parquet(path)


@query("to_json_records", f"SELECT '{{\"id\":\"' || {_TEXT('did', 'event_id')} || '\",\"label\":\"did\",\"start\":\"' || {_TEXT('user', 'user_id')} || '\",\"end\":\"' || {_TEXT('event', 'event_id')} || '\",\"properties\":{{\"w\":1}}}}' AS value FROM events UNION ALL SELECT '{{\"id\":\"' || {_TEXT('event', 'event_id')} || '\",\"label\":\"event\",\"properties\":' || props || '}}' FROM events")
def to_json_records(spark, sf):
    return export.to_json_records(_did(spark, sf), edge=True).unionAll(export.to_json_records(_events(spark, sf)))


_NATION, _REGION, _IN = _TEXT("nation", "n_nationkey"), _TEXT("region", "n_regionkey"), _TEXT("in_region", "n_nationkey")


@query("path_json_records", f"""
SELECT '{{"vertices":[{{"id":"' || {_NATION} || '","label":"nation","properties":' || to_json({{'n_name': n_name}}) || '}},{{"id":"' || {_REGION} || '","label":"region","properties":' || to_json({{'r_name': r_name}})
|| '}}],"edges":[{{"id":"' || {_IN} || '","label":"in_region","start":"' || {_NATION} || '","end":"' || {_REGION} || '","properties":{{}}}}]}}' AS value FROM nation JOIN region ON n_regionkey = r_regionkey""")
def path_json_records(spark, sf):
    return export.to_json_records(_paths(spark, sf), kind="path")


@query("vector_json_records", "SELECT '[' || array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1.5' ELSE '-0.5' END), ',') || ']' AS value FROM embeddings")
def vector_json_records(spark, sf):
    signs = F.transform("embedding", lambda x: F.when(x > 0, F.lit(1.5)).otherwise(F.lit(-0.5)).cast("float"))
    return export.to_json_records(vertices(spark, sf, "emb").select(signs.alias("v")), kind="vector", column="v")


@query("sparse_json_records", "SELECT '{\"dimensions\":64,\"indices\":[' || array_to_string(list_transform(pos, lambda i: i - 1), ',') || '],\"values\":[' || array_to_string(list_transform(pos, lambda i: '1.5'), ',') || ']}' AS value FROM (SELECT list_filter(range(1, 65), lambda i: embedding[i] > 0) AS pos FROM embeddings)")
def sparse_json_records(spark, sf):
    kept = F.transform("embedding", lambda x: F.when(x > 0, F.lit(1.5)).otherwise(F.lit(0.0)).cast("float"))
    return export.to_json_records(vertices(spark, sf, "emb").select(vectors.sparse_from_dense(kept).alias("s")), kind="sparse", column="s")


@query("column_lists", f"SELECT {_TEXT('event', 'event_id')} AS id, 'event' AS label, props->>'k' AS k FROM events")
def column_lists(spark, sf):
    made = export.column_lists(graph(spark, sf, "event").frame("event", columns=["id", "properties"]))
    return made.select("id", "label", F.col("properties")["k"].alias("k"))
