"""Ingest, identities and decoding over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lattix.functions import ids
from lattix.model import Graph
from lattix.plans.commerce import LABID, edges, graph, sid, table, vertices
from lattix.plans.registry import query
from lattix.sources import ingest, rendered

_NAMED = "SELECT {base} + row_number() OVER (ORDER BY {key}) AS id, to_json({{{fields}}})::VARCHAR AS properties FROM {t}"


def _fields(*names: str) -> str:
    return ", ".join(f"'{n}': {n}" for n in names)


@query("load_vertices", _NAMED.format(base=3 << 48, key="c_custkey", fields=_fields("c_custkey", "c_name", "c_nationkey"), t="customer"))
def load_vertices(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    g, _ = ingest.load_vertices(Graph(spark, "g").with_label("person", "v"), "person", df, ["c_custkey"])
    return g.frames["person"]


@query("load_edges", f"SELECT {3 << 48} + row_number() OVER (ORDER BY o_orderkey) AS id, {sid('customer', 'o_custkey')} AS start, {sid('orders', 'o_orderkey')} AS \"end\", CASE WHEN o_orderstatus = 'F' THEN '{{}}' ELSE to_json({{'status': o_orderstatus}})::VARCHAR END AS properties FROM orders")
def load_edges(spark, sf):
    o = table(spark, sf, "orders")
    df = o.select(ids.pack(LABID["customer"], F.col("o_custkey") + 1).alias("start"), ids.pack(LABID["orders"], F.col("o_orderkey") + 1).alias("end"), F.when(F.col("o_orderstatus") != "F", F.to_json(F.struct(F.col("o_orderstatus").alias("status")))).alias("properties"), "o_orderkey")
    g, _ = ingest.load_edges(Graph(spark, "g").with_label("placed", "e"), "placed", df, ["o_orderkey"])
    return g.frames["placed"]


@query("load_vertex_frame", f"SELECT {3 << 48} + row_number() OVER (ORDER BY props, event_id) AS id, props AS properties FROM events")
def load_vertex_frame(spark, sf):
    df = table(spark, sf, "events").select(F.col("props").alias("properties"))
    g, _ = ingest.load_vertex_frame(Graph(spark, "g").with_label("event", "v"), "event", df, ["properties"])
    return g.frames["event"]


@query("load_edge_frame", f"SELECT {3 << 48} + row_number() OVER (ORDER BY s_suppkey) AS id, {sid('supplier', 's_suppkey')} AS start, {sid('nation', 's_nationkey')} AS \"end\", to_json({{'s_suppkey': s_suppkey}})::VARCHAR AS properties FROM supplier")
def load_edge_frame(spark, sf):
    b = table(spark, sf, "supplier").select(ids.format_id(ids.pack(LABID["supplier"], F.col("s_suppkey") + 1)).alias("from"), ids.pack(LABID["nation"], F.col("s_nationkey").cast("long") + 1).alias("to"), "s_suppkey")
    g, _ = ingest.load_edge_frame(Graph(spark, "g").with_label("based", "e"), "based", b, ["s_suppkey"], "from", "to")
    return g.frames["based"]


@query("identity_map", f"SELECT o_orderkey::VARCHAR AS key, {sid('orders', 'o_orderkey')} AS id FROM orders")
def identity_map(spark, sf):
    return ingest.identity_map(graph(spark, sf, "orders"), "orders", "o_orderkey")


@query("identity_map_keys", f"SELECT c_custkey::VARCHAR AS key, {sid('customer', 'c_custkey')} AS id FROM customer WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def identity_map_keys(spark, sf):
    asked = table(spark, sf, "orders").where("o_orderstatus = 'P'")
    texts = asked.where("o_orderkey % 3 <> 0").select(F.col("o_custkey").cast("string").alias("key"))
    numbers = asked.where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("key"))
    found = [ingest.identity_map_keys(graph(spark, sf, "customer"), "customer", some, "c_custkey") for some in (texts.unionAll(texts.select(F.lit(None).cast("string"))), numbers)]
    return found[0].unionAll(found[1]).distinct()


@query("identity_map_promoted", f"SELECT p_name AS key, min({sid('part', 'p_partkey')}) AS id FROM part GROUP BY p_name HAVING count(*) = 1")
def identity_map_promoted(spark, sf):
    g = graph(spark, sf, "part")
    keyed = ingest.keyed(g.frame("part"), "p_name")
    return keyed.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n = 1").select("key", "id")


@query("resolve_edges", f"SELECT l_orderkey::VARCHAR || '/' || l_linenumber AS edge, {sid('orders', 'l_orderkey')} AS start, {sid('part', 'l_partkey')} AS \"end\" FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderstatus = 'P'")
def resolve_edges(spark, sf):
    g = graph(spark, sf, "orders", "part")
    some = g.with_frame("orders", g.frames["orders"].where("o_orderstatus = 'P'"))
    raw = table(spark, sf, "lineitem").select(F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string")).alias("edge"), F.col("l_orderkey").alias("src_key"), F.col("l_partkey").alias("dst_key"))
    good, _ = ingest.resolve_edges(raw, ingest.identity_map(some, "orders", "o_orderkey"), ingest.identity_map(g, "part", "p_partkey"))
    return good.select("edge", "start", "end")


@query("resolve_edges_rejects", "SELECT l_orderkey, l_linenumber::INT AS l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'")
def resolve_edges_rejects(spark, sf):
    g = graph(spark, sf, "orders", "part")
    some = g.with_frame("orders", g.frames["orders"].where("o_orderstatus = 'P'"))
    raw = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), F.col("l_orderkey").alias("src_key"), F.col("l_partkey").alias("dst_key"))
    return ingest.resolve_edges(raw, ingest.identity_map(some, "orders", "o_orderkey"), ingest.identity_map(g, "part", "p_partkey"))[1].select("l_orderkey", "l_linenumber")


def _rendered_events(spark, sf):
    """Every seventh text has what looks like an identity in its label, every eleventh has text after its map."""
    e = vertices(spark, sf, "event")
    label = F.when(F.col("event_id") % 7 == 0, F.concat(F.col("event_type"), F.lit("[1.2]x"))).otherwise(F.col("event_type"))
    return e.select("event_id", F.concat(label, F.lit("["), ids.format_id(F.col("id")), F.lit("]"), F.col("properties"), F.when(F.col("event_id") % 11 == 0, "!").otherwise("")).alias("raw"))


@query("decode_vertices", f"SELECT event_id, CASE WHEN event_id % 7 = 0 THEN event_type || '[1.2]x' ELSE event_type END AS label, {sid('event', 'event_id')} AS id, props AS properties FROM events WHERE event_id % 11 <> 0")
def decode_vertices(spark, sf):
    return rendered.decode_vertices(_rendered_events(spark, sf))[0].select("event_id", "label", "id", "properties")


@query("decode_vertices_rejects", "SELECT event_id FROM events WHERE event_id % 11 = 0")
def decode_vertices_rejects(spark, sf):
    return rendered.decode_vertices(_rendered_events(spark, sf))[1].select("event_id")


def _rendered_did(spark, sf):
    d = edges(spark, sf, "did")
    return d.select("id", "start", "end", F.concat(F.lit("did["), ids.format_id(F.col("id")), F.lit("]["), ids.format_id(F.col("start")), F.lit(","), ids.format_id(F.col("end")), F.lit(']{"w": 1}')).alias("raw"))


@query("decode_edges", f"SELECT 'did' AS label, {sid('did', 'event_id')} AS id, {sid('user', 'user_id')} AS start, {sid('event', 'event_id')} AS \"end\", '{{\"w\": 1}}' AS properties FROM events")
def decode_edges(spark, sf):
    return rendered.decode_edges(_rendered_did(spark, sf).select("raw"))[0].select("label", "id", "start", "end", "properties")


@query("decode_paths", f"SELECT event_id::BIGINT AS row, 2::BIGINT AS n_vertices, 1::BIGINT AS n_edges, {sid('user', 'user_id')} AS first_id, {sid('event', 'event_id')} AS last_id, {sid('did', 'event_id')} AS edge_id, props AS last_properties FROM events")
def decode_paths(spark, sf):
    e = table(spark, sf, "events")
    uid, eid, did = (ids.format_id(ids.pack(LABID[n], F.col(k).cast("long") + 1)) for n, k in (("user", "user_id"), ("event", "event_id"), ("did", "event_id")))
    raw = F.concat(F.lit("[user["), uid, F.lit("]{},did["), did, F.lit("]["), uid, F.lit(","), eid, F.lit("]{},event["), eid, F.lit("]"), F.col("props"), F.lit("]"))
    good, _ = rendered.decode_paths(e.select(F.col("event_id").cast("long").alias("row"), raw.alias("raw")))
    v, d = F.col("vertices"), F.col("edges")
    return good.select("row", F.size(v).cast("long").alias("n_vertices"), F.size(d).cast("long").alias("n_edges"), v[0]["id"].alias("first_id"), v[1]["id"].alias("last_id"), d[0]["id"].alias("edge_id"), v[1]["properties"].alias("last_properties"))


@query("scan_columnar", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def scan_columnar(spark, sf):
    nation = ingest.scan_columnar(spark, f"{sf}/nation.parquet")
    region = ingest.scan_columnar(spark, f"{sf}/region.parquet", "parquet")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
