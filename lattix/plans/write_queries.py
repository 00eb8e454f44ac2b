"""Writes over graphs made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lattix.functions import ids, props
from lattix.model import Graph
from lattix.operators import constraints, stored, write
from lattix.plans.commerce import LABID, graph, table, vertices
from lattix.plans.registry import query
from lattix.sources.store import LabelStore
from lattix.tables import shared_folder


#: Customers that are stored before a write; the rows that come are those of all customers.
_HELD = "c_acctbal >= 3000"


def _people(spark, sf, where: str = _HELD) -> Graph:
    """Customers with their name and nation in an open map."""
    c = table(spark, sf, "customer").where(where)
    frame = c.select(ids.pack(3, F.col("c_custkey") + 1).alias("id"), F.to_json(F.struct(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("n"))).alias("properties"))
    return Graph(spark, "people").with_label("person", "v", frame)


def _told(df):
    p = F.col("properties")
    return df.select(props.property_text(p, "k").alias("k"), props.property_text(p, "name").alias("name"), props.property_text(p, "n").alias("n"), props.property_text(p, "s").alias("s"))


def _incoming(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("s"))


@query("create_elements", "SELECT doc_id::VARCHAR AS doc_id, CASE WHEN quality IS NULL THEN 1 ELSE 2 END::BIGINT AS n_keys, quality::VARCHAR AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def create_elements(spark, sf):
    d = vertices(spark, sf, "doc").select("doc_id", "quality")
    g, _ = write.create_vertices(Graph(spark, "g").with_label("doc", "v"), "doc", d, ["doc_id"])
    p = F.col("properties")
    return g.frames["doc"].select(props.property_text(p, "doc_id").alias("doc_id"), F.size(props.keys(p)).cast("long").alias("n_keys"), props.property_text(p, "quality").alias("quality"))


@query("upsert_vertices_skip", f"SELECT c_custkey::VARCHAR AS k, CASE WHEN {_HELD} THEN c_name END AS name, CASE WHEN {_HELD} THEN c_nationkey::VARCHAR END AS n, CASE WHEN NOT {_HELD} THEN c_mktsegment END AS s FROM customer")
def upsert_vertices_skip(spark, sf):
    g, _, _ = write.upsert_vertices(_people(spark, sf), "person", _incoming(spark, sf), "k", ["k"], require_unique=False)
    return _told(g.frames["person"])


_UPDATED = f"SELECT c_custkey::VARCHAR AS k, CASE WHEN {_HELD} THEN c_name END AS name, CASE WHEN {_HELD} THEN c_nationkey::VARCHAR END AS n, c_mktsegment AS s FROM customer"


@query("upsert_vertices_update", _UPDATED)
def upsert_vertices_update(spark, sf):
    g, _, _ = write.upsert_vertices(_people(spark, sf), "person", _incoming(spark, sf), "k", ["k"], "update", require_unique=False)
    return _told(g.frames["person"])


@query("upsert_vertices_ids", f"SELECT {3 << 48} + max(CASE WHEN {_HELD} THEN c_custkey + 1 END) OVER () + row_number() OVER (PARTITION BY {_HELD} ORDER BY c_custkey) AS id, c_custkey::VARCHAR AS k FROM customer QUALIFY NOT {_HELD}")
def upsert_vertices_ids(spark, sf):
    """Identities of the new ones follow the greatest stored, without gaps."""
    g, _, _ = write.upsert_vertices(_people(spark, sf), "person", _incoming(spark, sf), "k", ["k"], require_unique=False)
    p = F.col("properties")
    return g.frames["person"].where(props.property_text(p, "name").isNull()).select("id", props.property_text(p, "k").alias("k"))


@query("stored_upsert_vertices", _UPDATED)
def stored_upsert_vertices(spark, sf):
    """The same upsert into a stored label: only new and changed vertices are written, and the reader merges them."""
    store = LabelStore.create(spark, shared_folder(spark), 3, _people(spark, sf).frames["person"])
    stored.upsert_vertices(store, _incoming(spark, sf), "k", ["k"], "update")
    return _told(store.frame())


@query("stored_changes", "SELECT c_custkey::VARCHAR AS k, CASE WHEN c_nationkey < 6 THEN NULL ELSE c_name END AS name, c_nationkey::VARCHAR AS n, CASE WHEN c_nationkey > 12 THEN 'big' END AS s FROM customer WHERE c_acctbal >= 0")
def stored_changes(spark, sf):
    """Properties set and removed, vertices deleted, and all of it joined into a new base, each a version of the label."""
    store = LabelStore.create(spark, shared_folder(spark), 3, _people(spark, sf, "true").frames["person"])
    nation = props.property_text(F.col("properties"), "n").cast("int")
    stored.set_properties(store, nation > 12, F.lit('{"s": "big"}'))
    stored.remove_property(store, nation < 6, "name")
    poor = table(spark, sf, "customer").where("c_acctbal < 0").select(ids.pack(3, F.col("c_custkey") + 1).alias("id"))
    stored.delete_elements(store, poor)
    store.compact()
    return _told(store.frame())


def _pairs(spark, sf):
    """Each line's order and part twice over, some of them stored already."""
    line = table(spark, sf, "lineitem")
    made = line.select(F.col("l_partkey").alias("start"), F.col("l_suppkey").alias("end"), F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"))
    return made.select("start", "end", F.to_json(F.struct("o", "l")).alias("properties"), "o", "l")


def _stored_pairs(spark, sf) -> Graph:
    old = table(spark, sf, "lineitem").where("l_orderkey % 4 = 0").select("l_partkey", "l_suppkey").distinct()
    frame = old.select(ids.pack(3, F.col("l_partkey") * 1_000_000 + F.col("l_suppkey") + 1).alias("id"), F.col("l_partkey").alias("start"), F.col("l_suppkey").alias("end"), F.lit('{"old":true}').alias("properties"))
    return Graph(spark, "g").with_label("link", "e", frame)


_PAIRS = """
WITH old AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_orderkey % 4 = 0),
f AS (SELECT l_partkey, l_suppkey, arg_min(l_orderkey, l_orderkey * 8 + l_linenumber) AS o, arg_max(l_orderkey, l_orderkey * 8 + l_linenumber) AS last_o FROM lineitem GROUP BY 1, 2)
SELECT l_partkey AS start, l_suppkey AS "end", {} AS o, old.l_partkey IS NOT NULL AS old FROM f LEFT JOIN old USING (l_partkey, l_suppkey)"""


def _told_pairs(df):
    p = F.col("properties")
    return df.select("start", "end", props.property_text(p, "o").alias("o"), props.property_text(p, "old").isNotNull().alias("old"))


@query("upsert_edges_skip", _PAIRS.format("CASE WHEN old.l_partkey IS NULL THEN o::VARCHAR END"))
def upsert_edges_skip(spark, sf):
    g, _, _ = write.upsert_edges(_stored_pairs(spark, sf), "link", _pairs(spark, sf), ["o", "l"], require_unique=False)
    return _told_pairs(g.frames["link"])


@query("upsert_edges_update", _PAIRS.format("CASE WHEN old.l_partkey IS NULL THEN o::VARCHAR ELSE last_o::VARCHAR END"))
def upsert_edges_update(spark, sf):
    g, _, _ = write.upsert_edges(_stored_pairs(spark, sf), "link", _pairs(spark, sf), ["o", "l"], "update", require_unique=False)
    return _told_pairs(g.frames["link"])


@query("upsert_guard", f"SELECT 'without a constraint' AS how, FALSE AS allowed, 0::BIGINT AS inserted UNION ALL SELECT 'with one', TRUE, count(*) FILTER (WHERE NOT {_HELD}) FROM customer")
def upsert_guard(spark, sf):
    g, rows = _people(spark, sf), _incoming(spark, sf)
    try:
        write.upsert_vertices(g, "person", rows, "k", ["k"])
        refused = False
    except ValueError:
        refused = True
    g, _ = constraints.ensure_constraints(g, [constraints.unique("person", "k")])
    _, inserted, _ = write.upsert_vertices(g, "person", rows, "k", ["k"])
    return spark.createDataFrame([("without a constraint", not refused, 0), ("with one", True, inserted)], "how string, allowed boolean, inserted long")


@query("merge_pattern", _UPDATED)
def merge_pattern(spark, sf):
    g, _ = write.merge_vertices(_people(spark, sf), "person", _incoming(spark, sf), "k", ["k"])
    return _told(g.frames["person"])


@query("merge_edges", "SELECT DISTINCT l_partkey AS start, l_suppkey AS \"end\" FROM lineitem")
def merge_edges(spark, sf):
    g, _ = write.merge_edges(_stored_pairs(spark, sf), "link", _pairs(spark, sf))
    return g.frames["link"].select("start", "end")


@query("set_properties", "SELECT c_custkey::VARCHAR AS k, CASE WHEN c_nationkey > 12 THEN 'big' ELSE c_name END AS name, c_nationkey::VARCHAR AS n, CASE WHEN c_nationkey > 12 THEN c_custkey::VARCHAR END AS s FROM customer")
def set_properties(spark, sf):
    p = F.col("properties")
    given = F.to_json(F.struct(F.lit("big").alias("name"), props.property_text(p, "k").cast("long").alias("s")))
    g, _ = write.set_properties(_people(spark, sf, "true"), "person", props.property_text(p, "n").cast("int") > 12, given)
    return _told(g.frames["person"])


@query("remove_property", "SELECT c_custkey::VARCHAR AS k, CASE WHEN c_nationkey >= 6 THEN c_name END AS name, c_nationkey::VARCHAR AS n, NULL::VARCHAR AS s FROM customer")
def remove_property(spark, sf):
    g, _ = write.remove_property(_people(spark, sf, "true"), "person", props.property_text(F.col("properties"), "n").cast("int") < 6, "name")
    return _told(g.frames["person"])


@query("delete_elements", "SELECT 'customer' AS label, count(*)::BIGINT AS n FROM customer WHERE c_nationkey <> 3 UNION ALL SELECT 'lives_in', count(*) FROM customer WHERE c_nationkey <> 3 UNION ALL SELECT 'placed', count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey <> 3")
def delete_elements(spark, sf):
    g = graph(spark, sf, "customer", "lives_in", "placed")
    g, _ = write.delete_vertices(g, "customer", g.frames["customer"].where("c_nationkey = 3"), detach=True)
    parts = [g.frames[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("label"), "n") for n in ("customer", "lives_in", "placed")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("delete_edges", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'")
def delete_edges(spark, sf):
    g = graph(spark, sf, "placed")
    doomed = vertices(spark, sf, "orders").where("o_orderstatus = 'P'").select(ids.pack(LABID["placed"], ids.locid(F.col("id"))).alias("id"))
    g, _ = write.delete_edges(g, "placed", doomed)
    return g.frames["placed"].select((ids.locid(F.col("id")) - 1).alias("o_orderkey"))


@query("write_counts", f"""
SELECT 'merge' AS write, count(*) FILTER (WHERE NOT {_HELD})::BIGINT AS inserted_vertices, 0::BIGINT AS inserted_edges, 0::BIGINT AS deleted_vertices, 0::BIGINT AS deleted_edges, count(*) FILTER (WHERE {_HELD})::BIGINT AS updated_properties FROM customer
UNION ALL SELECT 'delete', 0, 0, (SELECT count(*) FROM customer WHERE c_nationkey = 3), (SELECT count(*) FROM customer WHERE c_nationkey = 3) + (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 3), 0""")
def write_counts(spark, sf):
    g = _people(spark, sf)
    _, merged = write.merge_vertices(g, "person", _incoming(spark, sf), "k", ["k"])
    c = graph(spark, sf, "customer", "lives_in", "placed")
    _, deleted = write.delete_vertices(c, "customer", c.frames["customer"].where("c_nationkey = 3"), detach=True)
    return merged.frame(g).select(F.lit("merge").alias("write"), "*").unionAll(deleted.frame(g).select(F.lit("delete").alias("write"), "*"))
