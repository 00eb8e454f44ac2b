"""Description and constraints over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattix.model import Graph
from lattix.operators import constraints, describe
from lattix.plans.commerce import EDGE_LABELS, FOLLOWS_SQL, LABID, VERTEX_LABELS, graph, sid
from lattix.plans.registry import query
from lattix.tables import shared_folder

_COUNTS = {"region": "region", "nation": "nation", "customer": "customer", "supplier": "supplier", "part": "part", "orders": "orders", "in_region": "nation", "lives_in": "customer", "based_in": "supplier", "placed": "orders", "contains": "lineitem"}


_HELD = ("region", "nation", "customer", "supplier", "part", "orders", "in_region", "lives_in", "based_in", "placed", "contains")
_ELEMENTS = "(" + " UNION ALL ".join(f"SELECT '{k}' AS name, count(*)::BIGINT AS elements FROM {_COUNTS[k]}" for k in _HELD) + ") e"


def _saved(spark, sf, name, *labels):
    """A graph that was saved and loaded again: its catalog comes from the tables that it was stored in."""
    path = shared_folder(spark)
    graph(spark, sf, *labels).save(path)
    return Graph.load(spark, name, path)


@query("graphs", f"SELECT 'commerce' AS name, 'commerce' AS schema, {len(_HELD) + 2}::BIGINT AS labels, sum(elements)::BIGINT AS elements FROM {_ELEMENTS} UNION ALL SELECT 'small', 'small', 4, sum(elements)::BIGINT FROM {_ELEMENTS} WHERE name IN ('region', 'nation')")
def graphs(spark, sf):
    known = [_saved(spark, sf, "commerce", *_HELD), _saved(spark, sf, "small", "region", "nation")]
    held = [describe.element_counts(g).agg(F.sum("elements").alias("elements")).select(F.lit(g.name).alias("name"), "elements") for g in known]
    return describe.graphs(*known).join(held[0].unionAll(held[1]), "name")


@query("labels", "SELECT l.*, e.elements FROM (" + " UNION ALL ".join(f"SELECT {LABID[k]}::INT AS labid, '{k}' AS name, '{'v' if k in VERTEX_LABELS else 'e'}' AS kind, '{'ag_vertex' if k in VERTEX_LABELS else 'ag_edge'}' AS parent, FALSE AS built_in" for k in _HELD) + f" UNION ALL SELECT 1, 'ag_vertex', 'v', NULL, TRUE UNION ALL SELECT 2, 'ag_edge', 'e', NULL, TRUE) l LEFT JOIN {_ELEMENTS} USING (name)")
def labels(spark, sf):
    g = _saved(spark, sf, "commerce", *_HELD)
    return describe.labels(g).join(describe.element_counts(g).withColumnRenamed("label", "name"), "name", "left").select("labid", "name", "kind", "parent", "built_in", "elements")


_DECLARED = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}


@query("declared_properties", " UNION ALL ".join(f"SELECT 'customer' AS label, '{c}' AS name, '{t}' AS type, count({c})::BIGINT AS held, count(DISTINCT {c})::BIGINT AS different FROM customer" for c, t in _DECLARED.items()))
def declared_properties(spark, sf):
    g = _saved(spark, sf, "commerce", "customer")
    found = g.frame("customer").select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("v")) for c in _DECLARED))).alias("p")).select("p.*")
    return describe.declared_properties(g).join(found.groupBy("name").agg(F.count("v").alias("held"), F.count_distinct("v").alias("different")), "name").select("label", "name", "type", "held", "different")


@query("element_counts", " UNION ALL ".join(f"SELECT '{k}' AS label, count(*)::BIGINT AS elements FROM {t}" for k, t in _COUNTS.items()))
def element_counts(spark, sf):
    return describe.element_counts(graph(spark, sf, *_COUNTS).with_label("empty", "v"))


@query("triples", f"""
WITH {FOLLOWS_SQL} SELECT 'nation' AS start, 'in_region' AS edge, 'region' AS "end", count(*)::BIGINT AS edge_count FROM nation UNION ALL SELECT 'customer', 'lives_in', 'nation', count(*) FROM customer UNION ALL SELECT 'supplier', 'based_in', 'nation', count(*) FROM supplier
UNION ALL SELECT 'customer', 'placed', 'orders', count(*) FROM orders UNION ALL SELECT 'orders', 'contains', 'part', count(*) FROM lineitem UNION ALL SELECT 'part', 'supplied_by', 'supplier', count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
UNION ALL SELECT 'user', 'follows', 'user', count(*) FROM follows UNION ALL SELECT 'user', 'did', 'event', count(*) FROM events""")
def triples(spark, sf):
    return describe.triples(graph(spark, sf, *VERTEX_LABELS, *EDGE_LABELS))


@query("property_shapes", "SELECT 'event' AS label, 'event_id' AS name, 'integer' AS kind, TRUE AS declared UNION ALL SELECT 'event', 'event_type', 'string', TRUE UNION ALL SELECT 'event', 'value', 'float', TRUE UNION ALL SELECT 'event', 'k', CASE WHEN bool_or(contains(props->>'k', '.')) THEN 'float' ELSE 'integer' END, FALSE FROM events")
def property_shapes(spark, sf):
    return describe.property_shapes(graph(spark, sf, "event"), "event")


@query("property_shapes_sample", "SELECT 'event' AS label, 'k' AS name, CASE WHEN bool_or(contains(props->>'k', '.')) THEN 'float' ELSE 'integer' END AS kind FROM (SELECT props FROM events ORDER BY event_id LIMIT 100)")
def property_shapes_sample(spark, sf):
    return describe.property_shapes(graph(spark, sf, "event"), "event", 100).where("NOT declared").select("label", "name", "kind")


@query("describe", "SELECT 'counts' AS part, count(*)::BIGINT AS n FROM (SELECT 'nation' UNION ALL SELECT 'region' UNION ALL SELECT 'in_region' UNION ALL SELECT 'event') UNION ALL SELECT 'edges', count(*) FROM nation UNION ALL SELECT 'elements', (SELECT count(*) FROM nation) * 2 + (SELECT count(*) FROM region) + (SELECT count(*) FROM events) UNION ALL SELECT 'shapes', 9")
def describe_(spark, sf):
    d = describe.describe(graph(spark, sf, "region", "nation", "in_region", "event"))
    parts = [d.counts.agg(F.count("*")), d.triples.agg(F.sum("edge_count")), d.counts.agg(F.sum("elements")), d.shapes.agg(F.count("*"))]
    return reduce(DataFrame.unionAll, [p.toDF("n").select(F.lit(name).alias("part"), "n") for name, p in zip(("counts", "edges", "elements", "shapes"), parts, strict=True)])


@query("meta_is_current", "SELECT 'in_region' AS edge, count(*)::BIGINT AS edges, TRUE AS gathered, FALSE AS written_since FROM nation UNION ALL SELECT 'lives_in', count(*), TRUE, FALSE FROM customer UNION ALL SELECT 'placed', count(*), TRUE, FALSE FROM orders")
def meta_is_current(spark, sf):
    g, stored = describe.gather_triples(graph(spark, sf, "region", "nation", "customer", "orders", "in_region", "lives_in", "placed"))
    later = g.with_frame("nation", g.frames["nation"])
    return stored.groupBy("edge").agg(F.sum("edge_count").alias("edges")).select("edge", "edges", F.lit(describe.meta_is_current(g, stored)).alias("gathered"), F.lit(describe.meta_is_current(later, stored)).alias("written_since"))


@query("check_unique", "SELECT c_nationkey::VARCHAR AS c_nationkey, c_mktsegment, count(*)::BIGINT AS elements FROM customer GROUP BY ALL HAVING count(*) > 1")
def check_unique(spark, sf):
    return constraints.check_unique(graph(spark, sf, "customer"), "customer", "c_nationkey", "c_mktsegment")


@query("check_condition", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE NOT (quality = 1 OR n_chars < 3000)")
def check_condition(spark, sf):
    return constraints.check_condition(graph(spark, sf, "doc"), "doc", "quality = 1 OR n_chars < 3000").select("doc_id")


@query("check_endpoint_unique", f"SELECT {sid('orders', 'l_orderkey')} AS start, {sid('part', 'l_partkey')} AS \"end\", count(*)::BIGINT AS edges FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1")
def check_endpoint_unique(spark, sf):
    return constraints.check_endpoint_unique(graph(spark, sf, "contains"), "contains")


@query("check_referential", f"SELECT {sid('placed', 'o_orderkey')} AS id, 'start' AS side, {sid('customer', 'o_custkey')} AS missing FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 5")
def check_referential(spark, sf):
    g = graph(spark, sf, "customer", "orders", "placed")
    return constraints.check_referential(g.with_frame("customer", g.frames["customer"].where("c_nationkey <> 5")))


@query("ensure_labels", "SELECT o_orderpriority AS name, TRUE AS made, count(*)::BIGINT AS elements FROM orders GROUP BY ALL UNION ALL SELECT 'orders', FALSE, count(*) FROM orders")
def ensure_labels(spark, sf):
    """A label for each priority that the orders have, and one that is there already."""
    g = graph(spark, sf, "orders")
    held = g.frames["orders"].groupBy("o_orderpriority").agg(F.count("*").alias("elements")).withColumnRenamed("o_orderpriority", "name")
    wanted = [(r["name"], "v") for r in held.orderBy("name").limit(constraints.MOST_LABELS + 1).collect()] + [("orders", "v")]  # more than that many are refused
    g, made = constraints.ensure_labels(g, wanted)
    _, again = constraints.ensure_labels(g, wanted)
    assert not again
    counts = held.unionAll(g.frames["orders"].agg(F.count("*").alias("elements")).select(F.lit("orders"), "elements"))
    return counts.join(F.broadcast(g.catalog().select("name")), "name").select("name", F.col("name").isin(made).alias("made"), "elements")


@query("ensure_constraints", """
SELECT 'customer_c_custkey_unique' AS name, CASE WHEN count(*) = count(DISTINCT c_custkey) THEN 'create' ELSE 'refused' END AS action, (count(*) - count(DISTINCT c_custkey))::BIGINT AS broken FROM customer
UNION ALL SELECT 'customer_c_name_unique', CASE WHEN count(*) = count(DISTINCT c_name) THEN 'create' ELSE 'refused' END, (count(*) - count(DISTINCT c_name))::BIGINT FROM customer
UNION ALL SELECT 'customer_c_mktsegment_unique', CASE WHEN count(*) = count(DISTINCT c_mktsegment) THEN 'create' ELSE 'refused' END, (count(*) - count(DISTINCT c_mktsegment))::BIGINT FROM customer
UNION ALL SELECT 'solvent', CASE WHEN count(*) FILTER (NOT c_acctbal >= 0) = 0 THEN 'create' ELSE 'refused' END, count(*) FILTER (NOT c_acctbal >= 0) FROM customer
UNION ALL SELECT 'bounded', CASE WHEN count(*) FILTER (NOT c_acctbal >= -1000) = 0 THEN 'create' ELSE 'refused' END, count(*) FILTER (NOT c_acctbal >= -1000) FROM customer""")
def ensure_constraints(spark, sf):
    """Each constraint is made or refused by what the table holds, beside the number of elements that break it."""
    g = graph(spark, sf, "customer")
    wanted = [constraints.unique("customer", c) for c in ("c_custkey", "c_name", "c_mktsegment")] + [constraints.check("customer", "c_acctbal >= 0", "solvent"), constraints.check("customer", "c_acctbal >= -1000", "bounded")]
    out = []
    for c in wanted:
        try:
            g, done = constraints.ensure_constraints(g, [*g.constraints, c])
            action = dict((name, act) for act, name in done)[c.name]
        except ValueError:
            action = "refused"
        broken = constraints.check_unique(g, "customer", *c.keys).agg(F.coalesce(F.sum(F.col("elements") - 1), F.lit(0)).alias("broken")) if c.keys else constraints.check_condition(g, "customer", c.condition).agg(F.count("*").alias("broken"))
        out.append(broken.select(F.lit(c.name).alias("name"), F.lit(action).alias("action"), "broken"))
    return reduce(DataFrame.unionAll, out)


@query("promote_property", f"SELECT {sid('event', 'event_id')} AS id, (props->>'k')::BIGINT AS k FROM events")
def promote_property(spark, sf):
    return constraints.promote_property(graph(spark, sf, "event"), "event", "k", "bigint").frames["event"].select("id", "k")


@query("graph_save_load", "SELECT 'in_region' AS label, count(*)::BIGINT AS n FROM nation UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'region', count(*) FROM region")
def graph_save_load(spark, sf):
    from lattix.model import Graph
    from lattix.tables import shared_folder

    path = shared_folder(spark)
    graph(spark, sf, "region", "nation", "in_region").save(path)
    g = Graph.load(spark, "again", path)
    return reduce(DataFrame.unionAll, [g.frames[lab.name].agg(F.count("*").alias("n")).select(F.lit(lab.name).alias("label"), "n") for lab in g.labels])
