"""Projection, aggregation, order, unnesting and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lattix.functions import props
from lattix.operators import match, project
from lattix.sources import ingest
from lattix.plans.commerce import edges, sid, table, vertices
from lattix.plans.registry import query


@query("return_projection", "SELECT p_name AS name, p_retailprice * 2 + p_size AS score FROM part")
def return_projection(spark, sf):
    return vertices(spark, sf, "part").select(F.col("p_name").alias("name"), (F.col("p_retailprice") * 2 + F.col("p_size")).alias("score"))


@query("return_distinct", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def return_distinct(spark, sf):
    return vertices(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()


@query("return_distinct_elements", f"SELECT DISTINCT {sid('user', 'user_id')} AS id FROM events")
def return_distinct_elements(spark, sf):
    return project.distinct_elements(edges(spark, sf, "did").select(F.col("start").alias("id"))).select("id")


@query("count_star", "SELECT o_orderstatus, count(*)::BIGINT AS n FROM orders GROUP BY o_orderstatus")
def count_star(spark, sf):
    return vertices(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey)::BIGINT AS parts FROM lineitem GROUP BY l_returnflag")
def count_distinct(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))


@query("collect_by_group", "SELECT r_name, string_agg(n_name, ',' ORDER BY n_name) AS nations FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name")
def collect_by_group(spark, sf):
    hop = match.expand(edges(spark, sf, "in_region"), vertices(spark, sf, "nation"), vertices(spark, sf, "region"))
    return project.collect_by_group(hop, [F.col("b_r_name").alias("r_name")], F.col("a_n_name"), "nations", ",")


@query("with_chain", "SELECT c_mktsegment, count(*)::BIGINT AS rich FROM (SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100) WHERE c_acctbal > 9000 GROUP BY 1")
def with_chain(spark, sf):
    top = vertices(spark, sf, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(100)
    return top.where("c_acctbal > 9000").groupBy("c_mktsegment").agg(F.count("*").alias("rich"))


_ORDERED = "SELECT doc_id, quality::INT AS quality, row_number() OVER (ORDER BY quality {}, doc_id) AS place FROM documents LEFT JOIN labels USING (doc_id)"


@query("order_by_property", _ORDERED.format("ASC NULLS LAST"))
def order_by_property(spark, sf):
    return _placed(project.order_by(vertices(spark, sf, "doc"), ("quality", False), ("doc_id", False))).select("doc_id", F.col("quality").cast("int").alias("quality"), "place")


@query("order_by_property_desc", _ORDERED.format("DESC NULLS FIRST"))
def order_by_property_desc(spark, sf):
    return _placed(project.order_by(vertices(spark, sf, "doc"), ("quality", True), ("doc_id", False))).select("doc_id", F.col("quality").cast("int").alias("quality"), "place")


def _placed(ordered):
    """The place of every row, so that their order shows in a comparison without one."""
    numbered = ingest.with_serials(ordered.withColumn("at", F.monotonically_increasing_id()), ["at"], "place")
    return numbered.withColumn("place", F.col("place").cast("long"))


@query("order_by_element", f"SELECT id, row_number() OVER (ORDER BY lab DESC, k DESC) AS place FROM (SELECT {sid('part', 'p_partkey')} AS id, 7 AS lab, p_partkey AS k FROM part UNION ALL SELECT {sid('supplier', 's_suppkey')}, 6, s_suppkey FROM supplier)")
def order_by_element(spark, sf):
    both = vertices(spark, sf, "part").select("id").unionAll(vertices(spark, sf, "supplier").select("id"))
    return _placed(match.order_by_element(both, "id", True)).select("id", "place")


@query("skip_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15 OFFSET 20")
def skip_limit(spark, sf):
    return project.skip_limit(vertices(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey"), 20, 15).select("o_orderkey", "o_totalprice")


@query("unwind", "SELECT vec_id, i::INT - 1 AS place, embedding[i]::DOUBLE AS x FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def unwind(spark, sf):
    return project.unwind(vertices(spark, sf, "emb"), F.col("embedding"), "x", "place").select("vec_id", "place", F.col("x").cast("double").alias("x"))


@query("unwind_keys", "SELECT key, count(*)::BIGINT AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY key")
def unwind_keys(spark, sf):
    return project.unwind_keys(vertices(spark, sf, "event")).groupBy("key").agg(F.count("*").alias("n"))


@query("each_property", "SELECT event_id, 'k' AS key, props->>'k' AS value, 'number' AS kind FROM events")
def each_property(spark, sf):
    return props.each_property(vertices(spark, sf, "event").select("event_id", "properties")).select("event_id", "key", F.col("value"), "kind")


@query("generate_range", "SELECT n_nationkey, v::BIGINT AS value FROM nation, range(1, 6) t(v) WHERE v <= n_nationkey")
def generate_range(spark, sf):
    return vertices(spark, sf, "nation").join(project.generate_range(spark, 1, 5), F.col("value") <= F.col("n_nationkey")).select("n_nationkey", "value")


@query("let_binding", "SELECT o_orderkey, o_totalprice * 1.5 AS gross, o_totalprice * 1.5 > 100000 AS big FROM orders WHERE o_totalprice * 1.5 > 50000")
def let_binding(spark, sf):
    return project.let(vertices(spark, sf, "orders"), gross=F.col("o_totalprice") * 1.5, big=F.col("gross") > 100000).where("gross > 50000").select("o_orderkey", "gross", "big")


@query("logic_ops", """
SELECT doc_id, (quality = 1) <> (toxic = 1) AS either, (quality = 1) IS NULL AS unknown, nullif(lang, 'en') AS other_lang, CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 5000 THEN 'medium' ELSE 'long' END AS size
FROM documents LEFT JOIN labels USING (doc_id)""")
def logic_ops(spark, sf):
    good, bad = F.col("quality") == 1, F.col("toxic") == 1
    size = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 5000, "medium").otherwise("long")
    return vertices(spark, sf, "doc").select("doc_id", project.xor(good, bad).alias("either"), project.is_unknown(good).alias("unknown"), F.nullif("lang", F.lit("en")).alias("other_lang"), size.alias("size"))


def _two_reads(spark, sf):
    c = vertices(spark, sf, "customer")
    return c.where("c_acctbal > 5000").select("c_nationkey", "c_mktsegment"), c.where("c_mktsegment IN ('BUILDING', 'MACHINERY')").select("c_nationkey", "c_mktsegment")


_TWO = "SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 5000 {} SELECT c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"


@query("union_reads", _TWO.format("UNION"))
def union_reads(spark, sf):
    return project.union_reads(*_two_reads(spark, sf))


@query("intersect_reads", _TWO.format("INTERSECT"))
def intersect_reads(spark, sf):
    return project.intersect_reads(*_two_reads(spark, sf))


@query("except_reads", _TWO.format("EXCEPT"))
def except_reads(spark, sf):
    return project.except_reads(*_two_reads(spark, sf))
