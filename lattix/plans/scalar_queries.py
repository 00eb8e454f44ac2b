"""Scalar functions, streams and logs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lattix.functions import ids, props
from lattix.operators import describe, logs
from lattix.plans.commerce import LABID, edges, graph, sid, table, vertices
from lattix.plans.registry import query
from lattix.sources.store import LabelStore
from lattix.streaming import feeds
from lattix.tables import shared_folder


@query("graphid_parse", f"SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN {sid('customer', 'c_custkey')} WHEN 3 THEN 281474976710655 END AS id FROM customer")
def graphid_parse(spark, sf):
    good = ids.format_id(F.col("id"))
    text = F.when(F.col("c_custkey") % 5 == 0, good).when(F.col("c_custkey") % 5 == 1, F.concat(good, F.lit(".5"))).when(F.col("c_custkey") % 5 == 2, F.concat(F.lit("-"), good)).when(F.col("c_custkey") % 5 == 3, "0.281474976710655").otherwise("65536.1")
    return vertices(spark, sf, "customer").select("c_custkey", ids.parse_id(text).alias("id"))


@query("graphid_format", f"SELECT {LABID['orders']}::INT AS labid, o_orderkey + 1 AS locid, '{LABID['orders']}.' || (o_orderkey + 1) AS text, {sid('orders', 'o_orderkey')} AS packed FROM orders")
def graphid_format(spark, sf):
    i = F.col("id")
    return vertices(spark, sf, "orders").select(ids.labid(i).alias("labid"), ids.locid(i).alias("locid"), ids.format_id(i).alias("text"), ids.pack(ids.labid(i), ids.locid(i)).alias("packed"))


@query("element_accessors", f"SELECT {sid('did', 'event_id')} AS id, 'did' AS label, {sid('user', 'user_id')} AS start, {sid('event', 'event_id')} AS \"end\", 'k' AS keys, props AS properties FROM events")
def element_accessors(spark, sf):
    d = graph(spark, sf, "did").frame("did").join(vertices(spark, sf, "event").select(F.col("id").alias("end"), "properties"), "end")
    return d.select("id", "label", "start", "end", F.array_join(props.keys(F.col("properties")), ",").alias("keys"), "properties")


def _nested(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.to_json(F.struct(F.col("event_type").alias("t"), F.struct(F.struct(F.col("user_id").alias("c")).alias("b")).alias("a"), F.array(F.lit("x"), F.col("event_type")).alias("tags"))).alias("properties"))


@query("property", "SELECT event_id, event_type AS t, user_id::VARCHAR AS c, event_type AS second FROM events")
def property_(spark, sf):
    p = F.col("properties")
    return _nested(spark, sf).select("event_id", props.property_text(p, "t").alias("t"), props.nested(p, "a", "b", "c").alias("c"), props.nested(p, "tags", 1).alias("second"))


@query("size_range", "SELECT n_nationkey, 2::INT AS tags, array_to_string(range(1, n_nationkey + 2), ',') AS upto FROM nation")
def size_range(spark, sf):
    n = vertices(spark, sf, "nation").withColumn("p", F.to_json(F.array("n_name", F.lit("x"))))
    return n.select("n_nationkey", F.json_array_length("p").alias("tags"), F.array_join(F.sequence(F.lit(1), F.col("n_nationkey") + 1).cast("array<string>"), ",").alias("upto"))


@query("property_text", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN user_id || '.50' WHEN 1 THEN event_type WHEN 2 THEN ((user_id + 1) * 100)::VARCHAR END AS text FROM events")
def property_text(spark, sf):
    e = table(spark, sf, "events")
    number = lambda tail, more: F.concat(F.lit('{"v":'), (F.col("user_id") + more).cast("string"), F.lit(tail))
    p = F.when(F.col("event_id") % 4 == 0, number(".50}", 0)).when(F.col("event_id") % 4 == 1, F.to_json(F.struct(F.col("event_type").alias("v")))).when(F.col("event_id") % 4 == 2, number("e2}", 1)).otherwise('{"v":null}')
    return e.select("event_id", props.property_text(p, "v").alias("text"))


@query("json_kind", "SELECT event_id, ['string', 'number', 'boolean', 'null', 'array', 'object', NULL][event_id % 7 + 1] AS kind FROM events")
def json_kind(spark, sf):
    """Of each event's own values as a map, one key by turns; the last is in no map."""
    given = F.struct(F.col("event_type").alias("a"), F.col("value").alias("b"), (F.col("value") > 50).alias("c"), F.lit(None).cast("string").alias("d"), F.array("user_id").alias("e"), F.struct("user_id").alias("f"))
    held = table(spark, sf, "events").select("event_id", F.to_json(given, {"ignoreNullFields": "false"}).alias("p"))
    kind = F.lit(None).cast("string")
    for k, key in enumerate("abcdefg"):
        kind = F.when(F.col("event_id") % 7 == k, props.json_kind(F.col("p"), key)).otherwise(kind)
    return held.select("event_id", kind.alias("kind"))


@query("map_merge", "SELECT event_id, event_type AS t, 'new' AS k, user_id::VARCHAR AS u, 3::BIGINT AS n FROM events")
def map_merge(spark, sf):
    e = table(spark, sf, "events")
    merged = props.map_merge(F.to_json(F.struct(F.col("event_type").alias("t"), F.lit(1).alias("k"))), F.to_json(F.struct(F.lit("new").alias("k"), F.col("user_id").alias("u"))))
    m = F.col("m")
    return e.select("event_id", merged.alias("m")).select("event_id", *[props.property_text(m, k).alias(k) for k in ("t", "k", "u")], F.size(props.keys(m)).cast("long").alias("n"))


@query("json_is_object", "SELECT event_id, event_id % 5 = 0 OR event_id % 5 = 4 AS ok FROM events")
def json_is_object(spark, sf):
    forms = ["", '{"a":1}', "extra", "[1]", ""]
    tail = F.get(F.array(*map(F.lit, forms)), (F.col("event_id") % 5).cast("int"))
    p = F.when(F.col("event_id") % 5 == 3, "[1]").when(F.col("event_id") % 5 == 4, '{"a":"},{","b":{"c":[1]}}').otherwise(F.concat(F.col("props"), tail))
    return table(spark, sf, "events").select("event_id", props.is_object(p).alias("ok"))


@query("refuse_non_finite", "SELECT event_id, value FROM events")
def refuse_non_finite(spark, sf):
    return props.refuse_non_finite(table(spark, sf, "events").select("event_id", "value"), "value")


@query("numbers_exact", "SELECT event_id, (user_id || '.' || lpad(event_id::VARCHAR, 18, '0'))::DECIMAL(38,18)::VARCHAR AS v FROM events")
def numbers_exact(spark, sf):
    p = F.concat(F.lit('{"v":'), F.col("user_id").cast("string"), F.lit("."), F.lpad(F.col("event_id").cast("string"), 18, "0"), F.lit("}"))
    return table(spark, sf, "events").select("event_id", props.exact_number(p, "v").cast("string").alias("v"))


@query("key_spellings", "SELECT c_custkey, c_custkey % 3 <> 2 AS met FROM customer")
def key_spellings(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    spelled = F.when(F.col("c_custkey") % 3 == 2, F.concat(F.lit("0"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_custkey").cast("string"))
    asked = c.select(props.key_text(spelled).alias("key"), F.lit(True).alias("met"))
    return c.withColumn("key", props.key_text(F.col("c_custkey"))).join(asked, "key", "left").select("c_custkey", F.coalesce("met", F.lit(False)).alias("met"))


#: Rows of one file of a stream at most, or about: each is written and read by one task.
_FILE_ROWS = 250_000


def _stream(spark, df, name: str):
    """A frame as a stream of files, half of them a batch; there are as many as the rows need, four at least."""
    folder = shared_folder(spark)
    files = max(4, 2 * -(-df.count() // (2 * _FILE_ROWS)))
    df.repartition(files).write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files // 2).parquet(folder), shared_folder(spark)


@query("stream_upsert_vertices", "SELECT user_id::VARCHAR AS k, max(event_id)::VARCHAR AS top FROM events GROUP BY user_id")
def stream_upsert_vertices(spark, sf):
    tops = table(spark, sf, "events").groupBy(F.col("user_id").alias("k")).agg(F.max("event_id").alias("top"))
    stream, checkpoint = _stream(spark, tops, "users")
    store = LabelStore.create(spark, shared_folder(spark), 3, spark.createDataFrame([], "id long, properties string"))
    feeds.stored_vertex_feed(store, "k", ["k"]).start(stream, checkpoint).awaitTermination()
    p = F.col("properties")
    return store.frame().select(props.property_text(p, "k").alias("k"), props.property_text(p, "top").alias("top"))


@query("stream_upsert_edges", f"SELECT DISTINCT {sid('part', 'l_partkey')} AS start, {sid('supplier', 'l_suppkey')} AS \"end\" FROM lineitem")
def stream_upsert_edges(spark, sf):
    pairs = table(spark, sf, "lineitem").select(ids.pack(LABID["part"], F.col("l_partkey") + 1).alias("start"), ids.pack(LABID["supplier"], F.col("l_suppkey") + 1).alias("end"), F.lit(None).cast("string").alias("properties"))
    stream, checkpoint = _stream(spark, pairs, "pairs")
    store = LabelStore.create(spark, shared_folder(spark), 3, spark.createDataFrame([], "id long, start long, end long, properties string"))
    feeds.stored_edge_feed(store, ["start", "end"]).start(stream, checkpoint).awaitTermination()
    return store.frame().select("start", "end")


def _final(spark, counted, name: str):
    """The rows of a streaming count once all files are read."""
    table_name = f"{name}_{shared_folder(spark)[-8:]}"
    counted.writeStream.format("memory").queryName(table_name).outputMode("complete").option("checkpointLocation", shared_folder(spark)).trigger(availableNow=True).start().awaitTermination()
    return spark.table(table_name)


@query("stream_element_counts", f"SELECT {LABID['nation']}::INT AS labid, count(*)::BIGINT AS elements FROM nation UNION ALL SELECT {LABID['customer']}, count(*) FROM customer")
def stream_element_counts(spark, sf):
    g = graph(spark, sf, "nation", "customer")
    stream, _ = _stream(spark, describe._identities(g), "elements")
    return _final(spark, feeds.element_counts(stream), "counts")


@query("stream_triples", f"SELECT {LABID['customer']}::INT AS start_labid, {LABID['lives_in']}::INT AS edge_labid, {LABID['nation']}::INT AS end_labid, count(*)::BIGINT AS edge_count FROM customer UNION ALL SELECT {LABID['user']}, {LABID['did']}, {LABID['event']}, count(*) FROM events")
def stream_triples(spark, sf):
    both = edges(spark, sf, "lives_in").unionAll(edges(spark, sf, "did"))
    stream, _ = _stream(spark, both, "edges")
    return _final(spark, feeds.triples(stream), "triples")


#: What a failure of each kind of event stands for; lost connections have no code.
_CODES = {"view": "40001", "click": "57P01", "purchase": "23505", "signup": "08006", "error": "42P07"}
_LISTED = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _CODES.items())


@query("classify_failures", f"""
WITH f AS (SELECT CASE WHEN value > 20 THEN CASE event_type {_LISTED} ELSE '22012' END END AS sqlstate, user_id % 2 = 0 AS wrote, value > 60 AS merging FROM events)
SELECT recovery, count(*)::BIGINT AS n FROM (SELECT CASE
  WHEN sqlstate = '40001' THEN 'safe' WHEN sqlstate IS NULL OR sqlstate IN ('57P01', '08006') THEN CASE WHEN wrote THEN 'unknown' ELSE 'reconnect' END
  WHEN sqlstate IN ('23505', '42P07') AND merging THEN 'safe' ELSE 'fatal' END AS recovery FROM f) GROUP BY recovery""")
def classify_failures(spark, sf):
    state = F.lit("22012")
    for kind, code in _CODES.items():
        state = F.when(F.col("event_type") == kind, code).otherwise(state)
    f = table(spark, sf, "events").select(F.when(F.col("value") > 20, state).alias("sqlstate"), (F.col("user_id") % 2 == 0).alias("wrote"), (F.col("value") > 60).alias("merging"))
    return logs.classify_failures(f).groupBy("recovery").agg(F.count("*").alias("n"))


@query("statement_stats", "SELECT event_type AS statement, count(*)::BIGINT AS calls, count(*) FILTER (WHERE value > 90)::BIGINT AS failures, sum(user_id)::BIGINT AS rows, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type")
def statement_stats(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("statement"), F.col("value").alias("elapsed"), F.col("user_id").alias("rows"), (F.col("value") > 90).alias("failed"))
    return logs.statement_stats(e).select("statement", "calls", "failures", "rows", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))
