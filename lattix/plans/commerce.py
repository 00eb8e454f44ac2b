"""The driver's tables as a property graph, and how SQL names its identities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.functions import ids
from lattix.model import Graph

LABID = {"region": 3, "nation": 4, "customer": 5, "supplier": 6, "part": 7, "orders": 8, "in_region": 9, "lives_in": 10, "based_in": 11, "placed": 12, "contains": 13, "supplied_by": 14, "follows": 15, "emb": 16, "user": 17, "event": 18, "did": 19, "doc": 20}


def sid(label: str, key: str) -> str:
    """SQL of an identity: keys are counted from 0, serials from 1."""
    return f"({LABID[label] << 48} + {key} + 1)"


def _id(label: str, key: str) -> F.Column:
    return ids.pack(LABID[label], F.col(key).cast("long") + 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vertices(spark: SparkSession, sf: str, label: str) -> DataFrame:
    """Typed columns are promoted properties; events keep their map."""
    key = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey"}
    if label in key:
        t = table(spark, sf, label)
        return t.select(_id(label, key[label]).alias("id"), *t.columns)
    if label == "emb":
        return table(spark, sf, "embeddings").select(_id("emb", "vec_id").alias("id"), "vec_id", "embedding", F.col("label").alias("class"))
    if label == "user":
        return table(spark, sf, "events").select("user_id").distinct().select(_id("user", "user_id").alias("id"), "user_id")
    if label == "event":
        return table(spark, sf, "events").select(_id("event", "event_id").alias("id"), "event_id", "event_type", "value", F.col("props").alias("properties"))
    docs, marks = table(spark, sf, "documents"), table(spark, sf, "labels")
    return docs.join(marks, "doc_id", "left").select(_id("doc", "doc_id").alias("id"), "doc_id", "lang", "source", "n_chars", "quality", "toxic")


def edges(spark: SparkSession, sf: str, label: str) -> DataFrame:
    t = lambda name: table(spark, sf, name)
    if label == "in_region":
        return t("nation").select(_id(label, "n_nationkey").alias("id"), _id("nation", "n_nationkey").alias("start"), _id("region", "n_regionkey").alias("end"))
    if label == "lives_in":
        return t("customer").select(_id(label, "c_custkey").alias("id"), _id("customer", "c_custkey").alias("start"), _id("nation", "c_nationkey").alias("end"))
    if label == "based_in":
        return t("supplier").select(_id(label, "s_suppkey").alias("id"), _id("supplier", "s_suppkey").alias("start"), _id("nation", "s_nationkey").alias("end"))
    if label == "placed":
        return t("orders").select(_id(label, "o_orderkey").alias("id"), _id("customer", "o_custkey").alias("start"), _id("orders", "o_orderkey").alias("end"), "o_orderdate")
    if label == "contains":
        line = t("lineitem")
        return line.select(ids.pack(LABID[label], F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), _id("orders", "l_orderkey").alias("start"), _id("part", "l_partkey").alias("end"), "l_quantity", "l_extendedprice", "l_discount", "l_linenumber")
    if label == "supplied_by":
        return t("lineitem").select("l_partkey", "l_suppkey").distinct().select(ids.pack(LABID[label], F.col("l_partkey") * 1_000_000 + F.col("l_suppkey") + 1).alias("id"), _id("part", "l_partkey").alias("start"), _id("supplier", "l_suppkey").alias("end"))
    if label == "did":
        return t("events").select(_id(label, "event_id").alias("id"), _id("user", "user_id").alias("start"), _id("event", "event_id").alias("end"))
    # one user's view, then another's purchase: a graph over all events that grows with them, with few edges a user
    seen = t("events").where("event_type = 'view'").select("event_id", F.col("user_id").alias("a"))
    bought = t("events").where("event_type = 'purchase'").select((F.col("event_id") - 1).alias("event_id"), F.col("user_id").alias("b"))
    pairs = seen.join(bought, "event_id").groupBy("a", "b").agg(F.min("event_id").alias("first"))
    return pairs.select(_id(label, "first").alias("id"), _id("user", "a").alias("start"), _id("user", "b").alias("end"))


FOLLOWS_SQL = f"""
follows AS (SELECT {sid('follows', 'min(x.event_id)')} AS id, {sid('user', 'x.user_id')} AS s, {sid('user', 'y.user_id')} AS e FROM events x JOIN events y ON y.event_id = x.event_id + 1 WHERE x.event_type = 'view' AND y.event_type = 'purchase' GROUP BY x.user_id, y.user_id),
users AS (SELECT DISTINCT user_id, {sid('user', 'user_id')} AS id FROM events)
"""

VERTEX_LABELS = ("region", "nation", "customer", "supplier", "part", "orders", "emb", "user", "event", "doc")
EDGE_LABELS = ("in_region", "lives_in", "based_in", "placed", "contains", "supplied_by", "follows", "did")


def graph(spark: SparkSession, sf: str, *labels: str) -> Graph:
    """The graph with the named labels, or all; frames are lazy."""
    g = Graph(spark, "commerce")
    for name in sorted(labels or LABID, key=LABID.get):
        kind = "v" if name in VERTEX_LABELS else "e"
        g = g.with_label(name, kind, vertices(spark, sf, name) if kind == "v" else edges(spark, sf, name), labid=LABID[name])
    return g
