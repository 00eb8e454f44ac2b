"""Vectors over the driver's embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lattix.functions import vectors
from lattix.operators import constraints, nearest, vector_index
from lattix.plans.commerce import graph, sid, table, vertices
from lattix.plans.registry import query

_D = "list_transform({}, lambda x: x::DOUBLE)"
_PAIR = "WITH q AS (SELECT embedding AS qe FROM embeddings WHERE vec_id = 0), p AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a, list_transform(qe, lambda x: x::DOUBLE) AS b FROM embeddings, q) "


def _paired(spark, sf):
    e = vertices(spark, sf, "emb")
    return e.crossJoin(F.broadcast(e.where("vec_id = 0").select(F.col("embedding").alias("probe"))))


def _distance(name: str, sql: str) -> None:
    @query(f"distance_{name}", _PAIR + f"SELECT vec_id, round({sql}, 6) AS distance FROM p")
    def run(spark, sf):
        return _paired(spark, sf).select("vec_id", F.round(vectors.DISTANCES[name](F.col("embedding"), F.col("probe")), 6).alias("distance"))


_ZIP = "list_sum(list_transform(range(1, len(a) + 1), lambda i: {}))"
_distance("l2", f"sqrt({_ZIP.format('(a[i] - b[i]) * (a[i] - b[i])')})")
_distance("inner_product", f"-{_ZIP.format('a[i] * b[i]')}")
_distance("cosine", f"1 - {_ZIP.format('a[i] * b[i]')} / (sqrt({_ZIP.format('a[i] * a[i]')}) * sqrt({_ZIP.format('b[i] * b[i]')}))")
_distance("l1", _ZIP.format("abs(a[i] - b[i])"))


def _bit_distance(name: str, sql: str) -> None:
    @query(f"distance_{name}", _PAIR + f"SELECT vec_id, round({sql}, 6)::DOUBLE AS distance FROM p")
    def run(spark, sf):
        bits = lambda c: vectors.packed_bits(vectors.binary_quantize(F.col(c)))
        return _paired(spark, sf).select("vec_id", F.round(vectors.DISTANCES[name](bits("embedding"), bits("probe")).cast("double"), 6).alias("distance"))


_bit_distance("hamming", _ZIP.format("CASE WHEN (a[i] > 0) <> (b[i] > 0) THEN 1 ELSE 0 END"))
_bit_distance("jaccard", "1 - " + _ZIP.format("CASE WHEN a[i] > 0 AND b[i] > 0 THEN 1 ELSE 0 END") + "::DOUBLE / " + _ZIP.format("CASE WHEN a[i] > 0 OR b[i] > 0 THEN 1 ELSE 0 END"))


@query("binary_quantize", "SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS bits FROM embeddings")
def binary_quantize(spark, sf):
    return vertices(spark, sf, "emb").select("vec_id", vectors.binary_quantize(F.col("embedding")).alias("bits"))


@query("nearest", _PAIR + f"SELECT {sid('emb', 'vec_id')} AS id, round(d, 6) AS distance FROM (SELECT vec_id, sqrt({_ZIP.format('(a[i] - b[i]) * (a[i] - b[i])')}) AS d FROM p) ORDER BY d, vec_id LIMIT 10")
def nearest_(spark, sf):
    probe = vertices(spark, sf, "emb").where("vec_id = 0").select("embedding").first()[0]
    return nearest.nearest(vertices(spark, sf, "emb"), "embedding", [float(x) for x in probe], 10).select("id", F.round("distance", 6).alias("distance"))


def _queries(spark, sf):
    return table(spark, sf, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


_NEAREST = """
WITH q AS (SELECT vec_id AS query_id, list_transform(embedding, lambda x: x::DOUBLE) AS b FROM embeddings WHERE vec_id % 50 = 0), p AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a FROM embeddings),
d AS (SELECT query_id, vec_id, """ + f"sqrt({_ZIP.format('(a[i] - b[i]) * (a[i] - b[i])')})" + f""" AS d FROM q, p)
SELECT query_id, {sid('emb', 'vec_id')} AS id, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS r FROM d) WHERE r <= 5"""


@query("nearest_join", _NEAREST)
def nearest_join(spark, sf):
    return nearest.nearest_join(_queries(spark, sf), vertices(spark, sf, "emb"), "embedding", 5).select("query_id", "id", "rank")


def residual_index(spark, sf):
    """Eight rows a cell, up to 4,096 cells: vectors without any structure need many small ones."""
    e = vertices(spark, sf, "emb")
    lists = min(4096, max(8, e.count() // 8))
    return vector_index.ResidualIndex(e, "embedding", lists), max(1, lists * 21 // 200)


@query("nearest_ivf")
def nearest_ivf(spark, sf):
    index, probes = residual_index(spark, sf)
    return index.search(_queries(spark, sf), 5, probes)


@query("nearest_ivf_all_cells", _NEAREST)
def nearest_ivf_all_cells(spark, sf):
    """With every cell probed the index gives the exact rows."""
    cells = nearest.Cells(vertices(spark, sf, "emb").select(F.col("id"), "embedding"), "embedding", lists=8)
    return cells.search(_queries(spark, sf), 5, probes=8).select("query_id", "id", "rank")


@query("vector_from_property", "SELECT vec_id, len(embedding)::INT AS width, embedding[3]::DOUBLE AS third FROM embeddings")
def vector_from_property(spark, sf):
    v = vertices(spark, sf, "emb").select("vec_id", F.to_json("embedding").alias("p")).withColumn("v", vectors.vector_of(F.col("p"), 64))
    return v.select("vec_id", F.size("v").alias("width"), F.col("v")[2].cast("double").alias("third"))


@query("declare_vector", "SELECT vec_id, embedding[1]::DOUBLE AS first FROM embeddings")
def declare_vector(spark, sf):
    raw = vertices(spark, sf, "emb").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return vectors.declare_vector(raw, "v", 64).select("vec_id", F.col("v")[0].cast("double").alias("first"))


@query("half_precision", """
WITH e AS (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings), s AS (SELECT *, pow(2.0, greatest(floor(log2(abs(x))), -14) - 10) AS step FROM e WHERE x <> 0)
SELECT vec_id, i::INT AS place, round_even(x / step, 0) * step AS half FROM s UNION ALL SELECT vec_id, i::INT, 0.0 FROM e WHERE x = 0""")
def half_precision(spark, sf):
    halves = vertices(spark, sf, "emb").select("vec_id", F.posexplode(vectors.half_precision(F.col("embedding"))).alias("place", "half"))
    return halves.select("vec_id", (F.col("place") + 1).alias("place"), F.col("half").cast("double").alias("half"))


def _sparse(spark, sf):
    """Components beyond a tenth in size; the rest are zeros."""
    big = F.transform("embedding", lambda x: F.when(F.abs(x) > 0.1, x).otherwise(F.lit(0).cast("float")))
    return vertices(spark, sf, "emb").select("vec_id", big.alias("dense")).withColumn("s", vectors.sparse_from_dense(F.col("dense")))


_SPARSE = "WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN abs(x) > 0.1::FLOAT THEN x ELSE 0 END) AS d, list_filter(range(1, len(embedding) + 1), lambda i: abs(embedding[i]) > 0.1::FLOAT) AS pos FROM embeddings) "


@query("sparse_from_dense", _SPARSE + "SELECT vec_id, len(d)::INT AS dimensions, array_to_string(list_transform(pos, lambda i: i - 1), ',') AS indices, round(coalesce(list_sum(list_transform(pos, lambda i: d[i]::DOUBLE)), 0), 5) AS total FROM s")
def sparse_from_dense(spark, sf):
    total = F.aggregate("s.values", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return _sparse(spark, sf).select("vec_id", F.col("s.dimensions").alias("dimensions"), F.array_join(F.col("s.indices").cast("array<string>"), ",").alias("indices"), F.round(total, 5).alias("total"))


@query("sparse_to_dense", _SPARSE + "SELECT vec_id, len(d)::INT AS width, TRUE AS same FROM s")
def sparse_to_dense(spark, sf):
    back = vectors.sparse_to_dense(F.col("s"))
    return _sparse(spark, sf).select("vec_id", F.size(back).alias("width"), (back == F.col("dense")).alias("same"))


@query("sparse_to_text", _SPARSE + "SELECT vec_id, '{' || array_to_string(list_transform(pos, lambda i: i || ':' || CASE WHEN d[i] > 0 THEN '2' ELSE '-2' END), ',') || '}/' || len(d) AS text FROM s")
def sparse_to_text(spark, sf):
    signs = F.struct(F.col("s.dimensions").alias("dimensions"), F.col("s.indices").alias("indices"), F.transform("s.values", lambda v: F.when(v > 0, F.lit(2).cast("float")).otherwise(F.lit(-2).cast("float"))).alias("values"))
    return _sparse(spark, sf).select("vec_id", vectors.sparse_to_text(signs).alias("text"))


@query("sparse_from_text", _SPARSE + "SELECT vec_id, len(pos)::INT AS n, TRUE AS same FROM s")
def sparse_from_text(spark, sf):
    again = _sparse(spark, sf).withColumn("t", vectors.sparse_from_text(vectors.sparse_to_text(F.col("s"))))
    return again.select("vec_id", F.size("t.indices").alias("n"), ((F.col("t.indices") == F.col("s.indices")) & (F.col("t.values") == F.col("s.values"))).alias("same"))


@query("sparse_validate", _SPARSE + "SELECT vec_id, vec_id % 3 = 0 OR len(pos) = 0 AS valid FROM s")
def sparse_validate(spark, sf):
    """Of the table's own vectors every third as it is, one with its last component twice, one with that beyond its dimensions."""
    s = F.col("s")
    twice = F.struct(s["dimensions"].alias("dimensions"), F.concat(s["indices"], F.slice(s["indices"], -1, 1)).alias("indices"), F.concat(s["values"], F.slice(s["values"], -1, 1)).alias("values"))
    beyond = F.struct(F.element_at(s["indices"], -1).alias("dimensions"), s["indices"].alias("indices"), s["values"].alias("values"))
    made = F.when((F.col("vec_id") % 3 == 0) | (F.size(s["indices"]) == 0), s).when(F.col("vec_id") % 3 == 1, twice).otherwise(beyond)
    return _sparse(spark, sf).select("vec_id", vectors.sparse_is_valid(made).alias("valid"))


_S = "list_sum(list_transform(range(1, 65), lambda i: {}))"


@query("sparse_distance", _SPARSE.rstrip() + ", p AS (SELECT vec_id, list_transform(d, lambda x: x::DOUBLE) AS a, (SELECT list_transform(d, lambda x: x::DOUBLE) FROM s WHERE vec_id = 0) AS b FROM s) " + f"SELECT vec_id, round(sqrt({_S.format('(a[i] - b[i]) * (a[i] - b[i])')}), 5) AS l2, round(0.0 - {_S.format('a[i] * b[i]')}, 5) AS inner_product, round({_S.format('abs(a[i] - b[i])')}, 5) AS l1, round(1 - {_S.format('a[i] * b[i]')} / (sqrt({_S.format('a[i] * a[i]')}) * sqrt({_S.format('b[i] * b[i]')})), 5) AS cosine FROM p")
def sparse_distance(spark, sf):
    s = _sparse(spark, sf)
    pairs = s.select("vec_id", "s").crossJoin(F.broadcast(s.where("vec_id = 0").select(F.col("s").alias("q"))))
    return nearest.sparse_distance(pairs, "vec_id", "s", "q").select("vec_id", F.round("l2", 5).alias("l2"), F.round("inner_product", 5).alias("inner_product"), F.round("l1", 5).alias("l1"), F.round("cosine", 5).alias("cosine"))


@query("vector_sequence_ops", "SELECT vec_id, 64::INT AS dimension, embedding[2]::DOUBLE AS second, embedding[64]::DOUBLE AS last, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 5) AS total, list_contains(embedding, embedding[5]) AS holds, list_position(embedding, embedding[5])::BIGINT AS place, len(list_filter(embedding, lambda x: x = embedding[5]))::INT AS times FROM embeddings")
def vector_sequence_ops(spark, sf):
    v = F.col("embedding")
    return vertices(spark, sf, "emb").select(
        "vec_id", F.size(v).alias("dimension"), v[1].cast("double").alias("second"), F.slice(v, -1, 1)[0].cast("double").alias("last"), F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("total"),
        F.array_contains(v, v[4]).alias("holds"), F.array_position(v, v[4]).alias("place"), F.size(F.filter(v, lambda x: x == v[4])).alias("times"),
    )


@query("promoted_vector", f"SELECT {sid('emb', 'vec_id')} AS id, 64::INT AS width FROM embeddings")
def promoted_vector(spark, sf):
    g = graph(spark, sf, "emb")
    open_ = g.with_frame("emb", g.frames["emb"].select("id", F.to_json(F.struct("embedding")).alias("properties")))
    made = constraints.promote_property(open_, "emb", "embedding", "string").frames["emb"]
    return made.select("id", F.size(vectors.vector_of(F.col("embedding"), 64)).alias("width"))
