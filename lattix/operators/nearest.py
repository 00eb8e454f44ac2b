"""Nearest vectors: exact for one query or many, approximate by cells, and distances of sparse vectors."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lattix.functions import vectors
from lattix.tables import written

_BROADCAST = 64 << 20  # bytes of query vectors that travel to the tasks at once
#: Rows and queries that meet in one task, queries of them whose products are held at once, and pairs that are measured at once.
SLICE_ROWS, SLICE_QUERIES, AT_ONCE, MEASURED = 10_000, 10_000, 512, 50_000


def nearest(df: DataFrame, vector: str, query: Column | list[float], k: int, distance: str = "l2", id_: str = "id") -> DataFrame:
    """The k nearest rows with their distance; ties by id, NaN last. A top-k: no row is sorted beyond it."""
    probe = F.lit(query).cast("array<float>") if isinstance(query, list) else query
    return df.withColumn("distance", vectors.DISTANCES[distance](F.col(vector), probe)).orderBy(F.col("distance").asc_nulls_last(), F.col(id_)).limit(k)


def _few(own: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that hold every query's k nearest rows, told by bounds of the squared distance from a product of matrices."""
    a, b = own.astype(np.float64), rows.astype(np.float64)
    aa, bb = (a * a).sum(1), (b * b).sum(1)
    kind = np.float32 if max(aa.max(), bb.max()) < 1e30 else np.float64
    off = 4 * (own.shape[1] + 16) * float(np.finfo(kind).eps)  # beyond any rounding of the product and the sums, as a share of both lengths
    left, right = a.astype(kind), np.ascontiguousarray(b.astype(kind).T)
    low = left @ right
    low *= -2
    low += (bb * (1 - off)).astype(kind)
    low += (aa * (1 - off) - 1e-30).astype(kind)[:, None]
    some = low[:, : max(k, low.shape[1] // 8)]
    best = np.argpartition(some, k - 1, 1)[:, :k] if some.shape[1] > k else np.broadcast_to(np.arange(some.shape[1]), some.shape)
    reach = (np.take_along_axis(some, best, 1).astype(np.float64) + 4 * off * (aa[:, None] + bb[best]) + 4e-30).max(1)
    return np.nonzero(low <= reach[:, None].astype(kind)) if low.shape[1] > k else np.nonzero(np.ones(low.shape, np.bool_))


def _measured(own: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """As ``vectors.l2``, component by component."""
    return np.concatenate([np.sqrt(np.cumsum((rows[c : c + MEASURED].astype(np.float64) - own[c : c + MEASURED].astype(np.float64)) ** 2, 1)[:, -1]) for c in range(0, len(own), MEASURED)] or [np.zeros(0)])


def nearest_of(own: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the k nearest rows of each query; ties by the rows' order. Vectors are finite and of one width."""
    order = np.lexsort((np.arange(len(rows)), np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)))
    same = np.all(rows[order][1:] == rows[order][:-1], 1)
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(order)), 0))
    kept = np.sort(order[place < k])  # of equal rows the first k
    rows = rows[kept]
    out = []
    for begin in range(0, len(own), AT_ONCE):
        q, r = _few(own[begin : begin + AT_ONCE], rows, k)
        d = np.concatenate([_measured(own[begin + q[c : c + MEASURED]], rows[r[c : c + MEASURED]]) for c in range(0, len(q), MEASURED)])
        order = np.lexsort((r, d, q))
        q, r, d = q[order], r[order], d[order]
        first = np.searchsorted(q, q)
        best = np.arange(len(q)) - first < k
        out.append((begin + q[best], kept[r[best]], d[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _met(asked: DataFrame, held: DataFrame, k: int, slices: int, blocks: int, keys: list[str]) -> DataFrame:
    """(query_id, id, distance): k candidates of each query (query_id, query) from each slice of the rows (id, v) that agree in ``keys``."""
    kinds = {c: asked.schema[c].dataType.simpleString() for c in ("query_id",)} | {"id": held.schema["id"].dataType.simpleString()}
    left = asked.select("query_id", "query", *keys, F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"))
    right = held.select("id", "v", *keys, F.pmod(F.xxhash64("id"), F.lit(slices)).alias("slice"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def compared(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(rows):
            return pd.DataFrame({"query_id": own["query_id"].iloc[:0], "id": rows["id"].iloc[:0], "distance": np.zeros(0)})
        rows = rows.sort_values("id", kind="stable")
        q, r, d = nearest_of(np.stack(own["query"]), np.stack(rows["v"]), k)
        return pd.DataFrame({"query_id": own["query_id"].to_numpy()[q], "id": rows["id"].to_numpy()[r], "distance": d})

    group = [*keys, "slice", "block"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(compared, f"query_id {kinds['query_id']}, id {kinds['id']}, distance double")


def _plain(vector: Column, width: int) -> Column:
    """Whether a vector has that many components, all of them finite and of moderate size."""
    return F.coalesce((F.size(vector) == width) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= 1e100)), F.lit(False))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("distance").asc_nulls_last(), "id"))).where(F.col("rank") <= k)


def nearest_join(queries: DataFrame, df: DataFrame, vector: str, k: int, distance: str = "l2", id_: str = "id", block: int = 256) -> DataFrame:
    """(query_id, id, distance, rank) of the k nearest rows of each query (columns query_id, query).

    Slices of rows meet blocks of queries, each pair in one task: a product of matrices bounds all distances, and those that
    may be among the k least are measured exactly. Vectors that lack components, or have others that are not finite or another width, and
    distances other than l2, are measured pair by pair.
    """
    n, width = queries.agg(F.count("*"), F.max(F.size("query"))).first()
    if distance != "l2" or not n or not width or width < 1:
        return _pair_by_pair(queries, df, vector, k, distance, id_, block)
    held = df.select(F.col(id_).alias("id"), F.col(vector).alias("v"))
    fit, asked = _plain(F.col("v"), width), _plain(F.col("query"), width)
    rows, odd = held.agg(F.count_if(fit), F.count_if(~fit)).first()
    unfit = queries.where(~asked).count()
    slices, blocks = max(1, -(-rows // SLICE_ROWS)), max(1, -(-n // SLICE_QUERIES))
    found = [_met(queries.where(asked), held.where(fit), k, slices, blocks, [])]
    if odd:
        found.append(_pair_by_pair(queries.where(asked), held.where(~fit), "v", k, distance, "id", block).drop("rank"))
    if unfit:
        found.append(_pair_by_pair(queries.where(~asked), held, "v", k, distance, "id", block).drop("rank"))
    return _ranked(reduce(DataFrame.unionByName, found), k)


def _pair_by_pair(queries: DataFrame, df: DataFrame, vector: str, k: int, distance: str, id_: str, block: int) -> DataFrame:
    """Queries travel in blocks of about ``block``, at most 64 MB of them in one reading of the rows. A task keeps k candidates a query of
    its part before anything is shuffled, so only parts * k rows a query meet."""
    n, width = queries.agg(F.count("*"), F.max(F.size("query"))).first()
    at_once = max(block, _BROADCAST // (8 * max(1, width or 1)))
    rounds = max(1, -(-n // at_once))
    held = df.select(F.col(id_).alias("id"), F.col(vector).alias("__v")).withColumn("__part", F.spark_partition_id())
    order = (F.col("distance").asc_nulls_last(), F.col("id"))

    def found(asked: DataFrame) -> DataFrame:
        packed = asked.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-n // block)))).alias("__b")).agg(F.collect_list(F.struct("query_id", "query")).alias("__q"))
        pairs = held.crossJoin(F.broadcast(packed)).select("id", "__v", "__part", F.explode("__q").alias("__q")).select("__q.query_id", "id", "__part", vectors.DISTANCES[distance](F.col("__v"), F.col("__q.query")).alias("distance"))
        return pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "__part").orderBy(*order))).where(F.col("rank") <= k)

    own = reduce(DataFrame.unionAll, [found(queries.where(F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(rounds)) == r)) for r in range(rounds)])
    return own.drop("__part", "rank").withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)


def bounded_sample(asked: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` rows (id, v) that have a vector, chosen by hash of the id; rows are cut by hash first, so that tasks don't each offer as many."""
    share = min(1.0, 2 * sample / max(1, asked.count()))
    return asked.where("v IS NOT NULL").where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("id"), "id").limit(sample)


class Cells:
    """An index of ``lists`` cells around k-means centres: fitted on a bounded sample, every row assigned to a cell."""

    def __init__(self, df: DataFrame, vector: str, lists: int, id_: str = "id", sample: int = 20_000, seed: int = 7):
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        self.vector, self.id = vector, id_
        asked = df.select(F.col(id_).alias("id"), F.col(vector).alias("v"))
        some = bounded_sample(asked, sample).select(array_to_vector(F.col("v").cast("array<double>")).alias("features"))
        centers = KMeans(k=lists, seed=seed, maxIter=15).fit(some).clusterCenters()
        shape = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("center", T.ArrayType(T.FloatType()))])
        self.centers = [(i, [float(x) for x in c]) for i, c in enumerate(centers)]
        self.frame = df.sparkSession.createDataFrame(self.centers, shape)
        around = F.array(*[F.struct(vectors.l2(F.col("v"), F.lit(c).cast("array<float>")).alias("d"), F.lit(i).alias("cell")) for i, c in self.centers])
        self.rows = written(asked.withColumn("cell", F.array_min(around)["cell"]))

    def search(self, queries: DataFrame, k: int, probes: int, distance: str = "l2") -> DataFrame:
        """As ``nearest_join``, over the ``probes`` cells nearest to each query; all cells give the exact answer."""
        around = F.array(*[F.struct(vectors.l2(F.col("query"), F.lit(c).cast("array<float>")).alias("d"), F.lit(i).alias("cell")) for i, c in self.centers])
        asked = queries.select("query_id", "query", F.explode(F.slice(F.array_sort(around), 1, probes)).alias("c")).select("query_id", "query", "c.cell")
        joined = lambda q, r: q.join(r, "cell").select("query_id", "id", vectors.DISTANCES[distance](F.col("v"), F.col("query")).alias("distance"))
        if distance != "l2":
            return _ranked(joined(asked, self.rows), k)
        width = len(self.centers[0][1])
        fit, plain = _plain(F.col("v"), width), _plain(F.col("query"), width)
        sizes = self.rows.groupBy("cell").agg(F.count_if(fit).alias("n"), F.count_if(~fit).alias("odd")).agg(F.max("n"), F.sum("odd")).first()
        n, unfit = queries.agg(F.count("*"), F.count_if(~plain)).first()
        found = [_met(asked.where(plain), self.rows.where(fit), k, max(1, -(-(sizes[0] or 0) // SLICE_ROWS)), max(1, -(-n // SLICE_QUERIES)), ["cell"])]
        if sizes[1]:
            found.append(joined(asked.where(plain), self.rows.where(~fit)))
        if unfit:
            found.append(joined(asked.where(~plain), self.rows))
        return _ranked(reduce(DataFrame.unionByName, found), k)


def sparse_distance(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, l2, inner_product, cosine, l1) of pairs of sparse vectors, from their non-zero components alone."""
    def parts(name: str, out: str) -> DataFrame:
        return pairs.select(key, F.explode(F.arrays_zip(F.col(f"{name}.indices").alias("i"), F.col(f"{name}.values").alias("v"))).alias("e")).select(key, F.col("e.i").alias("i"), F.col("e.v").cast("double").alias(out))

    both = parts(a, "x").join(parts(b, "y"), [key, "i"], "full").select(key, F.coalesce("x", F.lit(0.0)).alias("x"), F.coalesce("y", F.lit(0.0)).alias("y"))
    sums = both.groupBy(key).agg(F.sum((F.col("x") - F.col("y")) ** 2).alias("sq"), F.sum(F.col("x") * F.col("y")).alias("dot"), F.sum(F.abs(F.col("x") - F.col("y"))).alias("l1"), F.sum(F.col("x") ** 2).alias("xx"), F.sum(F.col("y") ** 2).alias("yy"))
    names = ["sq", "dot", "l1", "xx", "yy"]
    sums = pairs.select(key).join(sums, key, "left").fillna(0.0, names)  # pairs of zeros have no component at all
    size = F.sqrt(F.col("xx")) * F.sqrt(F.col("yy"))
    return sums.select(key, F.sqrt("sq").alias("l2"), (0.0 - F.col("dot")).alias("inner_product"), F.when(size == 0, float("nan")).otherwise(1 - F.col("dot") / size).alias("cosine"), "l1")
