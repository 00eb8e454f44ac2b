"""Approximate nearest vectors: cells, coded residuals, exact distances for the best of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lattix.functions import vectors
from lattix.operators.nearest import bounded_sample
from lattix.tables import shared_folder, written

#: Rows of a cell whose codes are compared in one task, and queries that meet them there.
SLICE_ROWS, SLICE_QUERIES = 50_000, 1_000
#: Rows whose distances to all centres are held at once: with 4,096 centres 8 MB a table.
NEAR_ROWS = 256


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches in runs of at most ``NEAR_ROWS`` rows, none of them empty."""
    for batch in batches:
        for a in range(0, len(batch), NEAR_ROWS):
            yield batch.iloc[a : a + NEAR_ROWS]


def _squares(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((rows * rows).sum(1)[:, None] - 2 * rows @ centers.T + (centers * centers).sum(1), 0)


def _fitted(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's centres of a bounded sample's parts; an entry that nothing is nearest to stays."""
    points = points[np.lexsort(points.T)]  # rows come in any order
    centers = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        near = _squares(points, centers).argmin(1)
        counts = np.bincount(near, minlength=len(centers))
        sums = np.stack([np.bincount(near, points[:, d], len(centers)) for d in range(points.shape[1])], 1)
        centers[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centers


class ResidualIndex:
    """Rows in the cells of their ``spill`` nearest centres, each with the code of what it differs by from that centre.

    Centres and codebooks (``entries`` for each of ``parts`` parts) are fitted on at most ``sample`` rows; every row with
    a vector is indexed, in a Parquet table partitioned by cell, so a search opens the cells it probes alone. A cell may have any number of rows: its
    codes are compared in slices. Vectors have the same number of components, which the parts divide.
    """

    def __init__(self, df: DataFrame, vector: str, lists: int, id_: str = "id", spill: int = 2, parts: int = 16, entries: int = 128, sample: int = 20_000, seed: int = 7):
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        asked = df.select(F.col(id_).alias("id"), F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL")
        some = written(bounded_sample(asked, sample))
        centers = np.array(KMeans(k=lists, seed=seed, maxIter=15).fit(some.select(array_to_vector("v").alias("features"))).clusterCenters())
        self.centers, self.spill, width = centers, spill, centers.shape[1] // parts
        key = df.schema[id_].dataType.simpleString()

        def residuals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in _cut(batches):
                v = np.stack(batch["v"])
                left = (v - centers[_squares(v, centers).argmin(1)]).reshape(len(v), parts, width)
                yield pd.DataFrame({"part": np.tile(np.arange(parts, dtype=np.int32), len(v)), "x": list(left.reshape(-1, width))})

        def fitted(own: pd.DataFrame) -> pd.DataFrame:
            found = _fitted(np.stack(own["x"]), entries)
            return pd.DataFrame({"part": own["part"].iloc[0], "entry": np.arange(len(found), dtype=np.int32), "x": list(found)})

        rows = some.select("v").mapInPandas(residuals, "part int, x array<double>").groupBy("part").applyInPandas(fitted, "part int, entry int, x array<double>").collect()  # as many numbers as the codebooks have
        books = np.zeros((parts, len(rows) // parts, width))  # every part has as many points
        for r in rows:
            books[r["part"], r["entry"]] = r["x"]
        self.books = books

        def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in _cut(batches):
                v = np.stack(batch["v"])
                near = np.argsort(_squares(v, centers), 1, kind="stable")[:, :spill]
                for s in range(near.shape[1]):
                    left = (v - centers[near[:, s]]).reshape(len(v), parts, width)
                    code = np.stack([_squares(left[:, p], books[p]).argmin(1) for p in range(parts)], 1).astype(np.uint8)
                    yield pd.DataFrame({"id": batch["id"], "v": batch["v"], "code": [c.tobytes() for c in code], "cell": near[:, s].astype(np.int32)})

        self.folder = shared_folder(df.sparkSession)
        schema = f"id {key}, v array<double>, code binary, cell int"
        asked.mapInPandas(coded, schema).hint("rebalance", "cell").write.partitionBy("cell").parquet(self.folder)
        self.rows = df.sparkSession.read.schema(schema).parquet(self.folder)
        self.sizes = {r["cell"]: r["n"] for r in self.rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row a cell

    def probed(self, queries: DataFrame, probes: int) -> DataFrame:
        """(query_id, query, cell) of the cells nearest to each query."""
        centers = self.centers

        def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in _cut(batches):
                near = np.argsort(_squares(np.stack(batch["query"]), centers), 1, kind="stable")[:, :probes]
                yield pd.DataFrame({"query_id": np.repeat(batch["query_id"].to_numpy(), near.shape[1]), "query": batch["query"].repeat(near.shape[1]), "cell": near.reshape(-1).astype(np.int32)})

        kind = queries.schema["query_id"].dataType.simpleString()
        return queries.select("query_id", F.col("query").cast("array<double>").alias("query")).where("query IS NOT NULL").mapInPandas(cells, f"query_id {kind}, query array<double>, cell int")

    def opened(self, asked: DataFrame) -> DataFrame:
        """The part of the table that a search opens: partitions of probed cells, of which there are at most as many as cells."""
        return self.rows.where(F.col("cell").isin([r["cell"] for r in asked.select("cell").distinct().collect()]))

    def share_read(self, queries: DataFrame, probes: int) -> float:
        """Rows of the cells that a query probes, as a share of all indexed rows, on average over the queries; a row in two probed cells counts twice."""
        read = self.probed(queries, probes).groupBy("query_id", "cell").count().collect()
        return sum(self.sizes.get(r["cell"], 0) for r in read) / max(1, len({r["query_id"] for r in read})) / max(1, sum(self.sizes.values()) / self.spill)

    def search(self, queries: DataFrame, k: int, probes: int, rerank: int = 100) -> DataFrame:
        """(query_id, id, distance, rank) of the k nearest rows of each query among those in its ``probes`` nearest cells.

        Codes of a cell meet the queries that probe it in slices of bounded size; distances come from a table of each part's
        entries. The ``rerank`` best of a query are then measured exactly. Ties by id.
        """
        books, centers, width = self.books, self.centers, self.books.shape[2]
        asked = written(self.probed(queries, probes))
        opened = self.opened(asked)
        slices = max(1, -(-max(self.sizes.values(), default=1) // SLICE_ROWS))
        blocks = max(1, -(-queries.count() // SLICE_QUERIES))
        kind, key = asked.schema["query_id"].dataType.simpleString(), self.rows.schema["id"].dataType.simpleString()
        left = asked.select("query_id", "query", "cell", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
        right = opened.select("id", "code", "cell", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("slice"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

        def compared(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            out = pd.DataFrame({"query_id": own["query_id"].iloc[:0], "id": rows["id"].iloc[:0], "cell": np.zeros(0, np.int32), "near": np.zeros(0)})
            if not len(own) or not len(rows):
                return out
            cell = int(own["cell"].iloc[0])
            codes = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
            found = [out]
            for query_id, query in zip(own["query_id"], own["query"], strict=True):
                table = ((books - (np.asarray(query) - centers[cell]).reshape(-1, 1, width)) ** 2).sum(2)
                near = table[np.arange(codes.shape[1])[None], codes].sum(1)
                best = np.argpartition(near, rerank - 1)[:rerank] if len(near) > rerank else np.arange(len(near))
                found.append(pd.DataFrame({"query_id": query_id, "id": rows["id"].to_numpy()[best], "cell": np.int32(cell), "near": near[best]}))
            return pd.concat(found, ignore_index=True)

        group = ["cell", "slice", "block"]
        met = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(compared, f"query_id {kind}, id {key}, cell int, near double")
        each = met.groupBy("query_id", "id").agg(F.min(F.struct("near", "cell")).alias("m")).select("query_id", "id", "m.near", "m.cell")
        best = each.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy("near", "id"))).where(F.col("r") <= rerank).select("query_id", "id", "cell")
        exact = opened.select("id", "cell", "v").join(best, ["id", "cell"]).join(queries.select("query_id", "query"), "query_id")
        measured = exact.select("query_id", "id", vectors.l2(F.col("v"), F.col("query")).alias("distance"))
        return measured.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("distance").asc_nulls_last(), "id"))).where(F.col("rank") <= k)
