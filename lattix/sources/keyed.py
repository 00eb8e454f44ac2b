"""Stored access paths: keys to identities, and edges by their ends, so that a question reads little of a label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.functions import props
from lattix.sources.ingest import keyed

#: Asked keys up to which each is compared with the files' bounds and Bloom filters.
FEW_KEYS = 200


class KeyTable:
    """(key, id) of a label: dealt into folders by the key's hash, sorted by key, with a Bloom filter for each row group.

    Few asked keys open their own folders alone, and there the row groups whose bounds and filters may hold them. Many
    asked keys are joined.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.buckets = buckets
        self.rows = spark.read.schema("key string, id long, bucket int").parquet(path)

    @staticmethod
    def build(frame: DataFrame, key: str, path: str, buckets: int = 64, row_group_bytes: int = 1 << 20) -> KeyTable:
        """Keys are as ``identity_map`` has them: as text, elements without one left out. A folder is dealt to as many tasks as its size asks for."""
        own = keyed(frame, key).where("key IS NOT NULL").select("key", "id", _bucket(F.col("key"), buckets).alias("bucket"))
        dealt = own.hint("rebalance", "bucket").sortWithinPartitions("bucket", "key")
        dealt.write.option("parquet.bloom.filter.enabled#key", "true").option("parquet.block.size", row_group_bytes).partitionBy("bucket").parquet(path)
        return KeyTable(frame.sparkSession, path, buckets)

    def lookup(self, asked: DataFrame) -> DataFrame:
        """(key, id) of the asked keys (column ``key``, any type): 1 and "1" both match, nulls and unknown keys are absent."""
        wanted = asked.select(props.key_text(F.col("key")).alias("key")).where("key IS NOT NULL").distinct()
        few = [r["key"] for r in wanted.limit(FEW_KEYS + 1).collect()]
        if len(few) > FEW_KEYS:
            return self.rows.join(wanted.withColumn("bucket", _bucket(F.col("key"), self.buckets)), ["bucket", "key"], "left_semi").select("key", "id")
        return self.few(few).select("key", "id")

    def few(self, keys: list[str]) -> DataFrame:
        """The rows of these keys; what is asked of the files is a plain comparison for each, which bounds and filters can answer."""
        if not keys:
            return self.rows.where("false")
        spark = self.rows.sparkSession
        held = spark.createDataFrame([(k,) for k in keys], "key string").select(_bucket(F.col("key"), self.buckets).alias("b")).distinct().collect()
        return self.rows.where(F.col("bucket").isin([r["b"] for r in held]) & _any([F.col("key") == k for k in keys]))


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _any(conditions: list[Column]) -> Column:
    """One of them, as a flat tree, however many there are."""
    while len(conditions) > 1:
        conditions = [reduce(lambda a, b: a | b, conditions[k : k + 2]) for k in range(0, len(conditions), 2)]
    return conditions[0]


class EdgeTable:
    """Edges as a table of the catalog, bucketed and sorted by their start, or by both ends: joins on these don't deal the stored side again."""

    def __init__(self, spark: SparkSession, name: str, by: tuple[str, ...], buckets: int):
        self.rows, self.by, self.buckets = spark.table(name), by, buckets

    @staticmethod
    def build(edges: DataFrame, name: str, by: tuple[str, ...] = ("start",), buckets: int = 64) -> EdgeTable:
        edges.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy("start", "end").format("parquet").mode("overwrite").saveAsTable(name)
        return EdgeTable(edges.sparkSession, name, by, buckets)

    def between(self, pairs: DataFrame) -> DataFrame:
        """(start, end, id) of edges between the given pairs; only these three columns are read. Bucketed by both ends, only the pairs are shuffled."""
        asked = pairs.select("start", "end").distinct()
        return self.rows.select("start", "end", "id").join(asked.repartition(self.buckets, *self.by), ["start", "end"], "left_semi")

    def out_of(self, starts: DataFrame) -> DataFrame:
        """The edges that begin at the given vertices (column ``id``). Bucketed by start, only the vertices are shuffled."""
        return self.rows.join(starts.select(F.col("id").alias("start")).distinct(), "start", "left_semi")
