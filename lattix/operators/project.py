"""Projection, aggregation, order, unnesting and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.functions import props


def distinct_elements(df: DataFrame, id_: str = "id") -> DataFrame:
    """Elements are equal if their identities are, whatever else they hold."""
    return df.dropDuplicates([id_])


def collect_by_group(df: DataFrame, by: list[str], value: Column, name: str, separator: str | None = None) -> DataFrame:
    """Values of each group, sorted, as a list or joined to a text."""
    got = F.array_sort(F.collect_list(value))
    return df.groupBy(*by).agg((F.array_join(got, separator) if separator is not None else got).alias(name))


def order_by(df: DataFrame, *keys: tuple[str, bool]) -> DataFrame:
    """Keys with descending or not; nulls last ascending, first descending."""
    return df.orderBy(*[F.col(k).desc_nulls_first() if down else F.col(k).asc_nulls_last() for k, down in keys])


def skip_limit(df: DataFrame, skip: int, limit: int) -> DataFrame:
    return df.offset(skip).limit(limit)


def unwind(df: DataFrame, values: Column, name: str, offset: str | None = None) -> DataFrame:
    """A row per value of a list; its zero-based place if asked for."""
    return df.select("*", F.posexplode(values).alias(offset, name)) if offset else df.select("*", F.explode(values).alias(name))


def unwind_keys(df: DataFrame, properties: str = "properties", name: str = "key") -> DataFrame:
    return df.select("*", F.explode(props.keys(F.col(properties))).alias(name))


def generate_range(spark: SparkSession, first: int, last: int, step: int = 1) -> DataFrame:
    """Integers from first to last, both included."""
    return spark.range(first, last + (1 if step > 0 else -1), step).withColumnRenamed("id", "value")


def let(df: DataFrame, **bindings: Column) -> DataFrame:
    for name, value in bindings.items():
        df = df.withColumn(name, value)
    return df


def xor(a: Column, b: Column) -> Column:
    """Null if either is unknown."""
    return a != b


def is_unknown(a: Column) -> Column:
    return a.isNull()


def union_reads(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def intersect_reads(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_reads(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)
