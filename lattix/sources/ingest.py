"""Bulk ingest of vertices and edges, and resolution of keys to identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattix.functions import ids, props
from lattix.model import Graph
from lattix.tables import written

#: Promoted columns of these types read as the map's text would; others are no keys.
_KEY_TYPES = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DoubleType, T.FloatType, T.BooleanType)


def numbered(df: DataFrame, order: list[str], name: str = "serial", start: int = 1) -> tuple[DataFrame, int]:
    """(rows with gap-free numbers in the order of the columns, how many there are); no task gathers the rows.

    Rows are dealt by range and numbered within their part; only the parts' sizes pass through the driver, one number each.
    The dealt rows are written first, so that sizes and numbers are of the same dealing.
    """
    dealt = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()))
    sizes = {r["p"]: r["n"] for r in dealt.groupBy(F.shiftright("__m", 33).alias("p")).agg(F.count("*").alias("n")).collect()}
    firsts, total = [], start
    for part in range(max(sizes, default=-1) + 1):
        firsts.append(str(total))
        total += sizes.get(part, 0)
    first = F.get(F.split(F.lit(",".join(firsts or ["0"])), ",").cast("array<bigint>"), F.shiftright("__m", 33).cast("int"))  # a constant
    return dealt.withColumn(name, first + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__m"), total - start


def with_serials(df: DataFrame, order: list[str], name: str = "serial", start: int = 1) -> DataFrame:
    """The rows of ``numbered``."""
    return numbered(df, order, name, start)[0]


def as_properties(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Each column a property, nulls as given; a lone text column called properties is the map itself; none is {}."""
    names = df.columns if columns is None else columns
    if names == ["properties"] and isinstance(df.schema["properties"].dataType, T.StringType):
        return F.coalesce(F.col("properties"), F.lit("{}"))
    if not names:
        return F.lit("{}")
    return F.to_json(F.struct(*[F.col(c) for c in names]), {"ignoreNullFields": "false"})


def next_serial(g: Graph, label: str) -> int:
    """One more than the greatest serial of the label; the scan reads ids alone."""
    return (g.frames[label].agg(F.max(ids.locid(F.col("id")))).first()[0] or 0) + 1


def _append(g: Graph, label: str, fresh: DataFrame, count: int) -> tuple[Graph, int]:
    return g.with_frame(label, g.frames[label].unionByName(fresh, allowMissingColumns=True)), count


def load_vertices(g: Graph, label: str, df: DataFrame, order: list[str], promoted: list[str] = ()) -> tuple[Graph, int]:
    """Appends one vertex per row; promoted columns stay typed, the rest goes into the map. An empty input gives 0."""
    lab = g.label(label)
    rows, count = numbered(df, order, "__serial", next_serial(g, label))
    rest = [c for c in df.columns if c not in promoted]
    return _append(g, label, rows.select(ids.pack(lab.labid, F.col("__serial")).alias("id"), as_properties(df, rest).alias("properties"), *promoted), count)


def load_edges(g: Graph, label: str, df: DataFrame, order: list[str]) -> tuple[Graph, int]:
    """Appends edges from start, end and properties; null properties become {}, a null endpoint fails."""
    lab = g.label(label)
    ends = [F.coalesce(F.col(c), F.raise_error(F.lit(f"{c}: an edge needs both ends"))).alias(c) for c in ("start", "end")]
    ready = df.select(*ends, F.coalesce("properties", F.lit("{}")).alias("properties"), *[F.col(c).alias(f"__by{k}") for k, c in enumerate(order)])
    rows, count = numbered(ready, [f"__by{k}" for k in range(len(order))], "__serial", next_serial(g, label))
    return _append(g, label, rows.select(ids.pack(lab.labid, F.col("__serial")).alias("id"), "start", "end", "properties"), count)


def load_vertex_frame(g: Graph, label: str, df: DataFrame, order: list[str]) -> tuple[Graph, int]:
    """Any columnar source; see ``as_properties``."""
    return load_vertices(g, label, df, order)


def endpoint(df: DataFrame, name: str) -> Column:
    """A packed integer or ``labid.locid`` text as an identity; null, malformed text and other types are refused."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        value = F.col(name).cast("long")
    elif isinstance(kind, T.DecimalType):
        value = F.when(F.col(name) >= F.lit(str(1 << 63)).cast("decimal(20,0)"), F.col(name) - F.lit(str(1 << 64)).cast("decimal(20,0)")).otherwise(F.col(name)).cast("long")
    elif isinstance(kind, T.StringType):
        value = ids.parse_id(F.col(name))
    else:
        raise TypeError(f"{name}: an identity is an integer or text, not {kind.simpleString()}")
    return F.coalesce(value, F.raise_error(F.lit(f"{name}: no identity")))


def load_edge_frame(g: Graph, label: str, df: DataFrame, order: list[str], start: str = "start", end: str = "end") -> tuple[Graph, int]:
    rest = [c for c in df.columns if c not in (start, end)]
    ready = df.select(endpoint(df, start).alias("start"), endpoint(df, end).alias("end"), as_properties(df, rest).alias("properties"), *[F.col(c).alias(f"__{k}") for k, c in enumerate(order)])
    return load_edges(g, label, ready, [f"__{k}" for k in range(len(order))])


def keyed(frame: DataFrame, key: str) -> DataFrame:
    """(key as text, id) of each element; a promoted key of a type that a map can't hold is refused."""
    if props.has_property(frame, key) and not isinstance(frame.schema[key].dataType, _KEY_TYPES):
        raise TypeError(f"{key}: a key is text, a number or a boolean, not {frame.schema[key].dataType.simpleString()}")
    return frame.select(props.key_text(props.prop(frame, key)).alias("key"), "id")


def key_problems(frame: DataFrame, key: str) -> DataFrame:
    """One row per key held twice or more, and one, with a null key, for elements that lack it."""
    return keyed(frame, key).groupBy("key").agg(F.count("*").alias("n")).where("n > 1 OR key IS NULL")


def identity_map(g: Graph, label: str, key: str) -> DataFrame:
    """(key as text, id); refuses keys held twice and elements without one, naming how many and up to five."""
    frame = g.frame(label)
    found = key_problems(frame, key)
    bad = found.groupBy(F.col("key").isNull().alias("lacking")).agg(F.sum("n").alias("elements"), F.count("*").alias("keys")).collect()
    if bad:
        some = [r["key"] for r in found.where("key IS NOT NULL").orderBy("key").limit(5).collect()]
        raise ValueError("; ".join(f"{r['elements']} elements lack {key}" if r["lacking"] else f"{r['keys']} keys are held more than once, such as {some}" for r in bad))
    return keyed(frame, key)


def identity_map_keys(g: Graph, label: str, asked: DataFrame, key: str) -> DataFrame:
    """Only the asked keys (column ``key``, any type): 1 and "1" both match, nulls and unknown keys are absent."""
    wanted = asked.select(props.key_text(F.col("key")).alias("key")).where("key IS NOT NULL")
    return keyed(g.frame(label), key).join(wanted, "key", "left_semi")


def resolve_edges(edges: DataFrame, sources: DataFrame, targets: DataFrame, src: str = "src_key", dst: str = "dst_key") -> tuple[DataFrame, DataFrame]:
    """Edges with identities for their keys, and the rows whose key is unknown."""
    held = edges.withColumn(src, props.key_text(F.col(src))).withColumn(dst, props.key_text(F.col(dst)))
    both = held.join(sources.select(F.col("key").alias(src), F.col("id").alias("start")), src, "left").join(targets.select(F.col("key").alias(dst), F.col("id").alias("end")), dst, "left")
    good = both.where("start IS NOT NULL AND end IS NOT NULL")
    return good, both.where("start IS NULL OR end IS NULL")


def scan_columnar(spark, source: object, format_: str = "parquet", **options) -> DataFrame:
    """A path that Spark reads, or an Arrow table, batch or reader, pandas frame or mapping of columns in memory."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, str):
        return spark.read.format(format_).options(**options).load(source)
    import pyarrow as pa

    if isinstance(source, dict):
        source = pa.table(source)
    elif isinstance(source, pa.RecordBatch):
        source = pa.Table.from_batches([source])
    elif isinstance(source, pa.RecordBatchReader):
        source = source.read_all()
    return spark.createDataFrame([Row(**r) for r in source] if isinstance(source, list) else source)
