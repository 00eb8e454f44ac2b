"""Columnar layouts of graph values, and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattix.functions import ids, props, vectors


def element_struct(edge: bool = False, identity: str = "text", properties: str = "json") -> Column:
    """id, label, (start, end,) properties as one struct; null where the element is null."""
    parts = [export_identity(F.col("id"), identity).alias("id"), F.col("label")]
    if edge:
        parts += [export_identity(F.col(c), identity).alias(c) for c in ("start", "end")]
    if properties == "json":
        parts.append(F.col("properties"))
    return F.when(F.col("id").isNotNull(), F.struct(*parts))


def export_columns(df: DataFrame, name: str, edge: bool = False, identity: str = "text") -> DataFrame:
    """The element spread over columns ``n.id``, ``n.label`` and so on."""
    parts = ["id", "label", *(["start", "end"] if edge else []), "properties"]
    return df.select(*[(export_identity(F.col(p), identity) if p in ("id", "start", "end") else F.col(p)).alias(f"{name}.{p}") for p in parts])


def export_identity(id_: Column, layout: str = "text") -> Column:
    """``3.1`` text, or the unsigned number."""
    return ids.format_id(id_) if layout == "text" else ids.unsigned(id_)


def export_identities(list_: Column, layout: str = "text") -> Column:
    return F.transform(list_, lambda x: export_identity(x, layout))


def export_properties(properties: Column, fields: dict[str, str] | None = None) -> Column:
    """JSON text, or the named fields as a struct of declared types; NaN is not read as a number."""
    if fields is None:
        return properties
    return F.from_json(properties, ", ".join(f"`{k}` {v}" for k, v in fields.items()), {"allowNonNumericNumbers": "false"})


def export_vectors(vector: Column, width: int | None = None) -> Column:
    """A fixed width, others refused, or lists of any; null stays null."""
    if width is None:
        return vector
    if width < 1:
        raise ValueError("a vector has a dimension at least")
    return F.when(vector.isNull() | (F.size(vector) == width), vector).otherwise(F.raise_error(F.lit(f"a vector of {width} was declared")))


def export_sparse(sparse: Column, layout: str = "parts") -> Column:
    """parts, ``{1:9}/3`` text, or dense."""
    return {"parts": lambda s: s, "text": vectors.sparse_to_text, "dense": vectors.sparse_to_dense}[layout](sparse)


def export_element_list(elements: Column, edge: bool = False, identity: str = "text") -> Column:
    """An array of elements, empty slots included, as a list of structs."""
    def one(e: Column) -> Column:
        parts = [export_identity(e["id"], identity).alias("id"), e["label"].alias("label")]
        if edge:
            parts += [export_identity(e[c], identity).alias(c) for c in ("start", "end")]
        return F.when(e.isNotNull(), F.struct(*parts, e["properties"].alias("properties")))

    return F.transform(elements, one)


def export_paths(df: DataFrame, name: str = "p", layout: str = "struct") -> DataFrame:
    """vertices and edges as one struct or two columns; other columns stay."""
    v, e = export_element_list(F.col("vertices")), export_element_list(F.col("edges"), edge=True)
    rest = [c for c in df.columns if c not in ("vertices", "edges")]
    if layout == "struct":
        return df.select(*rest, F.struct(v.alias("vertices"), e.alias("edges")).alias(name))
    return df.select(*rest, v.alias(f"{name}.vertices"), e.alias(f"{name}.edges"))


def export_with_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Names must be the schema's; a value that a column's type can't hold without loss fails."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if set(df.columns) != set(wanted.names) or len(df.columns) != len(wanted.names):
        raise ValueError(f"columns are {df.columns}, the schema has {wanted.names}")
    out = []
    for f in wanted:
        was = df.schema[f.name].dataType
        if was == f.dataType:
            out.append(F.col(f.name))
            continue
        cast = F.col(f.name).try_cast(f.dataType)
        lossless = F.col(f.name).isNull() | (cast.isNotNull() & (cast.cast(was).eqNullSafe(F.col(f.name))))
        out.append(F.when(lossless, cast).otherwise(F.raise_error(F.concat(F.lit(f"{f.name}: not a {f.dataType.simpleString()}: "), F.col(f.name).cast("string")))).alias(f.name))
    return df.select(out)


def export_typed_column(df: DataFrame, name: str) -> DataFrame:
    """A JSON column typed by its whole content: integers, floats, booleans, texts and lists of one such kind by type, maps and lists of maps as JSON text,
    mixtures as text."""
    value = F.try_parse_json(F.col(name))
    shape = df.agg(F.schema_of_variant_agg(value)).first()[0] or "VOID"
    simple = {"BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean", "STRING": "string"}
    if shape.startswith("DECIMAL"):
        return df.withColumn(name, F.try_variant_get(value, "$", "double"))
    if shape in simple:
        return df.withColumn(name, F.try_variant_get(value, "$", simple[shape]))
    inner = shape.removeprefix("ARRAY<").removesuffix(">")
    if shape.startswith("ARRAY<") and (inner in simple or inner.startswith("DECIMAL")):
        return df.withColumn(name, F.from_json(F.col(name), f"array<{simple.get(inner, 'double')}>"))
    return df


def write_chunked(df: DataFrame, path: str, rows: int = 8192, mode: str = "errorifexists") -> None:
    """Files of at most so many rows each, written by the executors."""
    df.write.mode(mode).option("maxRecordsPerFile", rows).parquet(path)


def _json_text(c: Column) -> Column:
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)


def _element_json(id_: Column, label: Column, properties: Column, ends: tuple[Column, ...] = ()) -> Column:
    parts = [F.lit('{"id":"'), ids.format_id(id_), F.lit('","label":'), _json_text(label)]
    for name, end in zip(("start", "end"), ends):
        parts += [F.lit(f',"{name}":"'), ids.format_id(end), F.lit('"')]
    return F.concat(*parts, F.lit(',"properties":'), F.coalesce(properties, F.lit("{}")), F.lit("}"))


def json_record(edge: bool = False) -> Column:
    """One line of JSON an element; the map goes in as it is."""
    return _element_json(F.col("id"), F.col("label"), F.col("properties"), (F.col("start"), F.col("end")) if edge else ())


def path_json(vertices: Column, edges: Column) -> Column:
    """A path of element lists as JSON; an empty slot is null, a path without lists too."""
    def listed(elements: Column, edge: bool) -> Column:
        one = lambda e: F.coalesce(_element_json(e["id"], e["label"], e["properties"], (e["start"], e["end"]) if edge else ()), F.lit("null"))
        return F.array_join(F.transform(elements, one), ",")

    return F.concat(F.lit('{"vertices":['), listed(vertices, False), F.lit('],"edges":['), listed(edges, True), F.lit("]}"))


def vector_json(vector: Column) -> Column:
    """A list of numbers."""
    return F.to_json(vector)


def sparse_json(sparse: Column) -> Column:
    """Dimensions, zero-based indices and values."""
    return F.to_json(F.struct(*[sparse[n].alias(n) for n in ("dimensions", "indices", "values")]))


def to_json_records(df: DataFrame, edge: bool = False, kind: str = "element", column: str | None = None) -> DataFrame:
    """A line of JSON a row: an element's, a path's (columns vertices, edges), or a vector's or sparse vector's."""
    if kind == "element":
        return df.select(json_record(edge).alias("value"))
    if kind == "path":
        return df.select(path_json(F.col("vertices"), F.col("edges")).alias("value"))
    made = {"vector": vector_json, "sparse": sparse_json}[kind]
    return df.select(made(F.col(column)).alias("value"))


def column_lists(df: DataFrame) -> DataFrame:
    """Plain columns: identities as text, maps parsed; names held twice are refused."""
    if len(set(df.columns)) < len(df.columns):
        raise ValueError(f"a column name is held twice: {df.columns}")
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        out.append((ids.format_id(c) if f.name in ("id", "start", "end") else props.fields(c) if f.name == "properties" else c).alias(f.name))
    return df.select(out)
