"""What a graph holds: labels, counts, triples and the shapes of properties."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattix.functions import ids, props
from lattix.model import Graph
from lattix.tables import written


def graphs(*known: Graph) -> DataFrame:
    """Name, schema and number of labels of each graph, built-in ones included."""
    spark = known[0].spark
    rows = spark.createDataFrame([(g.name, g.name) for g in known], "name string, schema string")
    labels = reduce(DataFrame.unionAll, [g.catalog().select(F.lit(g.name).alias("name"), "labid") for g in known])
    return rows.join(labels.groupBy("name").agg(F.count("*").alias("labels")), "name", "left").select("name", "schema", F.coalesce("labels", F.lit(0).cast("long")).alias("labels"))


def labels(g: Graph) -> DataFrame:
    return g.catalog()


def declared_properties(g: Graph) -> DataFrame:
    """Promoted columns by label: name, type and whether it may be null."""
    rows = [(lab.name, f.name, f.dataType.simpleString(), f.nullable) for lab in g.labels for f in g.frames[lab.name].schema if f.name not in ("id", "start", "end", "properties", "label")]
    return g.spark.createDataFrame(rows, "label string, name string, type string, nullable boolean").orderBy("label", "name")


def _identities(g: Graph, kind: str | None = None, columns: tuple[str, ...] = ("id",)) -> DataFrame:
    """Nothing but identities of all labels: their maps are never read."""
    return reduce(DataFrame.unionAll, [g.frames[lab.name].select(*columns) for lab in g.labels if kind in (None, lab.kind)])


def element_counts(g: Graph) -> DataFrame:
    """(label, elements) from the ids alone; a label without elements is absent."""
    counted = _identities(g).groupBy(ids.labid(F.col("id")).alias("labid")).agg(F.count("*").alias("elements"))
    names = g.spark.createDataFrame([(lab.labid, lab.name) for lab in g.labels], "labid int, label string")
    return counted.join(F.broadcast(names), "labid").select("label", "elements")


def triples(g: Graph) -> DataFrame:
    """(start, edge, end, edge_count) of labels, from the edges' identities: no vertex is joined."""
    ends = _identities(g, "e", ("id", "start", "end"))
    parts = ends.groupBy(*[ids.labid(F.col(c)).alias(c) for c in ("start", "id", "end")]).agg(F.count("*").alias("edge_count"))
    names = F.broadcast(g.spark.createDataFrame([(lab.labid, lab.name) for lab in g.labels], "n int, name string"))
    for c in ("start", "id", "end"):
        parts = parts.join(names, F.col(c) == F.col("n"), "left").drop(c, "n").withColumnRenamed("name", c)
    return parts.select("start", F.col("id").alias("edge"), "end", "edge_count").orderBy(F.desc("edge_count"), "start", "edge", "end")


#: Kinds of promoted columns.
_KINDS = {"string": "string", "boolean": "boolean", "float": "float", "double": "float"}


def property_shapes(g: Graph, label: str, sample: int | None = None) -> DataFrame:
    """(label, name, kind, declared) of one label's properties.

    Numbers are float if any value has a point, else integer; of several kinds the alphabetically last holds;
    declared columns have the kind of their type. ``sample`` takes the elements with the smallest ids; all without it.
    """
    frame = g.frames[label]
    declared = [(label, f.name, _KINDS.get(f.dataType.simpleString(), "array" if f.dataType.simpleString().startswith("array") else "integer" if f.dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") else "float" if f.dataType.simpleString().startswith("decimal") else "string"), True) for f in frame.schema if f.name not in ("id", "start", "end", "properties", "label")]
    fixed = g.spark.createDataFrame(declared, "label string, name string, kind string, declared boolean")
    if "properties" not in frame.columns:
        return fixed
    some = frame.select("id", "properties")
    if sample is not None:
        some = some.orderBy(*ids.order(F.col("id"))).limit(sample)
    each = props.each_property(some)
    kinds = each.groupBy(F.col("key").alias("name")).agg(F.max("kind").alias("last"), F.max(F.when(F.col("kind") == "number", props.is_fractional(F.col("value"))).otherwise(False)).alias("fraction"))
    kind = F.when(F.col("last") == "number", F.when(F.col("fraction"), "float").otherwise("integer")).otherwise(F.col("last"))
    open_ = kinds.select(F.lit(label).alias("label"), "name", kind.alias("kind"), F.lit(False).alias("declared"))
    return fixed.unionAll(open_.join(fixed.select("name"), "name", "left_anti").select(fixed.columns))


@dataclass(frozen=True)
class Description:
    labels: DataFrame
    counts: DataFrame
    triples: DataFrame
    shapes: DataFrame
    current: bool


def gather_triples(g: Graph) -> tuple[Graph, DataFrame]:
    """The triples as a table, stamped with the graph's version."""
    return replace(g, triples_version=g.version), written(triples(g))


def meta_is_current(g: Graph, stored: DataFrame | None) -> bool:
    """Whether triples were gathered and nothing was written since; no edges and no triples count as gathered."""
    if stored is None or stored.isEmpty():
        return all(g.frames[lab.name].isEmpty() for lab in g.labels if lab.kind == "e")
    return g.triples_version == g.version


def describe(g: Graph, sample: int | None = None, stored: DataFrame | None = None) -> Description:
    shapes = reduce(DataFrame.unionAll, [property_shapes(g, lab.name, sample) for lab in g.labels])
    current = stored is not None and meta_is_current(g, stored)
    return Description(labels(g), element_counts(g), stored if current else triples(g), shapes, current or stored is None)
