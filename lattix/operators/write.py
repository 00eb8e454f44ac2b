"""Writes as functions: a graph and rows give a new graph and counts. One writer a label at a time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattix.functions import ids, props
from lattix.model import Graph
from lattix.sources.ingest import as_properties, key_problems, next_serial, numbered
from lattix.tables import written


#: Elements whose maps one task reads and writes.
_ROWS = 20_000


@dataclass(frozen=True)
class Counts:
    """What a write did; plans always know, so none is missing."""

    inserted_vertices: int = 0
    inserted_edges: int = 0
    deleted_vertices: int = 0
    deleted_edges: int = 0
    updated_properties: int = 0

    @property
    def total(self) -> int:
        return self.inserted_vertices + self.inserted_edges + self.deleted_vertices + self.deleted_edges + self.updated_properties

    def frame(self, g: Graph) -> DataFrame:
        return g.spark.createDataFrame([tuple(self.__dict__.values())], "inserted_vertices long, inserted_edges long, deleted_vertices long, deleted_edges long, updated_properties long")


def create_vertices(g: Graph, label: str, df: DataFrame, order: list[str]) -> tuple[Graph, Counts]:
    """New vertices; a property given as null is not stored."""
    lab = g.label(label)
    rows, count = numbered(df, order, "__serial", next_serial(g, label))
    fresh = rows.select(ids.pack(lab.labid, F.col("__serial")).alias("id"), F.to_json(F.struct(*df.columns)).alias("properties"))
    return g.with_frame(label, g.frames[label].unionByName(fresh, allowMissingColumns=True)), Counts(inserted_vertices=count)


def unique_on(g: Graph, label: str, *keys: str) -> bool:
    """Whether a declared constraint makes the key, or for edges the pair of ends, unique."""
    return any(c.kind == "unique" and c.label == label and tuple(c.keys) == keys for c in g.constraints)


def guard(g: Graph, label: str, keys: tuple[str, ...], on_existing: str, require_unique: bool) -> None:
    if on_existing not in ("skip", "update"):
        raise ValueError("on_existing is skip or update")
    if require_unique and not unique_on(g, label, *keys):
        raise ValueError(f"nothing makes {', '.join(keys)} unique on {label}; declare it, or pass require_unique=False")


def _null_key(df: DataFrame, *names: str) -> None:
    bad = F.lit(False)
    for n in names:
        bad = bad | F.col(n).isNull()
    if not df.where(bad).isEmpty():
        raise ValueError(f"rows without {' or '.join(names)}")


def upsert_vertices(g: Graph, label: str, df: DataFrame, key: str, order: list[str], on_existing: str = "skip", require_unique: bool = True) -> tuple[Graph, int, int]:
    """(graph, inserted, updated). Rows whose key text is new are inserted, each of them even if they repeat; of the
    rest, ``update`` lays the given properties over the stored ones (the last row in ``order``, if several name one
    key) and counts rows, ``skip`` does nothing.
    """
    guard(g, label, (key,), on_existing, require_unique)
    if key not in df.columns:
        raise ValueError(f"no column {key}")
    lab, frame = g.label(label), g.frames[label]
    if not key_problems(frame, key).isEmpty():
        raise ValueError(f"{key} of {label}: a key is held twice, or an element has none")
    held = frame.select(props.key_text(props.prop(frame, key)).alias("__key"), F.col("id").alias("__id"))
    # the rows meet the stored keys once; what follows reads that table
    met = written(df.withColumn("__key", props.key_text(F.col(key))).join(held, "__key", "left"))
    lacking, known = met.agg(F.count_if(F.col("__key").isNull()), F.count("__id")).first()
    if lacking:
        raise ValueError(f"rows without {key}")
    promoted = [c for c in frame.columns if c not in ("id", "properties")]
    rest = [c for c in df.columns if c not in promoted]
    rows, inserted = numbered(met.where("__id IS NULL").select(df.columns), order, "__serial", next_serial(g, label))
    fresh = rows.select(ids.pack(lab.labid, F.col("__serial")).alias("id"), as_properties(df, rest).alias("properties"), *[c for c in promoted if c in df.columns])
    updated, result = 0, frame
    if on_existing == "update" and known:
        over, updated = met.where("__id IS NOT NULL"), known
        last = over.groupBy("__id").agg(F.max_by(as_properties(df, rest), F.struct(*order)).alias("__new"), *[F.max_by(F.struct(F.col(c)), F.struct(*order))[c].alias(f"__p_{c}") for c in promoted if c in df.columns])
        both = frame.join(last, frame["id"] == last["__id"], "left")
        values = [F.when(F.col("__id").isNotNull(), props.map_merge(F.col("properties"), F.col("__new"))).otherwise(F.col("properties")).alias("properties") if c == "properties" else F.when(F.col("__id").isNotNull(), F.col(f"__p_{c}")).otherwise(F.col(c)).alias(c) if c in promoted and c in df.columns else F.col(c) for c in frame.columns]
        result = both.select(values)
    return g.with_frame(label, result.unionByName(fresh, allowMissingColumns=True)), inserted, updated


def upsert_edges(g: Graph, label: str, df: DataFrame, order: list[str], on_existing: str = "skip", require_unique: bool = True) -> tuple[Graph, int, int]:
    """Keyed by (start, end): a pair that is repeated is written once, its first row winning. Rows with no properties
    are no updates and are not counted."""
    guard(g, label, ("start", "end"), on_existing, require_unique)
    _null_key(df, "start", "end")
    lab, frame = g.label(label), g.frames[label]
    held = frame.select("start", "end")
    by, first = F.struct(*order), F.min_by(F.struct("properties"), F.struct(*order))["properties"].alias("__first")
    if on_existing == "update":
        # the rows of a pair are one row when they meet the stored edges, once; what follows reads that table
        own = F.col("properties").isNotNull() & (F.col("properties") != "{}")
        given = df.groupBy("start", "end").agg(first, F.max_by(F.when(own, F.col("properties")), F.when(own, by)).alias("__new"), F.count_if(own).alias("__n"))
        stored = frame.select(F.col("start").alias("__s"), F.col("end").alias("__e"), F.struct(*frame.columns).alias("__old"))
        met = written(given.join(stored, (F.col("start") == F.col("__s")) & (F.col("end") == F.col("__e")), "full").drop("__s", "__e"))
        updated = met.where("__old IS NOT NULL").agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
        new = met.where("__old IS NULL").select("start", "end", F.col("__first").alias("properties"))
        old = F.col("__old.properties")
        merged = F.when(F.col("__new").isNotNull(), props.map_merge(old, F.col("__new"))).otherwise(old)
        result = met.where("__old IS NOT NULL").select([merged.alias(c) if c == "properties" else F.col(f"__old.{c}").alias(c) for c in frame.columns])
    else:
        new = df.groupBy("start", "end").agg(first).join(held, ["start", "end"], "left_anti").withColumnRenamed("__first", "properties")
        updated, result = 0, frame
    rows, inserted = numbered(new, ["start", "end"], "__serial", next_serial(g, label))
    fresh = rows.select(ids.pack(lab.labid, F.col("__serial")).alias("id"), "start", "end", F.coalesce("properties", F.lit("{}")).alias("properties"))
    return g.with_frame(label, result.unionByName(fresh, allowMissingColumns=True)), inserted, updated


def merge_vertices(g: Graph, label: str, df: DataFrame, key: str, order: list[str]) -> tuple[Graph, Counts]:
    """Match on the key or create, and set the given properties."""
    g, inserted, updated = upsert_vertices(g, label, df, key, order, "update", require_unique=False)
    return g, Counts(inserted_vertices=inserted, updated_properties=updated)


def merge_edges(g: Graph, label: str, pairs: DataFrame) -> tuple[Graph, Counts]:
    """(a)-[:label]->(b): match or create."""
    g, inserted, _ = upsert_edges(g, label, pairs.select("start", "end", F.lit(None).cast("string").alias("properties")), ["start", "end"], "skip", require_unique=False)
    return g, Counts(inserted_edges=inserted)


def _with_properties(frame: DataFrame, properties: Column) -> DataFrame:
    """The frame with another map. A generated column is computed once, however many writes come after it."""
    return frame.select(*[F.explode(F.array(properties)).alias(c) if c == "properties" else F.col(c) for c in frame.columns])


def _spread(frame: DataFrame) -> DataFrame:
    """The frame in parts of about ``_ROWS`` elements: a small file of many short maps would be one task's work."""
    parts = -(-frame.count() // _ROWS)
    return frame.repartition(parts, "id") if parts > 1 else frame


def _count(frame: DataFrame, hit: Column) -> int:
    """How many elements it holds for. A generated column stays above the shuffle that spreads them, where a filter would be moved below it."""
    return frame.select(F.explode(F.array(hit)).alias("hit")).where("hit").count()


def set_properties(g: Graph, label: str, where: Column, values: Column, replace_all: bool = False) -> tuple[Graph, Counts]:
    """``+=`` a map, or with ``replace_all`` ``=`` it, where the condition holds."""
    frame = _spread(g.frames[label])
    hit = F.coalesce(where, F.lit(False))
    new = values if replace_all else props.map_merge(F.col("properties"), values)
    n = _count(frame, hit)
    return g.with_frame(label, _with_properties(frame, F.when(hit, new).otherwise(F.col("properties")))), Counts(updated_properties=n)


def remove_property(g: Graph, label: str, where: Column, key: str) -> tuple[Graph, Counts]:
    frame = _spread(g.frames[label])
    hit = F.coalesce(where, F.lit(False)) & F.array_contains(props.keys(F.col("properties")), key)
    n = _count(frame, hit)
    return g.with_frame(label, _with_properties(frame, F.when(hit, props.without_key(F.col("properties"), key)).otherwise(F.col("properties")))), Counts(updated_properties=n)


def delete_vertices(g: Graph, label: str, doomed: DataFrame, detach: bool = False) -> tuple[Graph, Counts]:
    """Removes the vertices with these ids; ``detach`` their edges too, otherwise edges that remain refuse it."""
    frame = g.frames[label]
    gone = written(frame.select("id").join(doomed.select("id"), "id", "left_semi"))
    n, edges = gone.count(), 0
    for lab in (x for x in g.labels if x.kind == "e"):
        held = g.frames[lab.name]
        starts, ends = gone.withColumnRenamed("id", "start"), gone.withColumnRenamed("id", "end")
        left = held.join(starts, "start", "left_anti").join(ends, "end", "left_anti").select(held.columns)
        lost = held.count() - left.count()
        if lost and not detach:
            raise ValueError(f"{lost} edges of {lab.name} still meet these vertices")
        if lost:
            g, edges = g.with_frame(lab.name, left), edges + lost
    return g.with_frame(label, frame.join(gone, "id", "left_anti").select(frame.columns)), Counts(deleted_vertices=n, deleted_edges=edges)


def delete_edges(g: Graph, label: str, doomed: DataFrame) -> tuple[Graph, Counts]:
    frame = g.frames[label]
    left = frame.join(doomed.select("id"), "id", "left_anti").select(frame.columns)
    return g.with_frame(label, left), Counts(deleted_edges=frame.count() - left.count())
