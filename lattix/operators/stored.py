"""Writes to a stored label that store what they change: upserts, properties, deletions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattix.functions import ids, props
from lattix.sources.ingest import as_properties, numbered
from lattix.sources.store import LabelStore
from lattix.tables import written


def _promoted(store: LabelStore) -> list[str]:
    return [c for c in store.schema.names if c not in ("id", "start", "end", "properties")]


def upsert_vertices(store: LabelStore, df: DataFrame, key: str, order: list[str], on_existing: str = "skip", feed: str | None = None, batch: int = 0) -> tuple[int, int]:
    """(inserted, updated), as ``write.upsert_vertices`` does it; a batch that its feed has written does nothing and tells what it did.

    The rows meet the stored keys once. New vertices and vertices whose properties change are written, no others are. A
    key of the rows that is held twice is refused; keys that no row names are not looked at.
    """
    if feed is not None and (done := store.written_by(feed, batch)) is not None:
        return done
    if on_existing not in ("skip", "update"):
        raise ValueError("on_existing is skip or update")
    if key not in df.columns:
        raise ValueError(f"no column {key}")
    frame = store.frame()
    promoted = _promoted(store)
    rows = written(df.withColumn("__key", props.key_text(F.col(key))))
    if not rows.where("__key IS NULL").isEmpty():
        raise ValueError(f"rows without {key}")
    asked = rows.select("__key").distinct()
    held = written(frame.withColumn("__key", props.key_text(props.prop(frame, key))).join(asked, "__key", "left_semi").select("__key", F.struct(*frame.columns).alias("__old")))
    if not held.groupBy("__key").count().where("count > 1").isEmpty():
        raise ValueError(f"{key}: a key is held twice")
    met = written(rows.join(held, "__key", "left"))
    known = met.where("__old IS NOT NULL")
    rest = [c for c in df.columns if c not in promoted]
    fresh, inserted = numbered(met.where("__old IS NULL").select(df.columns), order, "__serial", store.state.serial + 1)
    new = fresh.select(ids.pack(store.state.labid, F.col("__serial")).alias("id"), as_properties(df, rest).alias("properties"), *[c for c in promoted if c in df.columns])
    updated, changed = 0, None
    if on_existing == "update":
        updated = known.count()
        given = [c for c in promoted if c in df.columns]
        last = known.groupBy("__key").agg(F.max_by(F.struct(F.col("__old"), as_properties(df, rest).alias("__new"), *[F.col(c).alias(f"__p_{c}") for c in given]), F.struct(*order)).alias("m"))
        changed = last.select(F.col("m.__old.id").alias("id"), props.map_merge(F.col("m.__old.properties"), F.col("m.__new")).alias("properties"), *[F.col(f"m.__p_{c}" if c in given else f"m.__old.{c}").alias(c) for c in promoted])
    if inserted or updated or feed is not None:
        store.apply(new if inserted else None, changed if updated else None, serial=store.state.serial + inserted, feed=feed, batch=batch, counts=(inserted, updated))
    return inserted, updated


def upsert_edges(store: LabelStore, df: DataFrame, order: list[str], on_existing: str = "skip", feed: str | None = None, batch: int = 0) -> tuple[int, int]:
    """(inserted, updated), as ``write.upsert_edges`` does it: keyed by both ends, the first row of a new pair wins."""
    if feed is not None and (done := store.written_by(feed, batch)) is not None:
        return done
    if on_existing not in ("skip", "update"):
        raise ValueError("on_existing is skip or update")
    rows = written(df)
    if not rows.where("start IS NULL OR end IS NULL").isEmpty():
        raise ValueError("rows without start or end")
    frame, ends = store.frame(), ["start", "end"]
    held = written(frame.join(rows.select(*ends).distinct(), ends, "left_semi").select(*ends, F.struct(*frame.columns).alias("__old")))
    first = rows.groupBy(*ends).agg(F.min_by(F.struct("properties"), F.struct(*order))["properties"].alias("properties"))
    fresh, inserted = numbered(first.join(held, ends, "left_anti"), ends, "__serial", store.state.serial + 1)
    new = fresh.select(ids.pack(store.state.labid, F.col("__serial")).alias("id"), *ends, F.coalesce("properties", F.lit("{}")).alias("properties"))
    updated, changed = 0, None
    if on_existing == "update":
        over = rows.where("properties IS NOT NULL AND properties <> '{}'").join(held, ends)
        updated = over.count()
        last = over.groupBy("__old.id").agg(F.max_by(F.struct("__old", "properties"), F.struct(*order)).alias("m"))
        changed = last.select("id", *[props.map_merge(F.col("m.__old.properties"), F.col("m.properties")).alias(c) if c == "properties" else F.col(f"m.__old.{c}").alias(c) for c in store.schema.names if c != "id"])
    if inserted or updated or feed is not None:
        store.apply(new if inserted else None, changed if updated else None, serial=store.state.serial + inserted, feed=feed, batch=batch, counts=(inserted, updated))
    return inserted, updated


def set_properties(store: LabelStore, where: Column, values: Column, replace_all: bool = False) -> int:
    """How many elements got ``values`` laid over their properties, or with ``replace_all`` in their place; only these are written."""
    new = values if replace_all else props.map_merge(F.col("properties"), values)
    changed = written(store.frame().where(F.coalesce(where, F.lit(False))).withColumn("properties", new))
    return _changed(store, changed)


def remove_property(store: LabelStore, where: Column, key: str) -> int:
    hit = F.coalesce(where, F.lit(False)) & F.array_contains(props.keys(F.col("properties")), key)
    return _changed(store, written(store.frame().where(hit).withColumn("properties", props.without_key(F.col("properties"), key))))


def _changed(store: LabelStore, changed: DataFrame) -> int:
    n = changed.count()
    if n:
        store.apply(changed=changed)
    return n


def delete_elements(store: LabelStore, doomed: DataFrame) -> int:
    """How many elements of these ids went. Ids alone are written; edges of vertices are deleted from their own stores, or refused, by ``delete_vertices``."""
    names = [c for c in ("id", "start", "end") if c in store.schema.names]
    gone = written(store.frame().join(doomed.select("id"), "id", "left_semi").select(names))
    n = gone.count()
    if n:
        store.apply(gone=gone)
    return n


def delete_vertices(store: LabelStore, edges: list[LabelStore], doomed: DataFrame, detach: bool = False) -> tuple[int, int]:
    """(vertices, edges) that went: edges at the vertices too with ``detach``, otherwise edges that remain refuse it.

    Edges go first, each store in a version of its own: after a stop in between no edge is left without an end.
    """
    gone = written(store.frame().join(doomed.select("id"), "id", "left_semi").select("id"))
    lost = []
    for held in edges:
        frame = held.frame()
        ends = frame.select("id", "start", "end", F.explode(F.array("start", "end")).alias("at")).join(gone.select(F.col("id").alias("at")), "at", "left_semi").select("id", "start", "end").distinct()
        lost.append(written(ends))
    counts = [rows.count() for rows in lost]
    if sum(counts) and not detach:
        raise ValueError(f"{sum(counts)} edges still meet these vertices")
    for held, rows, n in zip(edges, lost, counts, strict=True):
        if n:
            held.apply(gone=rows)
    return delete_elements(store, gone), sum(counts)
