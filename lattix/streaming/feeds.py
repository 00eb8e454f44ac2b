"""Feeds of micro-batches into a graph, and counts kept as elements arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lattix.functions import ids
from lattix.model import Graph
from lattix.operators import stored, write
from lattix.sources.store import LabelStore
from lattix.tables import written


class GraphFeed:
    """Holds the graph that a stream writes into; batches already written are known by number and skipped.

    New elements are written once, by their batch, and stay a table of their own until ``compact_every`` batches are
    joined into one. A feed that changes stored elements rewrites its label with every batch.
    """

    def __init__(self, g: Graph, upsert: Callable[[Graph, DataFrame], tuple[Graph, int, int]], label: str, compact_every: int = 1):
        self.graph, self.upsert, self.label, self.compact_every = g, upsert, label, compact_every
        self.done: dict[int, tuple[int, int]] = {}

    def __call__(self, batch: DataFrame, number: int) -> None:
        if number in self.done:
            return
        g, inserted, updated = self.upsert(self.graph, batch)
        self.done[number] = inserted, updated
        full = len(self.done) % self.compact_every == 0
        self.graph = g.with_frame(self.label, written(g.frames[self.label])) if full else g

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def vertex_feed(g: Graph, label: str, key: str, order: list[str], on_existing: str = "update") -> GraphFeed:
    """A batch that is replayed writes nothing."""
    return GraphFeed(g, lambda held, batch: write.upsert_vertices(held, label, batch, key, order, on_existing, require_unique=False), label, 1 if on_existing == "update" else 16)


def edge_feed(g: Graph, label: str, order: list[str], on_existing: str = "skip") -> GraphFeed:
    return GraphFeed(g, lambda held, batch: write.upsert_edges(held, label, batch, order, on_existing, require_unique=False), label, 1 if on_existing == "update" else 16)


class StoredFeed:
    """Writes a stream into a stored label. Each batch is one version of the store that bears its number.

    A batch that was stored, but not yet marked as done by the stream, comes again after a restart: the store knows it and
    nothing is written. One that ended before its version was in place comes again and is written once. So a new
    driver with the same store and checkpoint gets each row once. Changes are joined into a new base every ``compact_every`` versions.
    """

    def __init__(self, store: LabelStore, upsert: Callable[[LabelStore, DataFrame, int], tuple[int, int]], name: str, compact_every: int = 32):
        self.store, self.upsert, self.name, self.compact_every = store, upsert, name, compact_every

    def __call__(self, batch: DataFrame, number: int) -> None:
        if self.store.written_by(self.name, number) is not None:
            return
        self.upsert(self.store, batch, number)
        if len(self.store.state.inserts) + len(self.store.state.changes) >= self.compact_every:
            self.store.compact()

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_vertex_feed(store: LabelStore, key: str, order: list[str], on_existing: str = "update", name: str = "vertices", compact_every: int = 32) -> StoredFeed:
    return StoredFeed(store, lambda held, batch, n: stored.upsert_vertices(held, batch, key, order, on_existing, name, n), name, compact_every)


def stored_edge_feed(store: LabelStore, order: list[str], on_existing: str = "skip", name: str = "edges", compact_every: int = 32) -> StoredFeed:
    return StoredFeed(store, lambda held, batch, n: stored.upsert_edges(held, batch, order, on_existing, name, n), name, compact_every)


def _total(change: str | None) -> Column:
    return F.count("*") if change is None else F.sum(F.col(change).cast("long"))


def element_counts(stream: DataFrame, change: str | None = None) -> DataFrame:
    """(labid, elements), kept as elements arrive: one row of state a label. ``change`` is 1 for elements that come and -1 for those that go."""
    return stream.groupBy(ids.labid(F.col("id")).alias("labid")).agg(_total(change).alias("elements"))


def triples(stream: DataFrame, change: str | None = None) -> DataFrame:
    """(start_labid, edge_labid, end_labid, edge_count), kept as edges arrive, and with ``change`` as they go."""
    return stream.groupBy(*[ids.labid(F.col(c)).alias(f"{n}_labid") for c, n in (("start", "start"), ("id", "edge"), ("end", "end"))]).agg(_total(change).alias("edge_count"))


def carried_on(counts: DataFrame, changes: DataFrame, count: str) -> DataFrame:
    """Counts as they are after signed changes, in the same shape: what was counted before isn't read again; what falls to none goes."""
    keys = [c for c in counts.columns if c != count]
    now = triples(changes, "change") if "start_labid" in keys else element_counts(changes, "change")
    return counts.unionByName(now).groupBy(*keys).agg(F.sum(count).alias(count)).where(F.col(count) != 0)
