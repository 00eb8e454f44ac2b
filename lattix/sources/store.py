"""Labels stored as a base, later changes and a log of commits: a write stores what it changes, a reader merges."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattix.functions import ids


class CommitConflict(RuntimeError):
    """Another writer made this version first; what this one wrote is not part of the label."""


@dataclass(frozen=True)
class State:
    """What a version consists of. Folders are relative to the store's; ``feeds`` has the last batch of each feed and what it did."""

    version: int = -1
    labid: int = 0
    kind: str = "v"
    schema: str = ""
    serial: int = 0
    base: str | None = None
    inserts: tuple[str, ...] = ()
    changes: tuple[str, ...] = ()
    feeds: dict[str, list[int]] = field(default_factory=dict)


class LabelStore:
    """One label under a folder that all executors share: ``data/`` has Parquet files, ``log/`` one small file a version.

    A version names a base, tables of elements that were inserted after it, and tables of changes, in which an element
    stands as it is since then or as gone. Data are written first and count from the moment their version's file is put
    in its place, which succeeds for one writer alone; a write that ends before leaves nothing behind but unused files. So a new
    driver finds the label as it was, with the numbers of the batches that feeds have written.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._log = self._hadoop.Path(f"{self.path}/log")
        self._files = self._log.getFileSystem(spark._jsc.hadoopConfiguration())
        self.state = self._newest()

    @staticmethod
    def create(spark: SparkSession, path: str, labid: int, frame: DataFrame) -> LabelStore:
        """A new store whose base are the frame's rows; edges are told by their ends."""
        store = LabelStore(spark, path)
        if store.state.version >= 0:
            raise ValueError(f"{path} holds a label already")
        kind = "e" if {"start", "end"} <= set(frame.columns) else "v"
        base = store._put(frame)
        held = spark.read.schema(frame.schema).parquet(f"{store.path}/{base}")
        serial = held.agg(F.max(ids.locid(F.col("id")))).first()[0] or 0
        store._commit(State(0, labid, kind, frame.schema.json(), serial, base))
        return store

    def _newest(self) -> State:
        if not self._files.exists(self._log):
            return State()
        names = [str(f.getPath().getName()) for f in self._files.listStatus(self._log)]
        last = max((n for n in names if n.endswith(".json") and not n.startswith(".")), default=None)
        return State() if last is None else self.at(int(last[:-5]))

    def at(self, version: int) -> State:
        """What an earlier version consisted of."""
        stream = self._files.open(self._hadoop.Path(f"{self.path}/log/{version:020d}.json"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        read = json.loads(text)
        return State(**read | {"inserts": tuple(read["inserts"]), "changes": tuple(read["changes"])})

    def _put(self, rows: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def _commit(self, state: State) -> None:
        """The version's file is written aside and moved into place; the move fails if the place is taken."""
        aside = self._hadoop.Path(f"{self.path}/log/.{uuid.uuid4().hex}")
        place = self._hadoop.Path(f"{self.path}/log/{state.version:020d}.json")
        stream = self._files.create(aside, False)
        stream.write(json.dumps(asdict(state)).encode())
        stream.close()
        jvm = self.spark._jvm
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        context = self._hadoop.FileContext.getFileContext(place.toUri() if place.isAbsolute() and place.toUri().getScheme() else self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(aside, place, self.spark.sparkContext._gateway.new_array(rename, 0))
        except Exception as e:
            self._files.delete(aside, False)
            if self._files.exists(place):
                raise CommitConflict(f"version {state.version} of {self.path} is another writer's") from e
            raise
        self.state = state

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.state.schema))

    def written_by(self, feed: str, batch: int) -> tuple[int, int] | None:
        """(inserted, updated) of a batch that this feed has written already. Batches of a feed come in order."""
        last = self.state.feeds.get(feed)
        return None if last is None or batch > last[0] else (last[1], last[2]) if batch == last[0] else (0, 0)

    def _changes(self) -> DataFrame:
        """(id, gone, row): each changed element as the last of the changes has it."""
        parts = [self.spark.read.parquet(f"{self.path}/{folder}").withColumn("__at", F.lit(k)) for k, folder in enumerate(self.state.changes)]
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        row = F.struct(*[F.col(c) for c in self.schema.names])
        return every.groupBy("id").agg(F.max_by(F.struct("__gone", row.alias("row")), "__at").alias("m")).select("id", F.col("m.__gone").alias("gone"), "m.row")

    def frame(self) -> DataFrame:
        """The label's elements. Only if anything was changed are the others told from it by id."""
        names, state = self.schema.names, self.state
        whole = [self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}") for folder in (state.base, *state.inserts)]
        held = reduce(DataFrame.unionByName, whole)
        if not state.changes:
            return held
        changes = self._changes()
        return held.join(changes.select("id"), "id", "left_anti").select(names).unionByName(changes.where("NOT gone").select("row.*").select(names))

    def apply(self, inserts: DataFrame | None = None, changed: DataFrame | None = None, gone: DataFrame | None = None, serial: int = 0, feed: str | None = None, batch: int = 0, counts: tuple[int, int] = (0, 0)) -> None:
        """One version: new elements, elements as they are now, and ids, of edges with their ends, of those that go. Files of other elements stay untouched."""
        state, names = self.state, self.schema.names
        new = replace(state, version=state.version + 1, serial=max(state.serial, serial))
        lay = lambda rows: rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(self.schema[c].dataType).alias(c) for c in names])
        if inserts is not None:
            new = replace(new, inserts=(*new.inserts, self._put(lay(inserts))))
        over = [lay(rows).withColumn("__gone", F.lit(flag)) for rows, flag in ((changed, False), (gone, True)) if rows is not None]
        if over:
            new = replace(new, changes=(*new.changes, self._put(reduce(DataFrame.unionByName, over))))
        if feed is not None:
            new = replace(new, feeds=state.feeds | {feed: [batch, *counts]})
        self._commit(new)

    def signed(self, since: int) -> DataFrame:
        """Elements that came after version ``since``, with ``change`` 1, and those that went, with -1; of edges with their ends.

        Only the files of the versions in between are read. An update is no change; who came and went has a row for each.
        """
        names = [c for c in ("id", "start", "end") if c in self.schema.names]
        parts, before = [], self.at(since)
        for version in range(since + 1, self.state.version + 1):
            now = self.at(version)
            for folder in (f for f in now.inserts if f not in before.inserts):
                parts.append(self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}").select(*names, F.lit(1).cast("long").alias("change")))
            for folder in (f for f in now.changes if f not in before.changes):
                parts.append(self.spark.read.parquet(f"{self.path}/{folder}").where("__gone").select(*names, F.lit(-1).cast("long").alias("change")))
            before = now
        nothing = self.spark.createDataFrame([], T.StructType([*(self.schema[c] for c in names), T.StructField("change", T.LongType())]))
        return reduce(DataFrame.unionByName, parts, nothing)

    def compact(self) -> None:
        """Base and changes joined into one base; readers of earlier versions still find their files."""
        base = self._put(self.frame())
        self._commit(replace(self.state, version=self.state.version + 1, base=base, inserts=(), changes=()))

    def clear(self) -> None:
        """Deletes files that no version from now on names, those of ended writes included. No other reader or writer may be at work."""
        used = {self.state.base, *self.state.inserts, *self.state.changes}
        for f in self._files.listStatus(self._hadoop.Path(f"{self.path}/data")):
            if f"data/{f.getPath().getName()}" not in used:
                self._files.delete(f.getPath(), True)

    def bytes(self, folder: str) -> int:
        return int(self._files.getContentSummary(self._hadoop.Path(f"{self.path}/{folder}")).getLength())
