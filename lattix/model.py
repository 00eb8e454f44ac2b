"""A property graph: a small catalog of labels and one frame per label."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.functions import ids

#: Built-in ancestors of all vertices and all edges; user labels start at 3.
BUILT_IN = {"ag_vertex": (1, "v"), "ag_edge": (2, "e")}


@dataclass(frozen=True)
class Label:
    labid: int
    name: str
    kind: str
    parent: str | None = None


@dataclass(frozen=True)
class Graph:
    """Frames by label: vertices have ``id``, edges ``id, start, end``; ``properties`` is JSON text and any other
    column a promoted property. Graphs are values: writes give new ones."""

    spark: SparkSession
    name: str
    labels: tuple[Label, ...] = ()
    frames: dict[str, DataFrame] = field(default_factory=dict)
    constraints: tuple = ()
    version: int = 0
    triples_version: int | None = None

    def label(self, name: str) -> Label:
        found = next((lab for lab in self.labels if lab.name == name), None)
        if not found:
            raise KeyError(f"no label {name} in {self.name}")
        return found

    def with_label(self, name: str, kind: str, frame: DataFrame | None = None, parent: str | None = None, labid: int | None = None) -> Graph:
        number = labid or max([2, *(lab.labid for lab in self.labels)]) + 1
        shape = "id long, properties string" if kind == "v" else "id long, start long, end long, properties string"
        held = frame if frame is not None else self.spark.createDataFrame([], shape)
        return replace(self, labels=(*self.labels, Label(number, name, kind, parent)), frames=self.frames | {name: held}, version=self.version + (frame is not None))

    def with_frame(self, name: str, frame: DataFrame) -> Graph:
        return replace(self, frames=self.frames | {name: frame}, version=self.version + 1)

    def family(self, name: str) -> list[str]:
        """The label and all that inherit from it, from the catalog alone; a built-in name gives its whole kind."""
        if name in BUILT_IN:
            return [lab.name for lab in self.labels if lab.kind == BUILT_IN[name][1]]
        out, queue = [], [name]
        while queue:
            at = queue.pop(0)
            out.append(at)
            queue += [lab.name for lab in self.labels if lab.parent == at]
        return out

    def ancestry(self, name: str) -> list[str]:
        """The label first, then its ancestors; built-in ones excluded."""
        out = [name]
        while (up := self.label(out[-1]).parent) and up not in BUILT_IN:
            out.append(up)
        return out

    def frame(self, name: str, descendants: bool = True, columns: list[str] | None = None) -> DataFrame:
        """Elements of a label with its descendants', and ``label``; columns that one lacks are null."""
        names = self.family(name) if descendants else [name]
        parts = []
        for own in names:
            held = self.frames[own]
            kept = held if columns is None else held.select(*[c for c in columns if c in held.columns])
            parts.append(kept.withColumn("label", F.lit(own)))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def vertices(self, name: str = "ag_vertex", **more) -> DataFrame:
        return self.frame(name, **more)

    def edges(self, name: str = "ag_edge", **more) -> DataFrame:
        return self.frame(name, **more)

    def catalog(self) -> DataFrame:
        rows = [(lab.labid, lab.name, lab.kind, lab.parent or ("ag_vertex" if lab.kind == "v" else "ag_edge"), False) for lab in self.labels]
        rows += [(n, name, kind, None, True) for name, (n, kind) in BUILT_IN.items()]
        return self.spark.createDataFrame(rows, "labid int, name string, kind string, parent string, built_in boolean")

    def label_names(self, id_: str, out: str, df: DataFrame) -> DataFrame:
        """The name of each identity's label, from the identity alone. The catalog is bounded by 65,535 labels."""
        names = self.spark.createDataFrame([(lab.labid, lab.name) for lab in self.labels], f"__lab int, {out} string")
        return df.join(F.broadcast(names), ids.labid(F.col(id_)) == F.col("__lab"), "left").drop("__lab")

    def save(self, path: str) -> None:
        """Each label's frame as Parquet in a directory of its own under ``label=``, beside the catalog and the constraints."""
        rows = [(c.name, c.label, c.kind, list(c.keys), c.condition) for c in self.constraints]
        state = self.spark.createDataFrame([(self.version, self.triples_version, rows)], "version int, triples_version int, constraints array<struct<name:string,label:string,kind:string,keys:array<string>,condition:string>>")
        state.coalesce(1).write.mode("overwrite").parquet(f"{path}/state")
        self.catalog().where("NOT built_in").coalesce(1).write.mode("overwrite").parquet(f"{path}/catalog")
        for name, frame in self.frames.items():
            frame.write.mode("overwrite").parquet(f"{path}/elements/label={name}")

    @staticmethod
    def load(spark: SparkSession, name: str, path: str) -> Graph:
        rows = spark.read.parquet(f"{path}/catalog").orderBy("labid").collect()  # at most 65,535 labels
        labels = tuple(Label(r["labid"], r["name"], r["kind"], None if r["parent"] in BUILT_IN else r["parent"]) for r in rows)
        state = spark.read.parquet(f"{path}/state").first()
        from lattix.operators.constraints import Constraint

        kept = tuple(Constraint(c["name"], c["label"], c["kind"], tuple(c["keys"]), c["condition"]) for c in state["constraints"])
        return Graph(spark, name, labels, {lab.name: spark.read.parquet(f"{path}/elements/label={lab.name}") for lab in labels}, kept, state["version"], state["triples_version"])
