"""Constraints: declared, checked against the data, reconciled; labels and promoted properties."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattix.functions import props
from lattix.model import Graph

#: The longest name a constraint may have.
NAME_LENGTH = 63


@dataclass(frozen=True)
class Constraint:
    name: str
    label: str
    kind: str
    keys: tuple[str, ...] = ()
    condition: str = ""


def unique(label: str, *keys: str, name: str | None = None) -> Constraint:
    return Constraint((name or f"{label}_{'_'.join(keys)}_unique")[:NAME_LENGTH], label, "unique", keys)


def check(label: str, condition: str, name: str) -> Constraint:
    return Constraint(name[:NAME_LENGTH], label, "check", condition=condition)


def check_unique(g: Graph, label: str, *keys: str) -> DataFrame:
    """Keys that several elements hold, with how many; nulls never conflict."""
    frame = g.frames[label]
    texts = [props.key_text(props.prop(frame, k)).alias(k) for k in keys]
    held = frame.select(*texts)
    return held.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("elements")).where("elements > 1")


def check_condition(g: Graph, label: str, condition: str) -> DataFrame:
    """Elements that break a condition; one that is unknown passes."""
    return g.frames[label].where(F.expr(f"NOT ({condition})"))


def check_endpoint_unique(g: Graph, label: str) -> DataFrame:
    """Pairs of endpoint columns that several edges of the label join."""
    return g.frames[label].groupBy("start", "end").agg(F.count("*").alias("edges")).where("edges > 1")


def check_referential(g: Graph) -> DataFrame:
    """(id, side, missing) of edges whose endpoint does not exist; only identities are read."""
    known = reduce(DataFrame.unionAll, [g.frames[lab.name].select(F.col("id").alias("missing")) for lab in g.labels if lab.kind == "v"])
    ends = [g.frames[lab.name].select("id", F.lit(side).alias("side"), F.col(side).alias("missing")) for lab in g.labels if lab.kind == "e" for side in ("start", "end")]
    return reduce(DataFrame.unionAll, ends).join(known, "missing", "left_anti").select("id", "side", "missing")


#: Labels that identities have numbers for.
MOST_LABELS = 65_535


def ensure_labels(g: Graph, wanted: list[tuple[str, str]], dry_run: bool = False) -> tuple[Graph, list[str]]:
    """Declares (name, kind) pairs that are new; drops none, refuses another kind or more labels than there are numbers; again, it does nothing."""
    if len({lab.name for lab in g.labels} | {name for name, _ in wanted}) > MOST_LABELS - 2:
        raise ValueError(f"a graph has at most {MOST_LABELS - 2} labels of its own")
    made = []
    for name, kind in wanted:
        known = next((lab for lab in g.labels if lab.name == name), None)
        if known and known.kind != kind:
            raise ValueError(f"{name} is of kind {known.kind}")
        if not known:
            made.append(name)
            g = g if dry_run else g.with_label(name, kind)
    return g, made


def _breaks(g: Graph, c: Constraint) -> bool:
    if c.kind == "check":
        return not check_condition(g, c.label, c.condition).isEmpty()
    bad = check_endpoint_unique(g, c.label) if c.keys == ("start", "end") and g.label(c.label).kind == "e" else check_unique(g, c.label, *c.keys)
    return not bad.isEmpty()


def ensure_constraints(g: Graph, wanted: list[Constraint], drop_extra: bool = False, dry_run: bool = False) -> tuple[Graph, list[tuple[str, str]]]:
    """Matched by name: new ones are checked against the data and recorded, changed ones replaced, extra ones dropped
    only if asked and only on the labels named. Gives what was done as (action, name)."""
    names = [c.name for c in wanted]
    if len(set(names)) < len(names):
        raise ValueError("two constraints of one name")
    held, done = {c.name: c for c in g.constraints}, []
    for c in wanted:
        if held.get(c.name) == c:
            continue
        if _breaks(g, c):
            raise ValueError(f"{c.name}: the data break it")
        done.append(("replace" if c.name in held else "create", c.name))
        held[c.name] = c
    if drop_extra:
        for name, c in list(held.items()):
            if name not in names and c.label in {w.label for w in wanted}:
                done.append(("drop", name))
                del held[name]
    return (g if dry_run else replace(g, constraints=tuple(held.values()))), done


def promote_property(g: Graph, label: str, name: str, kind: str, move: bool = False) -> Graph:
    """A typed column beside the map, or with ``move`` instead of the key in it."""
    frame = g.frames[label]
    made = frame.withColumn(name, props.property_text(F.col("properties"), name).try_cast(kind))
    if move:
        made = made.withColumn("properties", F.when(F.array_contains(props.keys(F.col("properties")), name), props.without_key(F.col("properties"), name)).otherwise(F.col("properties")))
    return g.with_frame(label, made)
