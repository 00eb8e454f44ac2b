"""Pattern matching: scans, filters, hops, walks, paths and subqueries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattix.functions import ids
from lattix.model import Graph
from lattix.tables import written


def match_vertices(g: Graph, label: str = "ag_vertex", **more) -> DataFrame:
    return g.vertices(label, **more)


def label_columns(g: Graph, df: DataFrame) -> DataFrame:
    """``labels``: an element's own label, then its ancestors."""
    known = [(lab.name, g.ancestry(lab.name)) for lab in g.labels]
    names = g.spark.createDataFrame(known, "label string, labels array<string>")
    return df.join(F.broadcast(names), "label", "left")


def match_by_id(g: Graph, wanted: int | DataFrame) -> DataFrame:
    """Elements by identity: one identity reads only its label's frame, a frame of them meets each in a semi-join."""
    if isinstance(wanted, int):
        number = (wanted >> 48) & 0xFFFF
        return g.frame(next(lab.name for lab in g.labels if lab.labid == number), descendants=False).where(F.col("id") == wanted)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [g.frame(lab.name, descendants=False).join(wanted.select("id"), "id", "left_semi") for lab in g.labels])


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{prefix}.{c}".replace(".", "_")) for c in df.columns])


def expand(edges: DataFrame, sources: DataFrame | None, targets: DataFrame | None, direction: str = "out") -> DataFrame:
    """(a)-[r]->(b): columns a_*, r_*, b_*. An endpoint given as None is not read at all.

    ``in`` walks edges backwards; ``both`` takes either way, a self-loop once.
    """
    r = _renamed(edges, "r")
    if direction == "out":
        hop = r.withColumn("a_id", F.col("r_start")).withColumn("b_id", F.col("r_end"))
    elif direction == "in":
        hop = r.withColumn("a_id", F.col("r_end")).withColumn("b_id", F.col("r_start"))
    else:
        ways = F.when(F.col("r_start") == F.col("r_end"), F.array(F.struct(F.col("r_start").alias("a"), F.col("r_end").alias("b")))).otherwise(
            F.array(F.struct(F.col("r_start").alias("a"), F.col("r_end").alias("b")), F.struct(F.col("r_end").alias("a"), F.col("r_start").alias("b"))))
        hop = r.withColumn("__w", F.explode(ways)).withColumn("a_id", F.col("__w.a")).withColumn("b_id", F.col("__w.b")).drop("__w")
    if sources is not None:
        hop = hop.join(_renamed(sources, "a"), "a_id")
    if targets is not None:
        hop = hop.join(_renamed(targets, "b"), "b_id")
    return hop


def optional(rows: DataFrame, pattern: DataFrame, on: list[str]) -> DataFrame:
    """Rows without a match stay, with nulls for the pattern."""
    return rows.join(pattern, on, "left")


def product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two patterns that share nothing: every pair. Filter both first; it has as many rows as their product."""
    return a.crossJoin(b)


def _steps(edges: DataFrame, direction: str) -> DataFrame:
    hop = expand(edges.select("id", "start", "end"), None, None, direction)
    return hop.select(F.col("a_id").alias("__from"), F.col("r_id").alias("__edge"), F.col("b_id").alias("__to"))


def hub_join(left: DataFrame, right: DataFrame, on: str, chunk_rows: int = 100_000) -> DataFrame:
    """The inner join, with the rows of hubs cut into chunks, so that no task has more of a key than about two chunks.

    Keys are counted on both sides first. A key with more than ``chunk_rows`` rows on a side is a hub: its rows there are
    dealt to chunks, and its rows on the other side are copied to each of these. Where both sides are that
    many, every two chunks meet once. Rows of all other keys are neither copied nor dealt, and no key is left out.
    Equal rows go to one chunk.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(on).isNotNull()).groupBy(on).agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias(name))

    hubs = written(counted(left, "__l").join(counted(right, "__r"), on).where("__l > 1 OR __r > 1"))
    if hubs.isEmpty():
        return left.join(right, on)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        some = df.join(hubs, on)  # the table of hubs is small: each stands for chunk_rows rows
        mine = F.pmod(F.xxhash64(*[c for c in df.columns if c != on]), F.col(own)).cast("int")  # by what the row holds, so that a task that runs again deals alike
        return some.withColumn(f"{own}k", mine).withColumn(f"{other}k", F.explode(F.expr(f"sequence(0, {other} - 1)"))).drop("__l", "__r")

    light = left.join(hubs.select(on), on, "left_anti").join(right.join(hubs.select(on), on, "left_anti"), on)
    heavy = dealt(left, "__l", "__r").join(dealt(right, "__r", "__l"), [on, "__lk", "__rk"]).drop("__lk", "__rk")
    return light.unionByName(heavy)


def walk(starts: DataFrame, edges: DataFrame, least: int, most: int, direction: str = "out", hubs: int | None = None) -> DataFrame:
    """Walks of least..most hops: start_id, end_id, hops, vertex_ids, edge_ids; an edge appears once in a walk.

    One join a hop, in an unrolled plan; ``most`` is a constant, and the rows are as many as the walks. With ``hubs`` the
    edges of vertices that have more than so many are met in chunks, at the cost of a count before each hop.
    """
    step = _steps(edges, direction)
    if hubs:
        step = written(step)
    none = F.array().cast("array<bigint>")
    level = starts.select(F.col("id").alias("start_id"), F.col("id").alias("end_id"), F.lit(0).alias("hops"), F.array("id").alias("vertex_ids"), none.alias("edge_ids"))
    out = [level] if least == 0 else []
    for n in range(1, most + 1):
        met = hub_join(written(level).withColumnRenamed("end_id", "__from"), step, "__from", hubs) if hubs else level.join(step, F.col("end_id") == F.col("__from"))
        level = (
            met.where(~F.array_contains("edge_ids", F.col("__edge")))
            .select("start_id", F.col("__to").alias("end_id"), F.lit(n).alias("hops"), F.array_append("vertex_ids", F.col("__to")).alias("vertex_ids"), F.array_append("edge_ids", F.col("__edge")).alias("edge_ids"))
        )
        if n >= least:
            out.append(level)
    return reduce(DataFrame.unionAll, out)


def reachable(starts: DataFrame, edges: DataFrame, direction: str = "out") -> DataFrame:
    """(start_id, end_id) of all pairs that any number of hops joins, the start itself at none.

    A frontier of new pairs only; each round is written, so plans stay short however long the paths are.
    """
    step = _steps(edges, direction).select("__from", "__to").distinct()
    seen = starts.select(F.col("id").alias("start_id"), F.col("id").alias("end_id")).distinct()
    front = seen
    while True:
        fresh = front.join(step, F.col("end_id") == F.col("__from")).select("start_id", F.col("__to").alias("end_id")).distinct().join(seen, ["start_id", "end_id"], "left_anti")
        front = written(fresh)
        if front.isEmpty():
            return seen
        seen = seen.unionAll(front)


def shortest_path(starts: DataFrame, ends: DataFrame, edges: DataFrame, most: int, least: int = 0, direction: str = "out") -> DataFrame:
    """For each pair the path with fewest hops, of those with the smallest ids: start_id, end_id, hops, vertex_ids.

    Breadth-first: a level keeps one path per pair, so rows are bounded by pairs, not by walks.
    """
    step = _steps(edges, direction)
    level = starts.select(F.col("id").alias("start_id"), F.col("id").alias("end_id"), F.lit(0).alias("hops"), F.array("id").alias("vertex_ids"))
    seen = level
    for n in range(1, most + 1):
        grown = level.join(step, F.col("end_id") == F.col("__from")).select("start_id", F.col("__to").alias("end_id"), F.array_append("vertex_ids", F.col("__to")).alias("vertex_ids"))
        level = written(
            grown.groupBy("start_id", "end_id").agg(F.min("vertex_ids").alias("vertex_ids"))
            .join(seen.select("start_id", "end_id"), ["start_id", "end_id"], "left_anti").select("start_id", "end_id", F.lit(n).alias("hops"), "vertex_ids")
        )
        if level.isEmpty():
            break
        seen = seen.unionAll(level)
    return seen.where(F.col("hops") >= least).join(ends.select(F.col("id").alias("end_id")).distinct(), "end_id", "left_semi")


def path_elements(paths: DataFrame, vertices: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """Paths carried as ids, with their elements joined in: ``vertices`` and ``edges`` as arrays of structs."""
    v = vertices.select("id", F.struct("id", "label", "properties").alias("element"))
    e = edges.select("id", F.struct("id", "label", "start", "end", "properties").alias("element"))

    def joined(column: str, elements: DataFrame, name: str) -> DataFrame:
        each = paths.select(key, F.posexplode(column).alias("at", "id")).join(elements, "id")
        return each.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "element"))), lambda x: x["element"]).alias(name))

    return paths.join(joined("vertex_ids", v, "vertices"), key, "left").join(joined("edge_ids", e, "edges"), key, "left")


def path_length(path: Column) -> Column:
    """Hops."""
    return F.size(path)


def exists_where(rows: DataFrame, pattern: DataFrame, on: list[str], negated: bool = False) -> DataFrame:
    return rows.join(pattern, on, "left_anti" if negated else "left_semi")


def count_of(rows: DataFrame, pattern: DataFrame, on: list[str], name: str) -> DataFrame:
    """How many matches each row has, 0 if none."""
    return rows.join(pattern.groupBy(*on).agg(F.count("*").alias(name)), on, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def collect_of(rows: DataFrame, pattern: DataFrame, on: list[str], value: str, name: str) -> DataFrame:
    """A row's values, sorted; an empty list if none."""
    lists = pattern.groupBy(*on).agg(F.array_sort(F.collect_list(value)).alias(name))
    return rows.join(lists, on, "left").withColumn(name, F.coalesce(name, F.array().cast(lists.schema[name].dataType)))


def value_of(rows: DataFrame, pattern: DataFrame, on: list[str], value: str, by: str, name: str) -> DataFrame:
    """One value a row: that of the match that is least by ``by``."""
    return rows.join(pattern.groupBy(*on).agg(F.min_by(value, by).alias(name)), on, "left")


def call_subquery(rows: DataFrame, pattern: DataFrame, on: list[str], is_optional: bool = False) -> DataFrame:
    return rows.join(pattern, on, "left" if is_optional else "inner")


def edge_pairs_present(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(start, end, id) of edges between the given pairs; only those three columns are read."""
    return edges.select("start", "end", "id").join(pairs.select("start", "end"), ["start", "end"], "left_semi")


def degree(vertices: DataFrame, edges: DataFrame, direction: str = "out") -> DataFrame:
    """Edges per vertex, 0 if none; counted before the join, so a hub is one row there."""
    end = "start" if direction == "out" else "end"
    counted = edges.groupBy(F.col(end).alias("id")).agg(F.count("*").alias("degree"))
    return vertices.select("id").join(counted, "id", "left").select("id", F.coalesce("degree", F.lit(0).cast("long")).alias("degree"))


def ancestors(starts: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """Who is reached against the edges in up to ``most`` hops."""
    return walk(starts, edges, 1, most, "in").select("start_id", F.col("end_id").alias("ancestor_id"), "hops")


def label_of(g: Graph, df: DataFrame, id_: str, name: str) -> DataFrame:
    """The label from the identity: no vertex is read."""
    return g.label_names(id_, name, df)


def order_by_element(df: DataFrame, id_: str, descending: bool = False) -> DataFrame:
    return df.orderBy(*ids.order(F.col(id_), descending))
