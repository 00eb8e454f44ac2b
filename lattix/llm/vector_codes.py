"""Compression of vectors to codes: codebooks for parts of vectors, fitted through metric trees with cached sums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.llm.batches import mapped, told_by, written

#: Parts of a vector, entries of a part's codebook, rounds of fitting, steps of a component's unit.
PARTS, ENTRIES, ROUNDS, UNIT = 8, 16, 6, 4096
#: Vectors whose parts go into one set of trees, and bytes of them.
PIECE_ROWS, PIECE_BYTES = 4096, 8_000_000
#: Different points of a ball from which it is divided.
LEAF = 12
#: Bounds are taken in floating point, far wider than its error; distances that decide are whole numbers.
_WIDE = 1 + 1e-9


class Tree:
    """Balls over the points of one piece and part, children of a ball side by side; arrays have a row for each ball.

    ``points`` are different, in the order of the leaves, with how many vectors have each (``weight``); a ball covers
    ``first`` to ``last`` of them and caches the sum and count of its vectors; ``kids`` and ``n_kids`` tell its children.
    """

    FIELDS = {"points": np.int64, "weight": np.int64, "of": np.int32, "center": np.float64, "radius": np.float64, "sums": np.int64, "count": np.int64, "first": np.int32, "last": np.int32, "kids": np.int32, "n_kids": np.int32}

    def __init__(self, width: int, **arrays: np.ndarray):
        self.__dict__ |= arrays
        self.width = width

    @classmethod
    def over(cls, rows: np.ndarray) -> Tree:
        """Anchors from the middle out: about sqrt(n) of them split the points, are joined upwards by least ball, and split further below."""
        points, of, weight = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        exact = points.astype(np.float64)
        order: list[np.ndarray] = []
        balls: list[tuple] = [_middle_out(exact, np.arange(len(points)))]
        arrays = {x: [] for x in ("center", "radius", "sums", "count", "first", "last", "kids", "n_kids")}
        spans, place = {}, 0
        stack = [(balls[0], False)]
        while stack:  # leaves in order, so that every ball covers a run of points
            ball, seen = stack.pop()
            if not ball[1]:
                order.append(ball[0])
                spans[id(ball)] = (place, place + len(ball[0]))
                place += len(ball[0])
            elif seen:
                spans[id(ball)] = (spans[id(ball[1][0])][0], spans[id(ball[1][-1])][1])
            else:
                stack += [(ball, True)] + [(kid, False) for kid in reversed(ball[1])]
        order_ = np.concatenate(order)
        points, weight, exact = points[order_], weight[order_].astype(np.int64), exact[order_]
        place_of = np.empty(len(order_), np.int32)
        place_of[order_] = np.arange(len(order_), dtype=np.int32)
        sums = np.concatenate([np.zeros((1, rows.shape[1]), np.int64), np.cumsum(points * weight[:, None], 0)])
        counts = np.concatenate([[0], np.cumsum(weight)])
        at = 0
        while at < len(balls):
            low, high = spans[id(balls[at])]
            kids = balls[at][1]
            center = exact[low:high].mean(0)
            away = exact[low:high] - center
            for name, value in (("center", center), ("radius", np.sqrt((away * away).sum(1).max()) * _WIDE), ("sums", sums[high] - sums[low]), ("count", counts[high] - counts[low]), ("first", low), ("last", high), ("kids", len(balls)), ("n_kids", len(kids))):
                arrays[name].append(value)
            balls += kids
            at += 1
        made = {name: np.array(x, cls.FIELDS[name]) for name, x in arrays.items()}
        return cls(rows.shape[1], points=points, weight=weight, of=place_of[of.reshape(-1)], **made)

    def pack(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(self.__dict__[name], kind).tobytes() for name, kind in self.FIELDS.items()}

    @classmethod
    def unpack(cls, packed: dict, width: int) -> Tree:
        arrays = {name: np.frombuffer(packed[name], kind) for name, kind in cls.FIELDS.items()}
        n = len(arrays["weight"])
        return cls(width, **arrays | {"points": arrays["points"].reshape(n, width), "center": arrays["center"].reshape(-1, width), "sums": arrays["sums"].reshape(-1, width)})

    def owners(self, entries: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
        """(balls wholly owned by one entry, with that entry), and points of other leaves with theirs.

        A ball inherits the candidates of its parent and strikes each that another is nearer than throughout the ball. A
        ball with one candidate left is owned; others hand theirs to their children, and leaves measure each point exactly.
        """
        k = len(entries)
        exact = entries.astype(np.float64)
        apart = np.sqrt(((exact[:, None] - exact[None]) ** 2).sum(2)) * _WIDE
        fresh = np.array([not (entries[:i] == entries[i]).all(1).any() for i in range(k)])  # of equal entries the first has all
        balls, open_ = np.zeros(1, np.int64), fresh[None].copy()
        owned, leaves = [], []
        while len(balls):
            away = ((self.center[balls][:, None] - exact[None]) ** 2).sum(2)
            away[~open_] = np.inf
            best = away.argmin(1)
            least = away[np.arange(len(balls)), best]
            # nearer throughout: the difference of squares is linear, and least at the rim
            slack = 1e-9 * np.where(open_, away + least[:, None], 0)
            open_ &= ~(away - least[:, None] > 2 * self.radius[balls][:, None] * apart[best] + slack)
            open_[np.arange(len(balls)), best] = True
            whole = open_.sum(1) == 1
            owned.append((balls[whole], best[whole]))
            leaf = ~whole & (self.n_kids[balls] == 0)
            leaves.append((balls[leaf], open_[leaf]))
            inner = ~whole & ~leaf
            n = self.n_kids[balls[inner]]
            skip = np.repeat(np.cumsum(n) - n, n)
            balls, open_ = np.repeat(self.kids[balls[inner]], n) + np.arange(n.sum()) - skip, np.repeat(open_[inner], n, axis=0)
        at, candidates = np.concatenate([x for x, _ in leaves]), np.concatenate([x for _, x in leaves])
        n = (self.last - self.first)[at]
        points = np.repeat(self.first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        candidates = np.repeat(candidates, n, axis=0)
        to = np.zeros(len(points), np.int64)
        for low in range(0, len(points), 8192):
            part = slice(low, low + 8192)
            away = ((self.points[points[part]][:, None] - entries[None]) ** 2).sum(2)
            to[part] = np.where(candidates[part], away, np.iinfo(np.int64).max).argmin(1)
        return owned, points, to

    def gather(self, entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Adds the vectors of each entry: whole balls by their cached sums, the rest point by point."""
        owned, points, to = self.owners(entries)
        every = np.arange(len(entries))[:, None]
        for at, entry, total, n in [(balls, entry, self.sums, self.count) for balls, entry in owned] + [(points, to, self.points * self.weight[:, None], self.weight)]:
            of = (entry[None] == every).astype(np.int64)
            sums += of @ total[at]
            counts += of @ n[at]

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry and the squared distance of each vector of the piece, in the order of its rows."""
        owned, points, to = self.owners(entries)
        code = np.zeros(len(self.weight), np.int64)
        code[points] = to
        for balls, entry in owned:
            for ball, e in zip(balls.tolist(), entry.tolist(), strict=True):
                code[self.first[ball] : self.last[ball]] = e
        error = ((self.points - entries[code]) ** 2).sum(1)
        return code[self.of], error[self.of]


def _anchors(exact: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The points ``at`` in about sqrt(n) groups: each new anchor is the point farthest from its own and takes what is nearer to it.

    An anchor only looks at groups that reach further than half the way to it.
    """
    own = exact[at]
    want = max(2, int(np.sqrt(len(at))))
    first = int(((own - own.mean(0)) ** 2).sum(1).argmax())
    pivots, group = [first], np.zeros(len(at), np.int64)
    away = np.sqrt(((own - own[first]) ** 2).sum(1))
    while len(pivots) < want:
        far = int(away.argmax())
        if away[far] == 0:
            break
        between = np.sqrt(((own[pivots] - own[far]) ** 2).sum(1))
        look = np.flatnonzero(away > between[group] / 2 / _WIDE)
        new = np.sqrt(((own[look] - own[far]) ** 2).sum(1))
        nearer = new < away[look]
        away[look[nearer]], group[look[nearer]] = new[nearer], len(pivots)
        pivots.append(far)
        away[far], group[far] = 0.0, len(pivots) - 1
    return [at[group == g] for g in range(len(pivots))]


def _middle_out(exact: np.ndarray, at: np.ndarray) -> tuple:
    """A ball as (points, children): anchors in the middle, joined in twos of least ball above, divided in the same way below."""
    if len(at) <= LEAF:
        return at, []
    groups = _anchors(exact, at)
    if len(groups) < 2:
        return at, []
    balls = [_middle_out(exact, g) for g in groups]
    centers = np.array([exact[g].mean(0) for g in groups])
    radii = np.array([np.sqrt(((exact[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centers, strict=True)])
    sizes = np.array([len(g) for g in groups], np.float64)
    # the radius of the ball around two balls; a row is asked again only when it is changed
    reach = (np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(2)) + radii[:, None] + radii[None]) / 2
    reach = np.maximum(reach, np.maximum(radii[:, None], radii[None]))
    np.fill_diagonal(reach, np.inf)
    for _ in range(len(balls) - 1):
        i, j = divmod(int(reach.argmin()), len(balls))
        i, j = min(i, j), max(i, j)
        balls[i] = (np.zeros(0, np.int64), [balls[i], balls[j]])
        radii[i] = reach[i, j]
        centers[i] = (centers[i] * sizes[i] + centers[j] * sizes[j]) / (sizes[i] + sizes[j])
        sizes[i] += sizes[j]
        reach[j, :] = reach[:, j] = np.inf
        near = np.maximum((np.sqrt(((centers - centers[i]) ** 2).sum(1)) + radii + radii[i]) / 2, np.maximum(radii, radii[i]))
        near[np.isinf(reach[i])] = np.inf
        reach[i, :] = reach[:, i] = near
    return balls[0]


def whole_numbers(rows: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """(vec_id, label, v) of vectors that have finite components alone: each component x as floor(UNIT * x)."""
    finite = f"`{vector_col}` IS NOT NULL AND NOT exists(`{vector_col}`, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    return rows.where(finite).select(F.col(id_col).alias("vec_id"), label.alias("label"), F.expr(f"transform(`{vector_col}`, x -> floor(cast(x AS double) * {UNIT}))").alias("v"))


def _most(width: int) -> int:
    """The greatest size of a component with which squared distances of a part fit 64 bits."""
    return int(((1 << 62) / max(1, width)) ** 0.5) // 2


def _trees(vectors: DataFrame, dim: int, parts: int) -> DataFrame:
    """One row a piece: ids, labels, and a tree for each part."""
    width = dim // parts
    most, at_once = _most(width), max(1, min(PIECE_ROWS, PIECE_BYTES // (8 * max(1, dim))))
    kinds = {f.name: f.dataType for f in vectors.schema}
    fields = ", ".join(f"{name}: binary" for name in Tree.FIELDS)
    schema = f"vec_id array<{kinds['vec_id'].simpleString()}>, label array<{kinds['label'].simpleString()}>, trees array<struct<{fields}>>"

    def piece(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        sizes = table["v"].combine_chunks().value_lengths().to_numpy()
        if (sizes != dim).any():
            raise ValueError(f"vectors of {dim} and of {sizes[sizes != dim][0]} components: all need the same number")
        v = table["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        if v.size and max(v.max(), -v.min()) > most:
            raise ValueError(f"components beyond {most / UNIT:.6g} can't be squared in 64 bits")
        trees = [Tree.over(v[:, p * width : (p + 1) * width]).pack() for p in range(parts)]
        columns = [pa.array([table[c].combine_chunks().to_pylist()], pa.list_(table[c].type)) for c in ("vec_id", "label")]
        tree = pa.array([trees], pa.list_(pa.struct([(name, pa.binary()) for name in Tree.FIELDS])))
        return pa.RecordBatch.from_arrays([*columns, tree], ["vec_id", "label", "trees"])

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                own = batch.slice(at, at_once - n)
                held.append(own)
                at, n = at + own.num_rows, n + own.num_rows
                if n == at_once:
                    yield piece(held)
                    held, n = [], 0
        if n:
            yield piece(held)

    return mapped(vectors, grown, schema)


def _row_of(batch: pa.RecordBatch, k: int, width: int) -> list[Tree]:
    return [Tree.unpack(t, width) for t in batch["trees"][k].as_py()]


def fit_codebooks(trees: DataFrame, start: list[list[int]], parts: int, rounds: int) -> np.ndarray:
    """Entries by part, entry and component. ``start`` has the vectors whose parts are the first entries.

    In each round a task adds up its pieces' trees and gives one row a part, entry and component, so that a round
    brings as many numbers to the driver as the codebooks have.
    """
    books = np.array(start, np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2)
    width = books.shape[2]
    for _ in range(rounds):

        def summed(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                for k in range(batch.num_rows):
                    for p, tree in enumerate(_row_of(batch, k, width)):
                        tree.gather(books[p], sums[p], counts[p])
            part, entry, at = (x.reshape(-1) for x in np.indices((*books.shape[:2], width + 1)))
            totals = np.concatenate([sums, counts[:, :, None]], 2).reshape(-1)
            some = totals != 0
            yield pa.RecordBatch.from_arrays([pa.array(x[some].astype(np.int32)) for x in (part, entry, at)] + [pa.array(totals[some])], ["part", "entry", "at", "total"])

        found = np.zeros((*books.shape[:2], width + 1), object)
        for r in mapped(trees, summed, "part int, entry int, at int, total long").groupBy("part", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
            found[r["part"], r["entry"], r["at"]] = int(r["total"])
        used = found[:, :, width] > 0
        books = books.copy()
        books[used] = np.array(found[used][:, :width] // found[used][:, width:], np.int64)
    return books


def vector_codes(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error), codebooks): each vector as the numbers of its parts' nearest entries.

    Vectors that are null or hold null or non-finite components are left out. The trees of all pieces are written once and
    read in every round. Rows are ordered by id and vector to choose the first entries, rows without an id never; fewer
    rows than entries give as many entries; repeated rows each count, and equal parts are one point of a tree; rows
    without a label stay; an empty table gives no row and no entry; other columns are not read. Vectors must have the
    same number of components, which the parts divide, and components must be so small that squared distances fit 64 bits; others are refused by an error.
    """
    vectors = whole_numbers(rows, id_col, vector_col, label_col)
    start = [list(r["v"]) for r in vectors.where("vec_id IS NOT NULL").orderBy("vec_id", "v").select("vec_id", "v").limit(entries).collect()]
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    if not start:
        none = vectors.where("vec_id IS NOT NULL AND false").select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none, np.zeros((parts, 0, 0), np.int64)
    dim = len(start[0])
    if dim % parts or len({len(v) for v in start}) > 1:
        raise ValueError(f"vectors of {sorted({len(v) for v in start})} components don't make {parts} equal parts")
    trees = written(_trees(vectors, dim, parts))
    books = fit_codebooks(trees, start, parts, rounds)
    width = dim // parts

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = [tree.codes(books[p]) for p, tree in enumerate(_row_of(batch, k, width))]
                digits = np.array([c for c, _ in found], np.uint8).T
                code = pa.array([row.tobytes().hex() for row in np.ascontiguousarray(digits)], pa.string())
                yield pa.RecordBatch.from_arrays([batch["vec_id"][k].values, batch["label"][k].values, code, pa.array(np.sum([e for _, e in found], 0, dtype=np.int64))], ["vec_id", "label", "code", "error"])

    return written(mapped(trees, coded, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal text, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes, with each label's whole error; labels that many vectors have go to every task."""
    coded, books = vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    keyed = coded.withColumn("key", F.coalesce(F.col("label").cast("string"), F.lit(""))).withColumn("none", F.col("label").isNull())
    named = written(keyed.groupBy("key", "none").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    return told_by(keyed, named, ["key", "none"]).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
