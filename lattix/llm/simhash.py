"""SimHash near-duplicates by bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.llm.batches import mapped, mixed, pieces, stretches, told_by, written
from lattix.llm.components import components

RADIUS, SHINGLE, SEED = 3, 3, 42
#: The 64 bits in five bands: fingerprints that differ in at most three bits agree in two of them.
BANDS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
#: Fingerprints of a bucket that are compared in one task; a larger bucket is cut into tiles, and every two tiles meet.
TILE = 2048


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """A bit is 1 if set in over half of the shingles' hashes; repeats count; no words: 0."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the ASCII white space alone
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    joined, n = b" ".join(words), max(1, len(words) - size + 1)
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        ones += np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = np.array([fingerprint(x, size) for x in batch["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found)], ["doc_id", "fp"])

    return mapped(docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text"), hashed, f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp long")


class BitPlanes:
    """Fingerprints stored vertically: word k of plane i holds bit i of 64 of them."""

    def __init__(self, prints: np.ndarray):
        self.n = len(prints)
        bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
        padded = np.zeros((64, -(-self.n // 64) * 64), np.uint8)
        padded[:, : self.n] = bits
        self.planes = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)

    def within(self, probe: int, radius: int = RADIUS) -> np.ndarray:
        """Positions of the prints that differ from ``probe`` in at most ``radius`` bits.

        Distances are counted in vertical counters that start so high that the first excess bit overflows them. Three
        planes at a time go through a carry-save adder; blocks of 64 whose prints all overflowed are abandoned.
        """
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        width = max(2, (radius + 1).bit_length() - (radius & (radius + 1) == 0))
        alive = np.arange(self.planes.shape[1])
        begin = (1 << width) - 1 - radius
        counts = [np.full(len(alive), full if begin >> k & 1 else 0, np.uint64) for k in range(width)]
        over = np.zeros(len(alive), np.uint64)
        for at in range(0, 64, 3):
            a, b, c = (self.planes[at + k, alive] ^ (full if probe >> (at + k) & 1 else np.uint64(0)) if at + k < 64 else np.uint64(0) for k in range(3))
            half = a ^ b
            for first, carry in ((0, half ^ c), (1, (a & b) | (half & c))):
                for k in range(first, width):
                    counts[k], carry = counts[k] ^ carry, counts[k] & carry
                over = over | carry
            if at % 9 == 6 and len(alive) > 1:
                open_ = over != full
                if not open_.all():
                    alive, over, counts = alive[open_], over[open_], [x[open_] for x in counts]
                    if not len(alive):
                        return alive
        good = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(-1)
        at = (alive[:, None] * 64 + np.arange(64)).reshape(-1)[good.astype(bool)]
        return at[at < self.n]


def _alike(sets: list[np.ndarray], sizes: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Those of ``others`` whose sorted sets share 0.8 or more of all their members with set ``i``: whole numbers decide.

    Two of their least hashes must be shared as well, so that a link is found or not whether whole groups meet or buckets alone.
    """
    own, n = sets[i], int(sizes[i])
    others = others[(SHARE[0] * sizes[others] <= SHARE[1] * n) & (SHARE[0] * n <= SHARE[1] * sizes[others])]
    if not n or not len(others):
        return others
    flat = np.concatenate([sets[j] for j in others.tolist()])
    both = np.add.reduceat(own[np.minimum(np.searchsorted(own, flat), n - 1)] == flat, np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
    others = others[SHARE[1] * both >= SHARE[0] * (n + sizes[others] - both)]
    return others[[np.isin(sets[j][:LEAST_HASHES], own[:LEAST_HASHES]).sum() > 1 for j in others.tolist()]] if len(others) else others


def _links(nodes: np.ndarray, prints: np.ndarray, radius: int, coarse: int, sets: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """A forest of links over one bucket, or over two of its tiles.

    ``prints`` has a row of 64-bit words a node. The first words are compared bit-sliced within ``coarse`` bits;
    whole prints of those that stay within ``radius``. With ``sets`` a link needs that the two sets are alike as well.
    """
    order = np.argsort(nodes)
    nodes, prints = nodes[order], np.ascontiguousarray(prints[order]).view(np.uint64)
    if sets is not None:
        sets = [sets[k] for k in order.tolist()]
        sizes = np.array([len(x) for x in sets], np.int64)
    n = len(nodes)
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    planes = BitPlanes(np.ascontiguousarray(prints[:, 0])) if n > 8 else None
    size, probed, most = [1] * n, [False] * n, 0
    again = True
    while again:
        again = False
        for i in range(n):
            # two nodes of the largest group need no comparison, and all others are compared with every node
            if probed[i] or (top(i) == top(most) and size[top(most)] > 1):
                continue
            probed[i] = again = True
            others = np.arange(n) if planes is None else planes.within(int(prints[i, 0]), coarse)
            others = others[np.bitwise_count(prints[others] ^ prints[i]).sum(1) <= radius]
            if sets is not None:  # what verified links join already needs no second look
                others = _alike(sets, sizes, i, others[[top(j) != top(i) for j in others.tolist()]] if len(others) else others)
            for j in others.tolist():
                a, b = top(i), top(j)
                if a != b:
                    a, b = min(a, b), max(a, b)
                    parent[b] = a
                    size[a] += size[b]
                    out.append((int(nodes[i]), int(nodes[j])))
            if size[top(i)] > size[top(most)]:
                most = i
    return out


def _bucket_links(spread: DataFrame, prints: list[str], radius: int, coarse: int) -> DataFrame:
    """Links (a, b) within buckets. ``spread`` has rows (bucket, node) and the columns ``prints``.

    Buckets over ``TILE`` are cut into tiles by a hash of the node; a task gets two tiles, so no bucket has to fit one.
    """
    sizes = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    held = spread.join(sizes, "bucket").select("bucket", "node", *prints, F.expr(f"cast(ceil(n / {TILE // 2}) AS int)").alias("t"), F.expr(f"n <= {TILE}").alias("whole"))
    small = held.where("whole").select("bucket", F.lit(0).alias("one"), F.lit(0).alias("two"), "node", *prints)
    large = (
        held.where("NOT whole").withColumn("tile", F.expr("cast(pmod(xxhash64(node, 7), t) AS int)")).withColumn("other", F.expr("explode(sequence(0, t - 1))"))
        .select("bucket", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "node", *prints)
    )
    names = ["bucket", "one", "two", "node", *prints]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(1)) + 1
            found = [x for g in np.split(rows, cuts) if len(g) > 1 for x in _links(g[:, 3], g[:, 4:], radius, coarse)]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if batch.num_rows:
                rows = np.stack([batch[c].to_numpy().astype(np.int64) for c in names], 1)
                if held and (held[-1][-1, :3] != rows[0, :3]).any():
                    yield from out(np.concatenate(held))
                    held = []
                last = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(1))
                if len(last):
                    yield from out(np.concatenate([*held, rows[: last[-1] + 1]]))
                    held = [rows[last[-1] + 1 :]]
                else:
                    held.append(rows)
        if held:
            yield from out(np.concatenate(held))

    dealt = small.unionAll(large).repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")
    return mapped(dealt, linked, "a long, b long")


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints differ in at most three bits: enough of them to connect all such.

    ``prints`` has one row (fp, node) per different fingerprint. Each goes to ten buckets, one for every two bands.
    """
    masks = []
    for (s1, w1), (s2, w2) in combinations(BANDS, 2):
        masks.append(f"struct({len(masks)} AS t, (shiftrightunsigned(fp, {s1}) & {(1 << w1) - 1}L) * {1 << w2}L + (shiftrightunsigned(fp, {s2}) & {(1 << w2) - 1}L) AS k)")
    spread = prints.selectExpr("fp", "node", f"explode(array({', '.join(masks)})) AS b").selectExpr("b.t * 67108864L + b.k AS bucket", "node", "fp")
    return _bucket_links(spread, ["fp"], RADIUS, RADIUS)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links reach.

    Ids are integers. Fingerprints are taken once over whole texts and written; equal ones become one node, so copies
    never meet as pairs. Null and empty texts have fingerprint zero and are linked like any other. A row without an id
    links others and gets the smallest id that they have, null if none has. Repeated rows stay, with the same result;
    an empty table gives none; other columns are not read.
    """
    prints = written(fingerprints(docs, id_col, text_col, size))
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").cast("long").alias("least"), F.count("*").alias("n")))
    joined = components(near_links(nodes.selectExpr("fp", "fp AS node")))
    grouped = written(nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", "n", F.coalesce("component", "fp").alias("group")))
    named = written(grouped.join(grouped.groupBy("group").agg(F.min("least").alias("component_id")), "group").select("fp", "n", "component_id"))
    return told_by(prints, named, ["fp"]).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: A long print has four words of 64 bits. Texts whose sets of five-word shingles share 0.8 differ in about 39 of its 256
#: bits, give or take 6, and in about 10 of the first 64, give or take 3 (sets of five and four: in 48 and 12). The radii
#: only pick candidates, and are so wide that they pass such texts.
LONG, LONG_RADIUS, LONG_COARSE, LEAST_HASHES = 4, 68, 26, 8
#: The share of their shingles, 4 of 5, from which two texts are linked.
SHARE = (4, 5)
#: Shingles of a tile of candidates, and tiles from which a group of candidates is compared by bucket.
TILE_SHINGLES, MOST_TILES = 2_000_000, 16


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted hashes of the different shingles of ``size`` words; none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    joined, n = b" ".join(words), max(1, len(words) - size + 1)
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)), np.uint64, n))


def long_print(hashes: np.ndarray) -> list[int]:
    """A fingerprint of ``LONG`` words over a set of shingle hashes."""
    prints = []
    for k in range(LONG):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 65_536):
            own = mixed(hashes[at : at + 65_536] + np.uint64(k * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
            ones += np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        prints.append(int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0]))
    return prints


def _whole(hashes: np.ndarray) -> int:
    return int(np.array(xxhash.xxh64_intdigest(hashes.tobytes(), SEED), np.uint64).view(np.int64))


_PRINTS = [f"p{k}" for k in range(LONG)]


def _alike_links(texts: DataFrame, size: int) -> DataFrame:
    """Links (a, b) between candidates of one group that share 0.8 of their shingles: enough of them to connect all such.

    ``texts`` has (node, text, keys, tiles): the groups that a node is compared in and how many tiles each is cut into.
    A row whose text is not the one that its node tells is another text of the same id.
    """
    kept = ["node", "keys", "tiles"]
    names = ["bucket", "one", "two", "node", *_PRINTS]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = [shingle_set(x, size) for x in batch["text"].to_pylist()]
            mine = np.flatnonzero(np.array([_whole(x) for x in sets], np.int64) == batch["node"].to_numpy())
            prints = [long_print(sets[k]) for k in mine.tolist()]
            columns = [batch[c].take(pa.array(mine)) for c in kept] + [pa.array([p[k] for p in prints], pa.int64()) for k in range(LONG)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([sets[k].tobytes() for k in mine.tolist()], pa.binary())], [*kept, *_PRINTS, "shingles"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, found = None, [], []

        def close() -> None:
            rows, sets = np.concatenate([r for r, _ in held]), [np.frombuffer(x, np.uint64) for _, part in held for x in part.to_pylist()]
            _, first = np.unique(rows[:, 3], return_index=True)  # repeated rows
            if len(first) > 1:
                found.extend(_links(rows[first, 3], rows[first, 4:], LONG_RADIUS, LONG_COARSE, [sets[k] for k in first.tolist()]))

        def out() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [[], []]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

        for batch in batches:
            rows = np.stack([batch[c].to_numpy().astype(np.int64) for c in names], 1) if batch.num_rows else np.zeros((0, len(names)), np.int64)
            for a, b in stretches(rows[:, 0], rows[:, 1], rows[:, 2]):
                if (own := tuple(rows[a, :3].tolist())) != key:
                    if held:
                        close()
                    key, held = own, []
                held.append((rows[a:b], batch["shingles"].slice(a, b - a)))
            yield out()
        if held:
            close()
        yield out()

    sets = mapped(texts, hashed, f"node long, keys array<bigint>, tiles array<int>, {', '.join(f'{n} long' for n in _PRINTS)}, shingles binary")
    each = sets.withColumn("k", F.explode(F.arrays_zip("keys", "tiles"))).select(F.col("k.keys").alias("bucket"), F.col("k.tiles").alias("t"), "node", *_PRINTS, "shingles")
    dealt = (
        each.withColumn("tile", F.expr("cast(pmod(xxhash64(node, 7), t) AS int)")).withColumn("other", F.expr("explode(sequence(0, t - 1))"))
        .select("bucket", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "node", *_PRINTS, "shingles")
    )
    return mapped(dealt.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two"), linked, "a long, b long")


def _linked_texts(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(doc_id, digest, component_id, stays): of each row the digest of its text, the smallest id of the texts that links join, and whether it is the one to keep.

    A node is a text, told by the hash of its shingle set, and not an id, which other texts may have as well.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = [shingle_set(x, size) for x in batch["text"].to_pylist()]
            found = [long_print(x) for x in sets]
            words_ = [pa.array([p[k] for p in found], pa.int64()) for k in range(LONG)]
            least = pa.array([x[:LEAST_HASHES].view(np.int64).tolist() or [0] for x in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["digest"], pa.array([_whole(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int64()), *words_, least], ["doc_id", "digest", "whole", "size", *_PRINTS, "least"])

    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, digest binary, whole long, size long, {', '.join(f'{n} long' for n in _PRINTS)}, least array<bigint>"
    prints = written(mapped(docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("digest"), F.col(text_col).alias("text")), hashed, schema))
    nodes = written(prints.where("doc_id IS NOT NULL").groupBy("whole", *_PRINTS).agg(F.min("doc_id").cast("long").alias("id"), F.min("size").alias("size"), F.min("least").alias("least"), F.count("*").alias("n")).withColumn("node", F.col("whole")))
    twos = F.transform("least", lambda a, i: F.transform(F.slice("least", i + 2, LEAST_HASHES), lambda b: F.xxhash64(a, b)))
    buckets = F.when(F.size("least") > 1, F.array_distinct(F.flatten(twos))).otherwise(F.col("least"))
    near = components(_bucket_links(nodes.select(F.explode(buckets).alias("bucket"), "node", *_PRINTS), _PRINTS, LONG_RADIUS, LONG_COARSE))

    tiles = F.ceil(F.greatest(F.count("*") / (TILE // 2), F.sum("size") / TILE_SHINGLES)).cast("int").alias("t")
    met = written(nodes.join(near, "node").select("node", "id", "size", F.col("component").alias("key"), buckets.alias("buckets")))
    cut = met.join(met.groupBy("key").agg(tiles), "key")
    parts = cut.where(f"t > {MOST_TILES}").select("node", "id", "size", "key", F.explode("buckets").alias("b")).select("node", "id", "size", F.xxhash64("key", "b").alias("key"))
    parts = parts.join(parts.groupBy("key").agg(tiles, F.count("*").alias("all")).where("all > 1"), "key")
    groups = cut.where(f"t <= {MOST_TILES}").select("node", "id", "key", "t").unionAll(parts.select("node", "id", "key", "t"))
    groups = groups.groupBy("node", "id").agg(F.collect_list(F.struct("key", "t")).alias("k")).select("node", "id", F.col("k.key").alias("keys"), F.col("k.t").alias("tiles"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(groups, "id").select("node", "text", "keys", "tiles")
    joined = written(nodes.join(components(_alike_links(texts, size)), "node", "left").select("whole", *_PRINTS, "n", "id", "node", F.coalesce("component", "node").alias("group")))
    first = joined.groupBy("group").agg(F.min(F.struct("id", "node")).alias("first"))
    named = written(joined.join(first, "group").select("whole", *_PRINTS, "n", F.col("first.id").alias("component_id"), (F.col("first.node") == F.col("node")).alias("leads")))
    some = prints.select("doc_id", "digest", "whole", *_PRINTS)
    without = some.where("doc_id IS NULL").select("doc_id", "digest", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("stays"))
    told = told_by(some.where("doc_id IS NOT NULL"), named, ["whole", *_PRINTS])
    return told.select("doc_id", "digest", "component_id", (F.col("leads") & (F.col("doc_id") == F.col("component_id"))).alias("stays")).unionAll(without)


def similar_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """(doc_id, component_id): texts that share 0.8 or more of their different shingles of ``size`` words are linked.

    Such texts share most of their least shingle hashes, so every two of a text's are a bucket: of texts that share
    0.8, one pair in 12,000 meets in none. In a bucket long fingerprints are compared as in ``near_links``, which gives groups
    of candidates; each group's shingle sets meet once, in tiles, and are counted exactly there; very large groups meet by
    bucket, which gives the same links. Ids are integers. Null texts and texts without words are alike; a row without an id is linked to none and
    has a null component; repeated rows stay; an empty table gives none; other columns are not read.
    """
    return _linked_texts(docs, id_col, text_col, size).select("doc_id", "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """The document with the smallest id of each group of similar texts, with all its columns, whatever those are named.

    Rows of one id with other texts are each judged by their own: of similar ones one text stays, unlike ones stay all.
    Repeated rows stay or go together; every row without an id stays, as it is linked to none; of texts without words
    the one with the smallest id stays; an empty table gives none.
    """
    other = _linked_texts(docs, id_col, text_col, size).where("NOT stays").select("doc_id", "digest").distinct()
    own = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("doc_id"), F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("digest"))
    return own.join(other, ["doc_id", "digest"], "left_anti").select("doc.*")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
