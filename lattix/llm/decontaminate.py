"""Benchmark decontamination with DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.llm.batches import written

WINDOW = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a word does not hold (after lower-casing): ASCII other than digits and letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Benchmark windows up to which their hash set goes to every task; beyond it both sides are shuffled by hash.
BROADCAST_WINDOWS = 200_000


def words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased and no other letter changed; null has none."""
    text = F.coalesce(text, F.lit(""))
    ascii_alone = F.octet_length(text) == F.char_length(text)  # there lower() changes A-Z alone, and is quicker
    return F.array_remove(F.split(F.when(ascii_alone, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER)), _BETWEEN), "")


def _starts(ws: Column, n: Column | int) -> Column:
    """The first places, from 1, of all runs of n words; none if there are fewer."""
    last = F.size(ws) - n + 1
    return F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))


def _gram(at: Column, n: Column) -> Column:
    """The n words of ``ws`` from place ``at``; slice() would go through the whole text for each."""
    return F.transform(F.sequence(at, at + n - 1), lambda j: F.get("ws", j - 1))


def _hash(at: Column, n: int) -> Column:
    """The hash of the n words from place ``at``: that of the array of those words."""
    return F.xxhash64(*(F.get("ws", at + (k - 1)) for k in range(n)))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """(item_id, size, hash, gram): each item's windows of n words, or its whole word sequence if it is shorter."""
    known = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("ws")).where("size(ws) > 0").withColumn("size", F.least(F.size("ws"), F.lit(n)))
    grams = known.select("item_id", "size", F.explode(F.transform(_starts(F.col("ws"), F.col("size")), lambda i: _gram(i, F.col("size")))).alias("gram"))
    return grams.select("item_id", "size", F.xxhash64("gram").alias("hash"), "gram").distinct()


def find_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Every window of every text is hashed in one scan and looked up in the hash set of the benchmark's windows; the few
    that are found are compared word by word with the windows of that hash. The set goes to all tasks only if its
    counted size is within ``broadcast_windows``; beyond that the numbered rows are written, and windows and set are
    shuffled by hash. Null and empty texts have no words; null or wordless items no windows; repeated rows and rows
    without an id are judged each; an item that is repeated counts once; empty tables on either side give no hits;
    other columns are not read. Nothing is chosen among ties.
    """
    grams = written(benchmark_windows(benchmark, n=n))
    sizes = {r["size"]: r["n"] for r in grams.groupBy("size").agg(F.count_distinct("hash").alias("n")).collect()}  # at most n rows
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    small = sum(sizes.values()) <= broadcast_windows
    found = _found_in_set(texts, grams, sorted(sizes)) if small else _found_by_shuffle(written(texts), grams, sorted(sizes))
    cut = found.withColumn("ws", words(F.col("text")))
    marks = F.transform("seen", lambda x: F.struct(x["at"].alias("at"), x["size"].alias("size"), _gram(x["at"], x["size"]).alias("gram")))
    each = cut.select("row", "doc_id", "n_words", F.explode_outer(marks).alias("w")).select("row", "doc_id", "n_words", "w.*").withColumn("hash", F.xxhash64("gram"))
    side = F.broadcast(grams) if small else grams
    hits = each.alias("d").join(side.alias("g"), (F.col("d.hash") == F.col("g.hash")) & (F.col("d.size") == F.col("g.size")) & (F.col("d.gram") == F.col("g.gram")), "left")
    covered = F.array_distinct(F.flatten(F.collect_list(F.when(F.col("g.hash").isNotNull(), F.sequence(F.col("d.at"), F.col("d.at") + F.col("d.size") - 1)))))
    items = F.collect_set(F.col("g.item_id").cast("string"))
    return (
        hits.groupBy("d.row").agg(F.first("d.doc_id").alias("doc_id"), F.first("d.n_words").alias("n_words"), F.size(covered).cast("long").alias("n_hit"), items.alias("items"))
        .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
    )


def _found_in_set(texts: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """(row, doc_id, n_words, text, seen): of each text the places whose hash is in the set; the text itself only if there are any.

    The optimizer makes a hash set of each list, which is part of the plan that every task gets.
    """
    worded = texts.withColumn("ws", words(F.col("text")))
    seen = F.array().cast("array<struct<at:int,size:int>>")
    for size in sizes:
        few = F.xxhash64(*(F.get("gram", k) for k in _telling(size))).alias("few")
        known = grams.where(F.col("size") == size).select("hash", few).distinct().collect()
        at = F.expr(_known_starts(size, [r["hash"] for r in known], [r["few"] for r in known]))
        seen = F.concat(seen, F.transform(at, _mark(size)))
    rows = worded.select("row", "doc_id", "text", F.size("ws").cast("long").alias("n_words"), seen.alias("seen"))
    return rows.withColumn("text", F.when(F.size("seen") > 0, F.col("text")))


def _telling(size: int) -> list[int]:
    """The first, middle and last word of a window: most are ruled out by these alone."""
    return sorted({0, size // 2, size - 1})


def _known_starts(size: int, known: list[int], few: list[int]) -> str:
    """Places of ``ws`` whose window is in the set. As text, since a Column for each hash takes the driver long."""
    hashed = lambda places: f"xxhash64({', '.join(f'get(ws, i + {k - 1})' for k in places)})"
    among = lambda hashes: ", ".join(f"{h}L" for h in dict.fromkeys(hashes))
    windows = f"CASE WHEN size(ws) >= {size} THEN sequence(1, greatest(size(ws) - {size - 1}, 1)) ELSE cast(array() AS array<int>) END"
    return f"filter({windows}, i -> {hashed(_telling(size))} IN ({among(few)}) AND {hashed(range(size))} IN ({among(known)}))"


def _mark(size: int) -> Callable[[Column], Column]:
    return lambda i: F.struct(i.alias("at"), F.lit(size).alias("size"))


def _hashed(size: int) -> Callable[[Column], Column]:
    return lambda i: F.struct(i.alias("at"), F.lit(size).alias("size"), _hash(i, size).alias("hash"))


def _found_by_shuffle(texts: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """The same rows where the set is too large to send: all windows meet the hashes in a join. ``texts`` is a written table, so that both branches number its rows alike."""
    worded = texts.withColumn("ws", words(F.col("text")))
    every = worded.select("row", F.explode(F.concat(*[F.transform(_starts(F.col("ws"), s), _hashed(s)) for s in sizes])).alias("w")).select("row", "w.*") if sizes else None
    plain = worded.select("row", "doc_id", F.size("ws").cast("long").alias("n_words"), "text")
    if every is None:
        return plain.withColumn("seen", F.lit(None).cast("array<struct<at:int,size:int>>"))
    met = every.join(grams.select("hash", "size").distinct(), ["hash", "size"]).groupBy("row").agg(F.collect_list(F.struct("at", "size")).alias("seen"))
    return plain.join(met, "row", "left").withColumn("text", F.when(F.col("seen").isNotNull(), F.col("text")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """The documents that hold no benchmark window, with all their columns, whatever those are named.

    A document is told by its id and a digest of its text, so rows without an id and rows of one id with other texts
    are each judged by their own text. Repeated rows stay or go together; null and empty texts stay; an empty table
    gives none, an empty benchmark all.
    """
    key = F.concat_ws(":", F.md5(F.coalesce(F.col(text_col), F.lit(""))), F.col(id_col).cast("string"))
    dirty = find_hits(docs.select(key.alias("doc_id"), F.col(text_col).alias("text")), benchmark, broadcast_windows=broadcast_windows).where("contaminated").select(F.col("doc_id").alias("key")).distinct()
    return docs.select(F.struct("*").alias("doc"), key.alias("key")).join(dirty, "key", "left_anti").select("doc.*")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_hits(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP7_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM starts),
sizes AS (SELECT DISTINCT n FROM grams),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n),
hits AS (SELECT p.doc_id, p.i, p.n, g.item_id FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM places) p JOIN grams g USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(f.n_items, 0)::BIGINT AS n_items, sha256(coalesce(f.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
"""
