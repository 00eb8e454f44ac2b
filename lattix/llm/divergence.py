"""Audit of how far the sources of a language differ in their use of terms, by bitmaps of count levels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lattix.llm.batches import mapped, stretches, written
from lattix.sources.ingest import numbered

#: Documents of a language that make a term, what is added to every count, parts of a whole, ranks of terms that are given.
LEAST_DOCS, PRIOR, WHOLE, TOP = 30, 5, 1_000_000_000, 50
#: Terms of a bitmap, in bits and bytes; terms are numbered by falling count, so those of a block have similar levels.
BLOCK = 1024
#: Sources whose bitmaps meet in one task; a language with more is cut into tiles, and every two tiles meet.
TILE = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a term does not hold: ASCII other than letters.
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """Terms of the text with A-Z lower-cased and no other letter changed; null has none."""
    text = F.coalesce(text, F.lit(""))
    ascii_alone = F.octet_length(text) == F.char_length(text)  # there lower() changes A-Z alone, and is quicker
    return F.array_remove(F.split(F.when(ascii_alone, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER)), _BETWEEN), "")


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) from (lang, source, text): how often a term occurs there, and in how many documents.

    Terms of a text are sorted, so that each different one is a row with its number of occurrences; rows are summed before the shuffle.
    """
    found = docs.select("lang", "source", terms(F.col("text")).alias("ws")).where("size(ws) > 0").withColumn("ws", F.sort_array("ws"))
    first = F.filter(F.sequence(F.lit(0), F.size("ws") - 1), lambda i: (i == 0) | (F.get("ws", i) != F.get("ws", i - 1)))
    runs = F.transform("at", lambda i, k: F.struct(F.get("ws", i).alias("term"), (F.coalesce(F.get("at", k + 1), F.size("ws")) - i).alias("n")))
    each = found.withColumn("at", first).select("lang", "source", F.explode(runs).alias("e"))
    return each.groupBy("lang", "source", "e.term").agg(F.sum("e.n").alias("n"), F.count("*").alias("docs"))


def _share(count: str, total: str, kept: str) -> Column:
    """1 + floor(WHOLE * (count + PRIOR) / (total + PRIOR * kept)) in whole numbers of any size."""
    return F.expr(f"cast({WHOLE} * (cast({count} AS decimal(20,0)) + {PRIOR}) AS decimal(38,0)) div (cast({total} AS decimal(20,0)) + {PRIOR} * {kept}) + 1")


def _shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The same for the levels of one source; without terms there is nothing to share."""
    return np.array([WHOLE * (c + PRIOR) // (total + PRIOR * kept) + 1 if kept else 0 for c in counts.tolist()], np.int64)


class Levels:
    """Bitmaps of some sources over one block: a row for each count that a source has there, sources in order."""

    def __init__(self, source: np.ndarray, counts: np.ndarray, bits: np.ndarray, totals: list[int], kept: int):
        self.n = len(totals)
        held = counts > 0
        self.bits, of = bits[held], source[held]
        cuts = np.searchsorted(of, np.arange(self.n + 1))
        self.cuts = cuts.tolist()
        self.full = np.flatnonzero(np.diff(cuts))  # sources with any term of the block
        self.p = np.concatenate([np.zeros(0, np.int64)] + [_shares(counts[held][a:b], totals[k], kept) for k, (a, b) in enumerate(zip(self.cuts, self.cuts[1:], strict=False))])
        self.none = np.array([_shares(np.zeros(1, np.int64), t, kept)[0] for t in totals], np.int64)
        self.size = np.bitwise_count(self.bits).sum(1, dtype=np.int64)

    def by_source(self, rows: np.ndarray, first: int) -> np.ndarray:
        """Sums along the last axis over each source from ``first`` on; rows begin with that source's."""
        out = np.zeros((*rows.shape[:-1], self.n - first), np.int64)
        full = self.full[self.full >= first]
        if len(full):
            out[..., full - first] = np.add.reduceat(rows, np.array(self.cuts)[full] - self.cuts[first], axis=-1)
        return out


def divergences(a: Levels, i: int, b: Levels, first: int, universe: int) -> np.ndarray:
    """Sum of abs(p - q) over the block's terms between source i of a and each source of b from ``first`` on.

    AND and popcount of two levels give the terms that have this count here and that count there; terms that one or
    both don't have are what is left of the other's levels, or of the block.
    """
    low, high = a.cuts[i], a.cuts[i + 1]
    at = b.cuts[first]
    bits, p, size = b.bits[at:], b.p[at:], b.size[at:]
    both = np.zeros(len(p), np.int64)  # of each level of b the terms that a has too
    out = np.zeros(b.n - first, np.int64)
    step = max(1, 500_000 // max(1, len(p)))
    for k in range(low, high, step):
        last = min(high, k + step)
        joint = np.bitwise_count(a.bits[k:last, None, :] & bits[None, :, :]).sum(2, dtype=np.int64)
        both += joint.sum(0)
        own = a.p[k:last, None]
        out += b.by_source((joint * np.abs(own - p)).sum(0), first)
        out += ((a.size[k:last, None] - b.by_source(joint, first)) * np.abs(own - b.none[None, first:])).sum(0)
    alone = size - both
    out += b.by_source(alone * np.abs(a.none[i] - p), first)
    return out + (universe - int(a.size[low:high].sum()) - b.by_source(alone, first)) * np.abs(a.none[i] - b.none[first:])


def _pairs(levels: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a language.

    ``levels`` has (lang, block, universe, kept, source, total, n, bits) with a row of count 0 for each source and block.
    A task gets the bitmaps of one block and two tiles of sources, and blocks are summed afterwards.
    """
    tiles = levels.select("lang", "source").distinct().groupBy("lang").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    dealt = (
        levels.join(tiles, "lang").withColumn("tile", F.expr("cast(pmod(xxhash64(source), tiles) AS int)")).withColumn("other", F.expr("explode(sequence(0, tiles - 1))"))
        .withColumn("one", F.least("tile", "other")).withColumn("two", F.greatest("tile", "other"))
        .select("lang", "block", "one", "two", "tile", "source", "n", "total", "kept", "universe", "bits")
    )
    keys = ["lang", "block", "one", "two"]

    def compared(rows: pa.Table) -> pa.RecordBatch:
        lang, one, two, kept, universe = (rows[c][0].as_py() for c in ("lang", "one", "two", "kept", "universe"))
        tile = rows["tile"].to_numpy()

        def side(which: int) -> tuple[list[str], Levels]:
            own = rows.filter(pa.array(tile == which))
            names = own["source"].combine_chunks().dictionary_encode()
            at = names.indices.to_numpy()
            totals = [t.as_py() for t in own["total"].take(pa.array(np.unique(at, return_index=True)[1]))]
            bits = np.frombuffer(b"".join(own["bits"].to_pylist()), np.uint64).reshape(-1, BLOCK // 64)
            return names.dictionary.to_pylist(), Levels(at, own["n"].to_numpy(), bits, totals, kept)

        names, a = side(one)
        others, b = (names, a) if one == two else side(two)
        found = []
        for i, name in enumerate(names):
            first = i + 1 if one == two else 0
            if first < len(others):
                values = divergences(a, i, b, first, universe).tolist() if kept else [0] * (len(others) - first)
                found += [x for other, v in zip(others[first:], values, strict=True) for x in ((name, other, v), (other, name, v))]
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], ["lang", "source", "item", "value"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [batch["lang"].dictionary_encode().indices.to_numpy(), *(batch[c].to_numpy() for c in keys[1:])]
            for low, high in stretches(*codes):
                own = tuple(batch[c][low].as_py() for c in keys)
                if own != key:
                    if held:
                        yield compared(pa.Table.from_batches(held))
                    key, held = own, []
                held.append(batch.slice(low, high - low))
        if held:
            yield compared(pa.Table.from_batches(held))

    parts = mapped(dealt.repartition(*keys).sortWithinPartitions(*keys, "tile", "source", "n"), each, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from each other one of its language, and its own terms.

    Terms of a language are those in at least ``least_docs`` of its documents. Of each (lang, source) with any row, part
    ``pair`` has the sum over these terms of the distance to each other source, in parts of ``WHOLE``, and part ``term``
    the ``top`` terms that it has more of than its language. Counts are of whole texts. Null and empty texts have no
    terms but their group counts; null languages and sources are ''; a language without terms has pairs of value 0;
    repeated rows each count; ties rank by item; an empty table gives none; other columns are not read.
    """
    own = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), F.col(text_col).alias("text"))
    counts = written(term_counts(own))
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).select("lang", "term", "all", (-F.col("all")).alias("less"))
    named = numbered(kept, ["lang", "less", "term"], "at", 0)[0].select("lang", "term", "all", F.expr(f"at div {BLOCK}").alias("block"), F.expr(f"at % {BLOCK}").alias("bit"))
    held = written(counts.where("n > 0").select("lang", "source", "term", "n").join(named, ["lang", "term"]))

    langs = named.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("lang_total"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = own.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = written(groups.select("lang", "source", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "kept", "lang_total"))))

    more = held.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (_share("n", "total", "kept") - _share("all", "lang_total", "kept")).alias("value")).where("value > 0")

    blocks = named.groupBy("lang", "block").agg(F.count("*").alias("universe"))
    empty = groups.join(blocks, "lang", "left").select("lang", F.coalesce("block", F.lit(-1).cast("long")).alias("block"), F.coalesce("universe", F.lit(0).cast("long")).alias("universe"), "kept", "source", "total", F.lit(0).cast("long").alias("n"), F.lit(bytes(BLOCK // 8)).alias("bits"))
    bitmaps = held.groupBy("lang", "block", "source", "n").agg(F.expr(f"substring(bitmap_construct_agg(bit), 1, {BLOCK // 8})").alias("bits"))
    levels = bitmaps.join(groups, ["lang", "source"]).join(blocks, ["lang", "block"]).select(*empty.columns).unionAll(empty)

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(_pairs(levels), "pair").unionAll(ranked(more, "term").where(F.col("rank") <= top))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM docs),
whole AS (SELECT lang, source, term, coalesce(n, 0)::HUGEINT AS n FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p FROM whole WINDOW w AS (PARTITION BY lang, source)),
all_ AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS q FROM all_ WINDOW w AS (PARTITION BY lang)),
far AS (SELECT lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
own AS (SELECT lang, source, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
UNION ALL SELECT lang, source, 'term', item, value::BIGINT, rank::INT FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM own) WHERE rank <= 50
"""
