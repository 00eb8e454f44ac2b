"""Document fingerprints by one-permutation MinHash, with DataFrame functions alone."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.llm.batches import written
from lattix.sources.ingest import numbered

#: Words of a shingle, bins, and low-order bits that are stored of each bin's least hash.
SHINGLE, BINS, BITS = 5, 256, 4
#: The least prime over the bins: multiples of a number between are all bins in another order.
_PRIME = 257
#: Draws of an empty bin that are looked up one by one, before all filled bins are compared.
_DRAWS = 8
#: A hash holds its bin in the highest eight bits; the value of a bin that nothing fell into is all ones.
_NONE = (1 << 56) - 1

#: Each bin's own multiplier, and its inverse, which tells at which draw a bin comes.
_TIMES = random.Random(12).sample(range(1, _PRIME), BINS)
_BACK = [pow(x, -1, _PRIME) for x in _TIMES]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _array(numbers: list[int], kind: str = "") -> str:
    return f"array({', '.join(f'{x}{kind}' for x in numbers)})"


def _words(text: Column) -> Column:
    ascii_alone = F.octet_length(text) == F.char_length(text)  # there lower() changes A-Z alone, and is quicker
    return F.array_remove(F.split(F.when(ascii_alone, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER)), r"[\x20\x09-\x0D]+"), "")


def _drawn() -> str:
    """The bits of bin i of ``low``; an empty bin draws bins in its own order, the same for all texts, until one is filled.

    Late draws come from a look at all filled bins: the one that is drawn first is the one of least place in the order.
    """
    draws = [f"get(low, ({t} * get({_array(_TIMES)}, i)) % {_PRIME} - 1)" for t in range(1, _DRAWS + 1)]
    rest = f"array_min(transform(filled, v -> ((shiftright(v, 56) + 129) * get({_array(_BACK)}, i)) % {_PRIME} * {1 << BITS} + (v & {(1 << BITS) - 1}))) % {1 << BITS}"
    return f"coalesce(get(low, i), {', '.join(draws)}, {rest})"


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the packed fingerprint of a text column: ``BINS`` times ``BITS`` bits in 64-bit integers.

    Every shingle is hashed once. A bin is the high bits of a hash and keeps its least; the hashes are sorted together
    with one mark for each bin, behind all its hashes, so that the first of each bin is its least hash or the mark. No words: zeros.
    """
    own = [f"__{x}" for x in ("ws", "hashes", "least")]
    kept = df.columns
    n = F.size(own[0])
    hashes = F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))), lambda i: F.xxhash64(*(F.get(own[0], i + k) for k in range(SHINGLE)))))
    hashes = hashes.when(n > 0, F.array(F.xxhash64(own[0]))).otherwise(F.array().cast("array<bigint>"))
    marks = F.expr(_array([((j - BINS // 2) << 56) + _NONE for j in range(BINS)], "L"))
    least = F.filter(own[1], lambda v, i: (i == 0) | (F.shiftright(v, 56) != F.shiftright(F.get(own[1], i - 1), 56)))
    out = df.withColumn(own[0], _words(F.col(text))).withColumn(own[1], F.sort_array(F.concat(hashes, marks))).withColumn(own[2], least)
    out = out.withColumn("low", F.expr(f"transform({own[2]}, v -> IF((v & {_NONE}L) = {_NONE}L, NULL, v & {(1 << BITS) - 1}))")).withColumn("filled", F.expr(f"filter({own[2]}, v -> (v & {_NONE}L) <> {_NONE}L)"))
    each = 64 // BITS
    packed = f"transform(sequence(0, {BINS // each - 1}), k -> aggregate(sequence({each} * k, {each} * k + {each - 1}), 0L, (bits, i) -> shiftleft(bits, {BITS}) | {_drawn()}))"
    return out.select(*kept, F.expr(f"IF(size(filled) = 0, array_repeat(0L, {BINS // each}), {packed})").alias(name))


def as_hex(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of shingles that two texts have in common, from their packed fingerprints: 0 to 1.

    Bins that differ anyway agree in their few bits by chance, one in 2 ** ``BITS``; that share is taken off. Texts
    without words are like each other and like nothing else.
    """
    ones = F.lit(sum(1 << k for k in range(0, 64, BITS)) - (1 << 64 if BITS == 1 else 0))

    def unequal(x: Column, y: Column) -> Column:
        differ = x.bitwiseXOR(y)
        spread = differ
        for k in range(1, BITS):
            spread = spread.bitwiseOR(F.shiftrightunsigned(differ, k))
        return F.bit_count(spread.bitwiseAND(ones))

    other = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << BITS)
    blank = F.array_repeat(F.lit(0).cast("long"), BINS * BITS // 64)
    return F.when(a == b, 1.0).when((a == blank) | (b == blank), 0.0).otherwise(F.greatest(F.lit(0.0), (1 - other / BINS - chance) / (1 - chance)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint): of each row the hexadecimal fingerprint of its whole text, in the one scan.

    Null and empty texts and texts without words have zeros; equal texts have equal fingerprints; fewer words than a
    shingle has are one; repeated rows and rows without an id stay; an empty table gives none; other columns are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return with_fingerprint(own, "text", "packed").select("doc_id", as_hex(F.col("packed")).alias("fingerprint"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the first characters of the next document's text in place of its own last quarter. Only ids, lengths and digests are
    put in order; texts are shuffled once by digest of id and text, and each start of a text is sent to the
    document before it. Null texts are empty ones; rows of one id are ordered by that digest, and repeated
    rows follow each other, so that all but the last of them have their own text next; rows without an id come first;
    a lone document follows itself; very long texts are taken whole; an empty table gives none; other columns are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.withColumn("k", F.unhex(F.md5(F.concat_ws(":", F.md5("text"), F.col("doc_id").cast("string")))))
    sizes = own.groupBy("k").agg(F.min("doc_id").alias("doc_id"), F.min(F.char_length("text")).alias("n"), F.count("*").alias("copies"))
    placed, total = numbered(sizes, ["doc_id", "k"], "place", 0)
    before = placed.select(F.expr(f"(place + 1) % {max(1, total)}").alias("place"), F.col("k").alias("to"), F.col("n").alias("room"))
    order = written(placed.join(before, "place").drop("place"))

    texts = own.select("k", "text").dropDuplicates(["k"]).join(order, "k")
    starts = texts.select(F.col("to").alias("k"), F.expr("substring(text, 1, room div 4)").alias("start"))
    follow = F.expr("IF(copies > 1, array(named_struct('start', start, 'own', false), named_struct('start', substring(text, 1, n div 4), 'own', true)), array(named_struct('start', start, 'own', false)))")
    rows = texts.join(starts, "k").withColumn("f", F.explode(follow))
    rows = rows.select("k", "doc_id", "n", "copies", "to", "f.own", "text", F.expr("concat(substring(text, 1, n - n div 4), f.start)").alias("edited"))
    printed = with_fingerprint(with_fingerprint(rows, "text", "fp"), "edited", "edited_fp")
    done = written(printed.select("k", "doc_id", "n", "copies", "to", "own", "fp", "edited_fp", F.unhex(F.sha2("edited", 256)).alias("sha")))

    following = done.where("NOT own").select(F.col("to").alias("k"), F.col("fp").alias("next_fp"))
    near = F.when(F.col("own"), 1.0).otherwise(likeness(F.col("fp"), F.col("next_fp")))
    out = done.join(following, "k").select(
        F.explode(F.expr("IF(own, sequence(2, copies), array(1L))")), "doc_id", F.col("n").cast("long").alias("n_chars"), F.lower(F.hex("sha")).alias("edited_sha256"), as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), near.alias("near_next"),
    )
    return out.drop("col")


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
