"""Vectors as ARRAY<FLOAT>: distances are computed in double from single-precision values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fold(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _paired(a: Column, b: Column, f) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: f(x.cast("double"), y.cast("double"))))


def dot(a: Column, b: Column) -> Column:
    return _paired(a, b, lambda x, y: x * y)


def norm(a: Column) -> Column:
    return F.sqrt(_fold(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(_paired(a, b, lambda x, y: (x - y) * (x - y)))


def inner_product(a: Column, b: Column) -> Column:
    """Negative, so that less is nearer."""
    return -dot(a, b)


def cosine(a: Column, b: Column) -> Column:
    """NaN where a vector is zero."""
    sizes = norm(a) * norm(b)
    return F.when(sizes == 0, float("nan")).otherwise(1 - dot(a, b) / sizes)


def l1(a: Column, b: Column) -> Column:
    return _paired(a, b, lambda x, y: F.abs(x - y))


def binary_quantize(a: Column) -> Column:
    """1 for each positive component, as text."""
    return F.array_join(F.transform(a, lambda x: F.when(x > 0, "1").otherwise("0")), "")


def packed_bits(bits: Column) -> Column:
    """Text of 0 and 1 as an array of integers of up to 60 bits each."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(bits), F.lit(1)), F.lit(60))
    return F.transform(starts, lambda i: F.conv(F.substring(bits, i, F.lit(60)), 2, 10).cast("long"))


def hamming(a: Column, b: Column) -> Column:
    """Over packed bits."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def jaccard(a: Column, b: Column) -> Column:
    """Over packed bits; 1 - |both| / |either|."""
    both = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda s, x: s + x)
    either = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseOR(y))), F.lit(0), lambda s, x: s + x)
    return F.when(either == 0, 0.0).otherwise(1 - both / either)


DISTANCES = {"l2": l2, "inner_product": inner_product, "cosine": cosine, "l1": l1, "hamming": hamming, "jaccard": jaccard}


def vector_of(text: Column, dimensions: int) -> Column:
    """A JSON list, or the same as text, as single-precision values; another width or kind fails."""
    values = F.from_json(text, "array<float>")
    return F.when(text.isNull(), None).when(F.size(values) == dimensions, values).otherwise(F.raise_error(F.concat(F.lit(f"not a vector of {dimensions}: "), F.substring(text, 1, 40))))


def half_precision(vector: Column) -> Column:
    """Narrowed to 16-bit floats and back: 11 binary digits, half to even; from 65,520 on infinite."""
    def half(x: Column) -> Column:
        wide = x.cast("double")
        step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.abs(wide))), F.lit(-14)) - 10)
        kept = F.when((wide == 0) | F.isnan(wide), wide).when(F.abs(wide) >= 65520, F.signum(wide) * float("inf"))
        return kept.otherwise(F.rint(wide / step) * step).cast("float")

    return F.transform(vector, half)


def declare_vector(df: DataFrame, name: str, dimensions: int) -> DataFrame:
    """A typed vector column whose width is checked when it is written."""
    value = F.col(name).cast("array<float>")
    return df.withColumn(name, F.when(value.isNull() | (F.size(value) == dimensions), value).otherwise(F.raise_error(F.lit(f"{name}: a vector of {dimensions} is declared"))))


def sparse_from_dense(a: Column) -> Column:
    """dimensions, zero-based indices and values; zeros are dropped."""
    full = F.filter(F.transform(a, lambda x, i: F.struct(i.alias("i"), x.alias("v"))), lambda e: e["v"] != 0)
    return F.struct(F.size(a).alias("dimensions"), F.transform(full, lambda e: e["i"]).alias("indices"), F.transform(full, lambda e: e["v"].cast("float")).alias("values"))


def sparse_to_dense(s: Column) -> Column:
    held = F.map_from_arrays(s["indices"], s["values"])
    return F.transform(F.sequence(F.lit(0), s["dimensions"] - 1), lambda i: F.coalesce(F.element_at(held, i), F.lit(0).cast("float")))


def sparse_to_text(s: Column) -> Column:
    """``{1:0.5,3:2}/4``, one-based."""
    number = lambda v: F.regexp_replace(v.cast("string"), r"\.0$", "")
    parts = F.zip_with(s["indices"], s["values"], lambda i, v: F.concat((i + 1).cast("string"), F.lit(":"), number(v)))
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}/"), s["dimensions"].cast("string"))


def sparse_from_text(text: Column) -> Column:
    """The struct of a text; explicit zeros are dropped and indices sorted. Null if it is no sparse vector."""
    shaped = text.rlike(r"^\{([0-9]+:[-+0-9.eE]+(,[0-9]+:[-+0-9.eE]+)*)?\}/[0-9]+$")
    inner = F.regexp_extract(text, r"^\{(.*)\}/", 1)
    parts = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, ","))
    pairs = F.transform(parts, lambda p: F.struct((F.substring_index(p, ":", 1).cast("int") - 1).alias("i"), F.substring_index(p, ":", -1).cast("float").alias("v")))
    full = F.array_sort(F.filter(pairs, lambda e: e["v"] != 0))
    made = F.struct(F.substring_index(text, "/", -1).cast("int").alias("dimensions"), F.transform(full, lambda e: e["i"]).alias("indices"), F.transform(full, lambda e: e["v"]).alias("values"))
    return F.when(shaped, made)


def sparse_is_valid(s: Column) -> Column:
    """Dimensions of at least one; indices in range, none repeated; values finite."""
    finite = F.forall(s["values"], lambda v: ~F.isnan(v) & (F.abs(v) != float("inf")))
    fit = F.forall(s["indices"], lambda i: (i >= 0) & (i < s["dimensions"]))
    return F.coalesce((s["dimensions"] >= 1) & fit & finite & (F.size(F.array_distinct(s["indices"])) == F.size(s["indices"])) & (F.size(s["indices"]) == F.size(s["values"])), F.lit(False))
