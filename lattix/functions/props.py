"""Property maps: JSON text is the stored truth, everything else is derived from it on demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fields(properties: Column) -> Column:
    """Key to text of the value: strings without quotes, numbers as written, null for JSON null."""
    return F.from_json(properties, "map<string,string>")


def _own_level(properties: Column) -> Column:
    """The map's text without what its nested values hold."""
    tokens = F.regexp_extract_all(properties, F.lit(r'("(?:[^"\\]++|\\.)*+"|[{}\[\]]|[^"{}\[\]]++)'), F.lit(1))

    def step(a: Column, t: Column) -> Column:
        depth = a["d"] + F.when(t.isin("{", "["), 1).when(t.isin("}", "]"), -1).otherwise(0)
        return F.struct(depth.alias("d"), F.when(depth <= 1, F.concat(a["t"], t)).otherwise(a["t"]).alias("t"))

    return F.aggregate(tokens, F.struct(F.lit(0).alias("d"), F.lit("").alias("t")), step, lambda a: a["t"])


def _as_written(properties: Column, key: Column, text: Column) -> Column:
    """A number's own digits, where reading it as a double changed them; exponents are written out.

    The map's text is searched for a number of that key and the same value. If nested maps spell it in other ways, the
    map's own level alone is searched.
    """
    pattern = F.concat(F.lit('"\\Q'), key, F.lit('\\E"\\s*:\\s*(-?[0-9][0-9.eE+-]*)'))
    value = text.try_cast("double")
    spellings = lambda held: F.array_distinct(F.filter(F.regexp_extract_all(held, pattern, F.lit(1)), lambda s: s.try_cast("double") == value))
    found = spellings(properties)
    raw = F.get(F.when(F.size(found) > 1, spellings(_own_level(properties))).otherwise(found), F.lit(0))
    plain = F.regexp_replace(raw.try_cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    spelled = F.when(raw.rlike("[eE]") & (plain.try_cast("double") == value), plain).otherwise(raw)
    return F.when(text.rlike(r"[.]|Infinity"), F.coalesce(spelled, text)).otherwise(text)


def property_text(properties: Column, key: str) -> Column:
    """The value's text; number and string alike, null for JSON null or no such key."""
    return _as_written(properties, F.lit(key), fields(properties)[key])


def nested(properties: Column, *path: str | int) -> Column:
    """Text at a path of keys and list positions."""
    steps = "".join(f"[{p}]" if isinstance(p, int) else f"['{p}']" for p in path)
    return F.get_json_object(properties, "$" + steps)


def keys(properties: Column) -> Column:
    return F.json_object_keys(properties)


def _shape(value: Column) -> Column:
    return F.schema_of_variant(value)


def _kind_of_shape(shape: Column) -> Column:
    return (
        F.when(shape == "VOID", "null").when(shape.isin("STRING", "BOOLEAN"), F.lower(shape))
        .when(shape.startswith("ARRAY"), "array").when(shape.startswith("OBJECT"), "object").otherwise("number")
    )


def json_kind(properties: Column, key: str) -> Column:
    """string, number, boolean, null, array or object; null if there is no such key."""
    value = F.try_variant_get(F.try_parse_json(properties), f"$['{key}']", "variant")
    return F.when(value.isNotNull(), _kind_of_shape(_shape(value)))


def is_fractional(text: Column) -> Column:
    """A number is fractional if its text has a point, so 1.0 is."""
    return F.contains(text, F.lit("."))


def each_property(df: DataFrame, properties: str = "properties") -> DataFrame:
    """The rows with key, value (text) and kind of each property."""
    typed = F.map_from_entries(F.transform(F.map_entries(F.try_parse_json(properties).cast("map<string,variant>")), lambda e: F.struct(e["key"].alias("k"), _kind_of_shape(_shape(e["value"])).alias("v"))))
    held = df.withColumn("__texts", fields(F.col(properties))).withColumn("__kinds", typed)
    return held.select("*", F.explode("__texts").alias("key", "value")).withColumn("value", _as_written(F.col(properties), F.col("key"), F.col("value"))).withColumn("kind", F.coalesce(F.col("__kinds")[F.col("key")], F.lit("null"))).drop("__texts", "__kinds")


def _quoted(text: Column) -> Column:
    whole = F.to_json(F.struct(text.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def _once(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often it is named: lambda bodies are evaluated as they are written."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _raw_entries(properties: Column) -> Column:
    """Key and JSON text of each value: numbers and nested values as written."""

    def raw(e: Column, texts: Column) -> Column:
        written = lambda held: _as_written(properties, e["key"], held)
        spelled = lambda text: F.struct(e["key"].alias("key"), F.when(_shape(e["value"]) == "STRING", _quoted(text)).otherwise(F.coalesce(text, F.lit("null"))).alias("value"))
        return _once(texts[e["key"]], lambda held: _once(written(held), spelled))

    typed = F.map_entries(F.try_parse_json(properties).cast("map<string,variant>"))
    return _once(fields(properties), lambda texts: F.transform(typed, lambda e: raw(e, texts)))


def _object(entries: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: F.concat(_quoted(e["key"]), F.lit(":"), e["value"])), ","), F.lit("}"))


def map_merge(left: Column, right: Column) -> Column:
    """The left map with the right one's values over it; keys that right does not name keep theirs."""
    ours, theirs = _raw_entries(F.coalesce(left, F.lit("{}"))), _raw_entries(F.coalesce(right, F.lit("{}")))
    laid = lambda theirs, named: _object(F.concat(F.filter(ours, lambda e: ~F.array_contains(named, e["key"])), theirs))
    return _once(theirs, lambda held: _once(F.transform(held, lambda e: e["key"]), lambda named: laid(held, named)))


def without_key(properties: Column, key: str) -> Column:
    return _object(F.filter(_raw_entries(properties), lambda e: e["key"] != key))


def without_nulls(properties: Column) -> Column:
    """A map as a created element stores it: keys given as null are not stored."""
    return _object(F.filter(_raw_entries(properties), lambda e: e["value"] != "null"))


_END = "\u0001end"


def is_object(text: Column) -> Column:
    """One complete JSON object and nothing after it.

    The text is parsed as the first item of a list whose second is a mark, which is only found if the first ends where
    the text does; a text that holds the mark itself is judged by its brackets.
    """
    braced = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"\\u0001end"]')))
    marked = F.try_variant_get(listed, "$[1]", "string") == _END
    return F.coalesce(F.when(F.contains(text, F.lit("u0001")), _closed_once(text)).otherwise(braced & marked), F.lit(False))


def _closed_once(text: Column) -> Column:
    blank = F.regexp_replace(text, r'"(?:[^"\\]++|\\.)*+"', "")
    brackets = F.split(F.regexp_replace(blank, r"[^{}\[\]]", ""), "")
    start = F.struct(F.lit(0).alias("d"), F.lit(0).alias("z"))

    def step(a: Column, c: Column) -> Column:
        closes = c.isin("}", "]")
        return F.struct((a["d"] + F.when(c.isin("{", "["), 1).when(closes, -1).otherwise(0)).alias("d"), (a["z"] + F.when(closes & (a["d"] == 1), 1).otherwise(0)).alias("z"))

    balanced = F.aggregate(brackets, start, step, lambda a: (a["d"] == 0) & (a["z"] == 1))
    return F.try_parse_json(text).isNotNull() & F.startswith(text, F.lit("{")) & F.endswith(blank, F.lit("}")) & balanced


def exact_number(properties: Column, key: str, scale: int = 18) -> Column:
    """A number as DECIMAL, never by way of a double; null where it is none or does not fit."""
    return property_text(properties, key).try_cast(f"decimal(38,{scale})")


def refuse_non_finite(df: DataFrame, *columns: str) -> DataFrame:
    """Fails when a value to be stored is NaN or infinite."""
    for name in columns:
        value = F.col(name)
        bad = F.isnan(value) | (F.abs(value) == float("inf"))
        df = df.withColumn(name, F.when(bad, F.raise_error(F.lit(f"{name}: a value that is not finite can't be stored"))).otherwise(value))
    return df


def key_text(value: Column) -> Column:
    """Canonical text of a key, so that 1 and "1" meet; booleans are true and false, "01" stays."""
    return value.cast("string")


def has_property(df: DataFrame, name: str) -> bool:
    return name in df.columns


def prop(df: DataFrame, name: str) -> Column:
    """A property of a label's frame: its typed column if it has one, else its text in the map."""
    return F.col(name) if has_property(df, name) else property_text(F.col("properties"), name)


def typed_equal(df: DataFrame, name: str, value: object) -> Column:
    """Equality by type as well: '123' is not 123. A typed column compares plainly, so it is pushed to the scan."""
    if has_property(df, name):
        return F.col(name) == F.lit(value)
    kind = "boolean" if isinstance(value, bool) else "number" if isinstance(value, (int, float)) else "string"
    text = property_text(F.col("properties"), name)
    same = text.try_cast("decimal(38,10)") == F.lit(value).cast("decimal(38,10)") if kind == "number" else text == F.lit(str(value).lower() if kind == "boolean" else value)
    return (json_kind(F.col("properties"), name) == kind) & same
