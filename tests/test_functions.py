"""Identities, property maps, rendered text and vectors on hand-made rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lattix.functions import ids, props, vectors
from lattix.operators import export, logs, nearest
from lattix.sources import ingest, rendered


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'long'}" for k, v in values.items()))
    return df.select(expression).first()[0]


@pytest.mark.parametrize("text", ["1.1", "3.281474976710655", "65535.281474976710655", "0.0", "007.5"])
def test_good_identities(spark, text):
    lab, loc = map(int, text.split("."))
    packed = one(spark, ids.parse_id(F.col("t")), t=text)
    assert packed % (1 << 64) == (lab << 48) | loc
    assert one(spark, ids.format_id(F.col("i")), i=packed) == f"{lab}.{loc}"
    assert int(one(spark, ids.unsigned(F.col("i")), i=packed)) == (lab << 48) | loc


@pytest.mark.parametrize("text", ["", "7", "7.", ".9", "7.9.5", "-7.9", "7.-9", "65536.1", "1.281474976710656", " 7.9", "7.9\n", "٧.٩", "a.b", None])
def test_bad_identities(spark, text):
    assert one(spark, ids.parse_id(F.col("t")), t=text) is None


def test_identities_order_without_a_sign(spark):
    df = spark.createDataFrame([(40000, 1), (3, 5), (3, 4), (65535, 0)], "a int, b long").select("a", "b", ids.pack(F.col("a"), F.col("b")).alias("id"))
    assert [(r.a, r.b) for r in df.orderBy(*ids.order(F.col("id"))).collect()] == [(3, 4), (3, 5), (40000, 1), (65535, 0)]


@pytest.mark.parametrize(("text", "good"), [('{"a":1}', True), ('{}', True), ('{"a":"},{"}', True), ('{"a":"\\""}', True), ('{"a":1}x', False), ('{"a":1}{"b":2}', False), ("null", False), ('{"a":1', False), ("[1]", False), ("", False), (None, False)])
def test_complete_objects(spark, text, good):
    assert one(spark, props.is_object(F.col("t")), t=text) is good


def test_numbers_keep_their_digits(spark):
    p = '{"a":1.50,"b":12345678901234567890.123456789,"c":1e2,"d":"1.50","e":null,"f":7,"g":true}'
    told = {k: one(spark, props.property_text(F.col("p"), k), p=p) for k in "abcdefgh"}
    assert told == {"a": "1.50", "b": "12345678901234567890.123456789", "c": "100", "d": "1.50", "e": None, "f": "7", "g": "true", "h": None}


def test_merging_keeps_unmentioned_keys_and_digits(spark):
    merged = one(spark, props.map_merge(F.col("l"), F.col("r")), l='{"a":1.50,"b":"x\\"y","c":[1,{"d":2}]}', r='{"b":null,"e":"é"}')
    import json

    assert json.loads(merged) == {"a": 1.5, "b": None, "c": [1, {"d": 2}], "e": "é"} and "1.50" in merged


def test_equality_minds_the_type(spark):
    df = spark.createDataFrame([('{"v":123}',), ('{"v":"123"}',), ('{"v":true}',), ('{"v":"true"}',), ('{"v":null}',)], "properties string")
    count = lambda value: df.where(props.typed_equal(df, "v", value)).count()
    assert [count(123), count("123"), count(True), count("true"), count("null")] == [1, 1, 1, 1, 0]


def test_non_finite_values_are_refused(spark):
    df = spark.createDataFrame([(float("nan"),)], "v double")
    with pytest.raises(Exception, match="not finite"):
        props.refuse_non_finite(df, "v").collect()


GOOD_VERTICES = [("person[3.1]{}", "person", {}), ('a[1.2]b[3.1]{"k":"[3.9]{"}', "a[1.2]b", None), ('x{y[3.1]{"a": 1}', "x{y", None), ('l,"q[7.9]{"n":[1,2]}', 'l,"q', None), ("a\nb[3.1]{}", "a\nb", None)]
BAD_VERTICES = ["", "person", "person[3.1]", "[3.1]{}", "person[3]{}", "person[3.1]{}x", "person[3.1]{", "person[65536.1]{}", "person[3.1]null"]


def test_vertices_from_text(spark):
    df = spark.createDataFrame([(t,) for t, *_ in GOOD_VERTICES] + [(t,) for t in BAD_VERTICES], "raw string")
    good, bad = rendered.decode_vertices(df)
    assert {r.raw: r.label for r in good.collect()} == {t: label for t, label, _ in GOOD_VERTICES}
    assert sorted(r.raw for r in bad.collect()) == sorted(BAD_VERTICES)


def test_paths_from_text(spark):
    good = ['[a[3.1]{}]', '[a[3.1]{"x":"],["},r[4.1][3.1,3.2]{},b[3.2]{}]', "[]"]
    bad = ["[a[3.1]{},r[4.1][3.1,3.2]{}]", "[a[3.1]{},NULL,b[3.2]{}]", "a[3.1]{}", "[a[3.1]{},r[4.1]{},b[3.2]{}]"]
    df = spark.createDataFrame(list(enumerate(good + bad)), "row int, raw string")
    paths, rejects = rendered.decode_paths(df)
    assert {r.row: ([v.label for v in r.vertices], [e.end for e in r.edges]) for r in paths.collect()} == {0: (["a"], []), 1: (["a", "b"], [(3 << 48) + 2]), 2: ([], [])}
    assert sorted(r.raw for r in rejects.collect()) == sorted(bad)
    assert rendered.split_elements("[a[1.1]{},NULL]") == ["a[1.1]{}", None]
    assert rendered.split_elements('[a,b[7.9]{"x":"}],"},a{b[7.9]{},a"b[7.9]{}]') == ['a,b[7.9]{"x":"}],"}', "a{b[7.9]{}", 'a"b[7.9]{}']


def test_sparse_text(spark):
    s = vectors.sparse_from_text(F.col("t"))
    assert tuple(one(spark, s, t="{3:2,1:1,2:0}/4")) == (4, [0, 2], [1.0, 2.0])
    assert one(spark, vectors.sparse_to_text(s), t="{1:0.5,3:2}/4") == "{1:0.5,3:2}/4"
    assert one(spark, s, t="1:2/3") is None and tuple(one(spark, s, t="{}/3")) == (3, [], [])


def test_wrong_widths_are_refused(spark):
    with pytest.raises(Exception, match="not a vector of 3"):
        one(spark, vectors.vector_of(F.col("t"), 3), t="[1,2]")
    assert one(spark, vectors.vector_of(F.col("t"), 3), t="[1,2,3]") == [1.0, 2.0, 3.0]


def test_bits(spark):
    bits = lambda c: vectors.packed_bits(F.col(c))
    assert one(spark, vectors.hamming(bits("a"), bits("b")), a="1010" * 40, b="1001" * 40) == 80
    assert one(spark, vectors.jaccard(bits("a"), bits("b")), a="1100", b="1010") == pytest.approx(2 / 3)
    df = spark.createDataFrame([([1.0, -2.0, 3.0, -4.0],)], "v array<float>")
    assert df.select(vectors.binary_quantize(F.col("v"))).first()[0] == "1010"


def test_zero_vectors_have_no_cosine(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<float>, b array<float>")
    import math

    assert math.isnan(df.select(vectors.cosine(F.col("a"), F.col("b"))).first()[0])


def test_a_nested_value_lends_no_digits(spark):
    p = '{"o": {"a": 1.5, "s": "}{\\""}, "a": 1.50, "l": [{"a": 15e-1}], "b": 2.0}'
    assert one(spark, props.property_text(F.col("p"), "a"), p=p) == "1.50"
    assert one(spark, props.property_text(F.col("p"), "b"), p=p) == "2.0"


def test_one_object_and_nothing_after_it(spark):
    whole = ["{}", '{"a": {"b": [1, "}"]}}', '{"a": "\\u0001end"}', '{"x": "u0001"}']
    other = ["", "[]", "{", '{"a":1}!', "{}{}", "{},{}", "{}],[{}", '{},"\u0001end"],[{}', '{},"\\u0001end"],[{}', '{},"\\u0001\\u0065nd"],[{}', " {}", "{} ", '{"a"}', None]
    rows = spark.createDataFrame([(t,) for t in whole + other], "t string")
    assert [r[0] for r in rows.select(props.is_object(F.col("t"))).collect()] == [True] * len(whole) + [False] * len(other)


def test_unclosed_lists_are_no_paths():
    assert rendered.split_elements("[") is None
    assert rendered.split_elements("[]") == []
    for text in ('[a[1.1]{"x":"}]', '[a[1.1]{"x":"\\"}]', "[a[1.1]{{}]"):
        assert rendered.split_elements(text) is None
    assert rendered.split_elements("[NULL,aNULL,b[1.2]{},NULL]") == [None, "aNULL,b[1.2]{}", None]


def test_a_path_with_an_odd_element_is_rejected(spark):
    rows = [(1, "[]"), (2, "[a[3.1]{}]"), (3, "[a[3.1]{},b[4.1][3.1,3.2]{},a[3.2]{}]"), (4, "[a[3.1]{},a[3.2]{},a[3.2]{}]"), (5, "[a[3.1]{},NULL,a[3.2]{}]"), (6, "[a[3.1]{},b[4.1][3.1,3.2]{}]"), (7, None)]
    good, bad = rendered.decode_paths(spark.createDataFrame(rows, "row int, raw string"))
    told = {r.row: (len(r.vertices), len(r.edges)) for r in good.collect()}
    assert told == {1: (0, 0), 2: (1, 0), 3: (2, 1)}
    assert sorted(r.row for r in bad.collect()) == [4, 5, 6, 7]


def test_half_precision_is_that_of_numpy(spark):
    rng = np.random.default_rng(3)
    wide = np.concatenate([rng.normal(size=300), rng.normal(size=300) * 1e-6, rng.normal(size=300) * 3e4, [0.0, 65504, 65519, 65520, -70000, 2**-24, 2**-25, 3 * 2**-26, 1 + 2**-11, 1 + 3 * 2**-11, math.inf, math.nan]]).astype(np.float32)
    rows = spark.createDataFrame([([float(x) for x in wide],)], "v array<float>")
    got = rows.select(vectors.half_precision(F.col("v"))).first()[0]
    with np.errstate(over="ignore"):
        assert np.array_equal(np.array(got, np.float32), wide.astype(np.float16).astype(np.float32), equal_nan=True)


def test_json_of_paths_and_vectors(spark):
    row = spark.range(1).select(F.expr("array(named_struct('id', 844424930131969L, 'label', 'a\"b', 'properties', '{\"k\":1.50}'), null)").alias("vertices"), F.expr("array(named_struct('id', 1125899906842625L, 'label', 'e', 'start', 844424930131969L, 'end', 844424930131970L, 'properties', cast(null as string)))").alias("edges"))
    assert export.to_json_records(row, kind="path").first()[0] == '{"vertices":[{"id":"3.1","label":"a\\"b","properties":{"k":1.50}},null],"edges":[{"id":"4.1","label":"e","start":"3.1","end":"3.2","properties":{}}]}'
    v = spark.range(1).select(F.expr("array(1.5f, -2f, null)").alias("v"))
    assert export.to_json_records(v, kind="vector", column="v").first()[0] == "[1.5,-2.0,null]"
    sparse = v.select(vectors.sparse_from_dense(F.expr("array(0f, 2f)")).alias("s"))
    assert export.to_json_records(sparse, kind="sparse", column="s").first()[0] == '{"dimensions":2,"indices":[1],"values":[2.0]}'


def test_keys_are_of_types_that_maps_hold(spark):
    frame = spark.sql("SELECT 1L AS id, current_date() AS d, TRUE AS b")
    assert ingest.keyed(frame, "b").first()["key"] == "true"
    with pytest.raises(TypeError):
        ingest.keyed(frame, "d")


def test_queries_in_several_rounds_find_the_same(spark, monkeypatch):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    asked = e.where("id % 5 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    found = lambda: sorted((r.query_id, r.rank, r.id) for r in nearest.nearest_join(asked, e, "embedding", 3, block=4).collect())
    at_once = found()
    monkeypatch.setattr(nearest, "_BROADCAST", 5 * 8 * 64)
    assert found() == at_once
    assert len(at_once) == 3 * asked.count()
    assert nearest.nearest_join(asked.limit(0), e, "embedding", 3).count() == 0


#: Lists of elements that are easily misread, and how many elements they have: own cases, labels with brackets, braces, commas and quotes.
LISTS = [
    ("[a]{b[3.1]{}]", ["a]{b[3.1]{}"]), ('[x]{"[3.1]{"k":"]{"},NULL]', ['x]{"[3.1]{"k":"]{"}', None]), ("[{},{[3.1]{}]", ["{},{[3.1]{}"]), ("[a[3.1]{x},b[3.2]{}]", ["a[3.1]{x},b[3.2]{}"]),
    ("[a[3.1]{}[b[3.2]{}]", ["a[3.1]{}[b[3.2]{}"]), ('[q"[3.1]{},q"[3.2]{}]', ['q"[3.1]{}', 'q"[3.2]{}']), ("[[[3.1]{}]", ["[[3.1]{}"]), ('[v[5.1]{"a":"},{"},e[6.1][5.1,5.5]{},v[5.5]{}]', ['v[5.1]{"a":"},{"}', "e[6.1][5.1,5.5]{}", "v[5.5]{}"]),
    ('[a\\\\[3.1]{"k":"\\\\"},b[3.2]{"k":"\\\\\\""}]', ['a\\\\[3.1]{"k":"\\\\"}', 'b[3.2]{"k":"\\\\\\""}']), ("[NULLx[3.1]{},NULL,NULL]", ["NULLx[3.1]{}", None, None]), ("[é,ß[3.1]{\"ü\":\"]\"}]", ['é,ß[3.1]{"ü":"]"}']), ("[,a[3.1]{}]", [",a[3.1]{}"]), ("[]", []), ("[NULL]", [None]),
]
NO_LISTS = ["", "[", "]", "[[]", "[]]", "a[3.1]{}", "[a[3.1]{},]", "[a[3.1]{}", "[a[3.1]{}x]", "[a[3.1]]", "[a{}]", "[[3.1]{}]", '[a[3.1]{"k":"}]', "[a[3.1]{}},b[3.2]{}", "[l[1][3.1]{},[4.1][3.1,3.2]{}]", "[NULL,]", "[null]"]


def test_elements_of_lists_one_by_one_and_all_at_once(spark):
    lists = LISTS + [(text, None) for text in NO_LISTS]
    for text, want in lists:
        assert rendered.split_elements(text) == want, text
    rng = random.Random(4)
    label = lambda: "".join(rng.choices("ab,[]{}\"\\.1NUL é", k=rng.randrange(1, 5))) if rng.random() < 0.4 else "person"
    value = lambda: rng.choice(["{}", '{"k":1}', '{"k":"},{"}', '{"a":[1,{"b":"]"}],"c":"\\""}', '{"é":"[3.1]{}"}', "{x}", "{"])
    element = lambda: "NULL" if rng.random() < 0.1 else f"{label()}[{rng.randrange(9)}.{rng.randrange(99)}]{rng.choice(['', '[3.1,4.22]', '[3.1]'])}{value()}"
    made = ["[" + ",".join(element() for _ in range(rng.randrange(6))) + "]" for _ in range(3000)] + [text for text, _ in lists]
    rows = list(enumerate([*made, None]))
    rng.shuffle(rows)
    got = spark.createDataFrame(rows, "k int, raw string").repartition(3).select("raw", rendered.element_texts("raw").alias("e")).collect()
    assert all(r.e == rendered.split_elements(r.raw) for r in got)
    assert sum(r.e is not None for r in got) > 1000


def test_paths_with_any_label(spark):
    rows = [(1, "[a]{b[3.1]{}]"), (2, '[x,y[3.1]{"k":1.50},r]{[4.1][3.1,3.2]{},"z[3.2]{}]'), (3, "[a[3.1]{},]")]
    good, bad = rendered.decode_paths(spark.createDataFrame(rows, "row int, raw string"))
    told = {r.row: [x.label for x in r.vertices] + [x.label for x in r.edges] for r in good.collect()}
    assert told == {1: ["a]{b"], 2: ["x,y", '"z', "r]{"]} and [r.row for r in bad.collect()] == [3]


def test_quantiles_by_histograms_are_exact(spark):
    rng = np.random.default_rng(8)
    values = {"even": rng.normal(0, 1, 3001), "tail": np.exp(rng.normal(0, 9, 2000)), "ties": np.repeat([1.0, 2.0, 7.5], [500, 1, 99]), "one": np.array([4.25]), "two": np.array([-1.0, 3.0]), None: np.array([5.0, 6.0, 9.0])}
    rows = [(k, float(x)) for k, v in values.items() for x in v] + [("even", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    shares = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {(r.g, r.share): r.quantile for r in logs.exact_quantiles(df, "g", "v", shares, bins=50).collect()}
    assert set(got) == {(k, s) for k in values for s in shares}
    assert all(math.isclose(got[k, s], np.quantile(v, s), rel_tol=1e-12) for k, v in values.items() for s in shares)


def test_nearest_rows_by_slices_are_those_measured_pair_by_pair(spark, monkeypatch):
    """No pair of a query and a row is a row of Spark's own; copies, ties, missing and odd vectors give the same rows."""
    monkeypatch.setattr(nearest, "SLICE_ROWS", 70)
    monkeypatch.setattr(nearest, "SLICE_QUERIES", 9)
    rng = random.Random(8)
    rows = [(k, [float(rng.randint(-3, 3)) for _ in range(8)]) for k in range(400)] + [(400 + k, [1.0] * 8) for k in range(60)]
    odd = [(900, None), (901, [1.0] * 7), (902, [float("nan")] * 8), (903, [None] * 8), (904, [float("inf")] * 8), (905, [1.0] * 8)]
    df = spark.createDataFrame(rows + odd, "id long, v array<float>")
    queries = df.where("id % 17 = 0 OR id >= 900").select(F.col("id").alias("query_id"), F.col("v").alias("query"))
    told = lambda found: sorted((r.query_id, r["rank"], r.id, str(r.distance)) for r in found.collect())
    assert told(nearest.nearest_join(queries, df, "v", 5)) == told(nearest._pair_by_pair(queries, df, "v", 5, "l2", "id", 256))
    plain = df.where("id < 900")
    asked = plain.where("id % 17 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("query"))
    found = nearest.nearest_join(asked, plain, "v", 5)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()
    every = nearest.Cells(plain, "v", lists=4).search(asked, 5, probes=4)
    assert told(every) == told(found) and "FlatMapCoGroups" in every._jdf.queryExecution().toString()
