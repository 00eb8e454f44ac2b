"""Stored access paths give the rows of a join and read little."""

import pytest
from pyspark.sql import functions as F

from lattix.sources import keyed


@pytest.fixture(scope="module")
def plain(spark):
    """A session whose plans keep their scans as written, so that what was read can be counted."""
    made = spark.newSession()
    made.conf.set("spark.sql.adaptive.enabled", "false")
    made.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return made


def rows_read(df):
    """Rows that the scans of a plan hand on after row groups are ruled out."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.length()))


def test_few_keys_read_few_rows(plain, tmp_path):
    n = 60_000
    frame = plain.range(n).select((F.col("id") + (3 << 48)).alias("id"), F.to_json(F.struct((F.col("id") * 3).alias("k"))).alias("properties"))
    table = keyed.KeyTable.build(frame, "k", str(tmp_path / "keys"), buckets=8, row_group_bytes=1 << 14)
    assert table.rows.count() == n
    asked = plain.createDataFrame([("3",), ("6",), ("4",), (None,), ("99",), ("3",), ("no",)], "key string")
    assert {tuple(r) for r in table.lookup(asked).collect()} == {("3", (3 << 48) + 1), ("6", (3 << 48) + 2), ("99", (3 << 48) + 33)}
    assert {tuple(r) for r in table.lookup(plain.createDataFrame([(3,), (7,)], "key long")).collect()} == {("3", (3 << 48) + 1)}
    assert table.lookup(plain.createDataFrame([], "key string")).count() == 0
    assert rows_read(table.few(["3", "99"])) < n / 4
    many = plain.range(0, 3 * n, 30).select(F.col("id").alias("key"))
    assert table.lookup(many).count() == n // 10


def test_joins_on_the_start_do_not_deal_the_edges(plain):
    edges = plain.range(5000).select((F.col("id") + (4 << 48)).alias("id"), (F.col("id") % 700).alias("start"), (F.col("id") % 11).alias("end"), F.lit("{}").alias("properties"))
    table, ends = keyed.EdgeTable.build(edges, "edges_by_start", buckets=8), keyed.EdgeTable.build(edges, "edges_by_start_and_end", ("start", "end"), 8)
    pairs = plain.range(900).select(F.col("id").alias("start"), (F.col("id") % 11).alias("end"))
    want = edges.select("start", "end", "id").join(pairs, ["start", "end"], "left_semi")
    got = ends.between(pairs)
    assert table.between(pairs).count() == want.count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    out = table.out_of(plain.range(5))
    assert out.count() == edges.where("start < 5").count()
    for df in (got, out):
        plan = df._jdf.queryExecution().executedPlan().toString()
        above = plan[: plan.index("edges_by_start")].splitlines()
        stored = next(k for k in range(len(above) - 1, -1, -1) if "Join" in above[k])
        assert not any("Exchange" in line for line in above[stored:])
    for name in ("edges_by_start", "edges_by_start_and_end"):
        plain.sql(f"DROP TABLE {name}")
