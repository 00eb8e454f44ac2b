"""Classes, distances and the vector index against plain versions."""

import random
from collections import defaultdict, deque

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lattix.operators import match, nearest, reach, vector_index
from lattix.plans import match_queries, vector_queries


def tarjan(nodes, links):
    """Strong components without recursion: {vertex: smallest id of its class}."""
    ahead = defaultdict(list)
    for a, b in links:
        ahead[a].append(b)
    index, low, on, stack, out = {}, {}, set(), [], {}
    for root in nodes:
        if root in index:
            continue
        work = [(root, 0)]
        while work:
            v, k = work.pop()
            if k == 0:
                index[v] = low[v] = len(index)
                stack.append(v)
                on.add(v)
            for j in range(k, len(ahead[v])):
                w = ahead[v][j]
                if w not in index:
                    work += [(v, j + 1), (w, 0)]
                    break
                if w in on:
                    low[v] = min(low[v], index[w])
            else:
                if low[v] == index[v]:
                    own = []
                    while not own or own[-1] != v:
                        own.append(stack.pop())
                        on.discard(own[-1])
                    out |= {w: min(own) for w in own}
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[v])
    return out


def graph_of(spark, nodes, links):
    v = spark.createDataFrame([(n,) for n in nodes], "id long")
    e = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(links)], "id long, start long, end long")
    return v, e


def odd_graph(seed, chain=6):
    rng = random.Random(seed)
    links = [(k, k + 1) for k in range(100, 100 + chain)] + [(100 + chain, 100 + chain // 2)]  # a chain into a ring
    links += [(200 + k, 200 + (k + 1) % 5) for k in range(5)]  # a ring alone
    links += [(rng.randrange(40), rng.randrange(40)) for _ in range(70)] + [(5, 5), (7, 8), (7, 8), (8, 7)]
    links += [(99 + chain, 3), (210, 204), (300, 301), (301, 302), (302, 300), (302, 310), (310, 311), (311, 300)]
    nodes = sorted({x for link in links for x in link} | {900, 901})
    return nodes, links


@pytest.mark.parametrize("seed", [1])
def test_classes_are_those_of_tarjan(spark, seed):
    nodes, links = odd_graph(seed, 24)
    v, e = graph_of(spark, nodes, links)
    want = tarjan(nodes, links)
    classes = reach.strong_classes(v, e)
    assert {r["id"]: r["class"] for r in classes.collect()} == want
    counted = defaultdict(int)
    for a, b in links:
        if want[a] != want[b]:
            counted[want[a], want[b]] += 1
    assert {(r[0], r[1]): r[2] for r in reach.class_links(e, classes).collect()} == counted


def test_reachable_pairs_by_class(spark):
    nodes, links = odd_graph(3)
    ahead = defaultdict(set)
    for a, b in links:
        ahead[a].add(b)
    want = set()
    for s in nodes[::3]:
        seen, queue = {s}, deque([s])
        while queue:
            for w in ahead[queue.popleft()] - seen:
                seen.add(w)
                queue.append(w)
        want |= {(s, w) for w in seen}
    v, e = graph_of(spark, nodes[::3], links)
    assert {tuple(r) for r in reach.reachable_by_class(v, e).collect()} == want


def test_a_class_of_all_vertices_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(reach, "CHUNK", 64)
    n = 1500
    v, e = graph_of(spark, range(n), [(k, (k + 1) % n) for k in range(n)] + [(5, 5000), (6000, 7)])
    v = v.unionAll(spark.createDataFrame([(5000,), (6000,)], "id long"))
    found = reach.reachable_by_class(v, e)
    per_task = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(per_task) == n * n + n + 1 + n + 2 and found.distinct().count() == sum(per_task)
    assert max(per_task) < 0.4 * sum(per_task)  # one task had all rows of the ring


def test_chunks_of_two_sides_are_not_counted_out_in_one_row(spark, monkeypatch):
    """A class of 400 chunks met itself as 160,000 rows made of one and broadcast, which grows with its square."""
    monkeypatch.setattr(reach, "CHUNK", 1)
    n = 400
    v, e = graph_of(spark, range(n), [(k, (k + 1) % n) for k in range(n)])
    found = reach.reachable_by_class(v, e)
    plan = found._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.splitlines() if "Project" not in line]
    counted = ["explode(sequence(0" in line for line in steps]
    assert sum(counted) == 4 and "Broadcast" not in plan
    assert not any(one and other for one, other in zip(counted, counted[1:]))  # something, here a shuffle, stands between two
    assert {tuple(r) for r in found.collect()} == {(a, b) for a in range(n) for b in range(n)}


def test_reachable_around_the_largest_class(spark, monkeypatch):
    """Ways into the largest class, out of it and past it, of chains, rings and links that skip; some vertices are no starts."""
    monkeypatch.setattr(reach, "CHUNK", 4)
    rng = random.Random(12)
    links = [(k, (k + 1) % 9) for k in range(9)] + [(rng.randrange(10, 30), rng.randrange(9)) for _ in range(12)] + [(rng.randrange(9), rng.randrange(30, 50)) for _ in range(12)]
    links += [(rng.randrange(10, 60), rng.randrange(20, 70)) for _ in range(45)] + [(70, 71), (71, 72), (72, 70), (72, 50), (15, 70), (80, 81), (4, 4)]
    ahead = defaultdict(set)
    for a, b in links:
        ahead[a].add(b)
    nodes = sorted({x for link in links for x in link} | {99})
    some = [k for k in nodes if k % 3 or k > 60]
    want = set()
    for s in some:
        seen, queue = {s}, deque([s])
        while queue:
            for w in ahead[queue.popleft()] - seen:
                seen.add(w)
                queue.append(w)
        want |= {(s, w) for w in seen}
    v, e = graph_of(spark, some, links)
    found = [tuple(r) for r in reach.reachable_by_class(v, e).collect()]
    assert len(found) == len(set(found)) and set(found) == want
    outside = v.where("id between 10 and 29")  # nobody in the largest class is a start
    assert {tuple(r) for r in reach.reachable_by_class(outside, e).collect()} == {(a, b) for a, b in want if 10 <= a <= 29}


def test_cones_of_the_largest_class_are_told_by_few_rows(spark, monkeypatch):
    rows = []
    plain = reach.written
    monkeypatch.setattr(reach, "written", lambda df: rows.append((told := plain(df)).count()) or told)
    links = [(k, (k + 1) % 300) for k in range(300)] + [(1000 + k, k) for k in range(300)] + [(k, 2000 + k) for k in range(300)]
    nodes = sorted({x for link in links for x in link})
    v, e = graph_of(spark, nodes, links)
    assert reach.reachable_by_class(v, e).count() == 600 * 600 + 600  # 600 reach 600 by way of the ring, and 600 outside it themselves
    assert max(rows) < 2000  # there were 300 * 300 pairs of classes


@pytest.mark.parametrize("direction", ["out", "in", "both"])
def test_hops_from_many_starts_at_once(spark, direction):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(500)] + [(k, k + 1) for k in range(400, 420)] + [(7, 7), (7, 8), (7, 8)]
    ahead = defaultdict(set)
    for a, b in links:
        for x, y in {"out": [(a, b)], "in": [(b, a)], "both": [(a, b), (b, a)]}[direction]:
            ahead[x].add(y)
    starts = [*range(0, 300, 2), *range(400, 421), 999]
    want = {}
    for s in starts:
        want[s, s], queue = 0, deque([s])
        while queue:
            v = queue.popleft()
            for w in ahead[v]:
                if (s, w) not in want:
                    want[s, w] = want[s, v] + 1
                    queue.append(w)
    v, e = graph_of(spark, [*range(0, 410), 999], links)
    some = spark.createDataFrame([(s,) for s in starts] + [(0,)], "id long")
    told = lambda most: {(r.start_id, r.end_id): r.hops for r in reach.hops_from(some, v, e, most, direction).collect()}
    ends = set(range(410)) | {999}
    assert told(None) == {k: n for k, n in want.items() if k[1] in ends}
    assert told(3) == {k: n for k, n in want.items() if k[1] in ends and n <= 3}
    assert reach.hops_from(some.where("id < 0"), v, e, 3, direction).count() == 0


def test_hop_distance_writes_less_than_it_tells(spark, monkeypatch):
    """A graph in which labels are many: what is written between rounds is fewer rows than the pairs told."""
    rng = random.Random(9)
    links = sorted({(rng.randrange(1200), rng.randrange(1200)) for _ in range(3600)})
    v, e = graph_of(spark, range(1200), links)
    rows = []
    monkeypatch.setattr(reach, "written", lambda df, keep=reach.written: [(out := keep(df)), rows.append(out.count())][0])
    monkeypatch.setattr(match_queries, "vertices", lambda *a: v.withColumn("user_id", F.when(F.col("id") < 320, 50).otherwise(1)))
    monkeypatch.setattr(match_queries, "edges", lambda *a: e)
    told = match_queries.hop_distance(spark, "").count()
    assert told > 100_000 and sum(rows) < told / 4


def test_nothing_to_condense(spark):
    v, e = graph_of(spark, [], [])
    assert reach.strong_classes(v, e).count() == 0
    v, e = graph_of(spark, [4, 5], [])
    assert {tuple(r) for r in reach.strong_classes(v, e).collect()} == {(4, 4), (5, 5)}
    assert reach.class_links(e, reach.strong_classes(v, e)).count() == 0


def test_a_long_chain_takes_a_logarithm_of_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(reach, "written", lambda df, keep=reach.written: rounds.append(1) or keep(df))
    ends, rings = reach.jump(spark.range(10_000).select("id", (F.col("id") + 1).alias("to")))
    assert ends.where("end <> 10000 OR hops <> 10000 - id").count() == 0 and ends.count() == 10_000 and rings.count() == 0
    assert len(rounds) <= 16
    rounds.clear()
    v, e = graph_of(spark, [], [(k, k + 1) for k in range(3000)] + [(3000, 0)])
    assert {r["class"] for r in reach.strong_classes(v, e).collect()} == {0} and len(rounds) < 50


def test_lineage_is_as_deep_as_it_is(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(reach, "written", lambda df, keep=reach.written: rounds.append(1) or keep(df))
    n = 1000
    parents = spark.range(n).select("id", (F.col("id") + 1).alias("to")).union(spark.createDataFrame([(5000, 998), (6000, 6001)], "id long, to long"))
    starts = spark.createDataFrame([(0,), (5000,), (6000,), (6001,), (7000,), (n,)], "id long")
    got = {(r.start_id, r.ancestor_id): r.hops for r in reach.lineage(starts, parents).collect()}
    assert got == {(0, k): k for k in range(1, n + 1)} | {(5000, 998): 1, (5000, 999): 2, (5000, 1000): 3, (6000, 6001): 1} and len(rounds) < 25
    with pytest.raises(ValueError, match="own ancestors"):
        reach.lineage(starts, spark.createDataFrame([(1, 2), (2, 1)], "id long, to long"))


@pytest.mark.parametrize("direction", ["out", "both"])
def test_labels_tell_every_distance_and_path(spark, direction):
    nodes, links = odd_graph(5)
    ahead = defaultdict(set)
    for a, b in links:
        for x, y in {"out": [(a, b)], "in": [(b, a)], "both": [(a, b), (b, a)]}[direction]:
            ahead[x].add(y)
    best = {}
    for s in nodes[::4]:
        best[s, s] = [s]
        level = [s]
        while level:
            fresh = {}
            for v in level:
                for w in ahead[v]:
                    if (s, w) not in best and w != s:
                        fresh[w] = min(fresh.get(w, [10**9]), best[s, v] + [w])
            best |= {(s, w): p for w, p in fresh.items()}
            level = list(fresh)
    v, e = graph_of(spark, nodes, links)
    marks = reach.Landmarks(e, direction=direction)
    starts = v.where(F.col("id").isin(nodes[::4]))
    found = marks.distances_from(starts, v)
    assert {(r[0], r[1]): r[2] for r in found.collect()} == {k: len(p) - 1 for k, p in best.items()}
    assert {(r.start_id, r.end_id): r.vertex_ids for r in marks.paths(found).collect()} == best
    pairs = spark.createDataFrame([k for k in best if k[0] != k[1]] + [(nodes[0], 901)], "start_id long, end_id long")
    assert {(r[0], r[1]): r[2] for r in marks.distances(pairs).collect()} == {k: len(p) - 1 for k, p in best.items() if k[0] != k[1]}
    near = reach.Landmarks(e, 3, direction).distances_from(starts, v)
    assert {(r[0], r[1]): r[2] for r in near.collect()} == {k: len(p) - 1 for k, p in best.items() if len(p) <= 4}
    n = len(nodes)
    assert marks.out.count() + marks.in_.count() < n * n / 2  # far fewer labels than pairs


def test_labels_pass_no_growing_table_through_the_driver(spark):
    nodes, links = odd_graph(5)
    v, e = graph_of(spark, nodes, links)
    marks = reach.Landmarks(e, 1)
    found = marks.distances_from(v, v)
    for df in (found, marks.distances(found.select("start_id", "end_id"))):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_few_rows_at_once_meet_all_centres():
    batches = [pd.DataFrame({"v": range(n)}) for n in (0, 3, 1000)]
    cut = list(vector_index._cut(iter(batches)))
    assert [x for part in cut for x in part["v"]] == [*range(3), *range(1000)] and max(map(len, cut)) <= vector_index.NEAR_ROWS and min(map(len, cut)) > 0


def test_index_finds_nine_of_ten_and_reads_under_two_fifths(spark):
    sf = "/root/testdata/sf0.1"
    index, probes = vector_queries.residual_index(spark, sf)
    queries = vector_queries._queries(spark, sf)
    got = {(r.query_id, r.id) for r in index.search(queries, 5, probes).collect()}
    want = {(r.query_id, r.id) for r in nearest.nearest_join(queries, vector_queries.vertices(spark, sf, "emb"), "embedding", 5).collect()}
    recall, read = len(got & want) / len(want), index.share_read(queries, probes)
    print(f"recall {recall:.3f}, rows read {read:.3f}")
    assert recall >= 0.9 and read < 0.4
    one = queries.where("query_id = 0")
    plan = index.opened(index.probed(one, probes))._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell" in plan.replace("isnotnull(", "")
    assert index.opened(index.probed(one, probes)).select("cell").distinct().count() <= probes


def test_index_with_one_vector_very_often(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "SLICE_ROWS", 40)
    monkeypatch.setattr(vector_index, "SLICE_QUERIES", 2)
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(0, 1, 8).tolist()) for k in range(300)] + [(1000 + k, [0.25] * 8) for k in range(150)] + [(2000, None)]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    index = vector_index.ResidualIndex(df, "v", 6, spill=2, parts=4, entries=16)
    queries = spark.createDataFrame([(k, rows[k][1]) for k in range(5)] + [(9, [0.25] * 8)], "query_id int, query array<float>")
    every = index.search(queries, 4, 6, rerank=450).select("query_id", "id", "rank").collect()
    want = nearest.nearest_join(queries, df.where("v IS NOT NULL"), "v", 4).select("query_id", "id", "rank").collect()
    assert sorted(every) == sorted(want)  # with all cells and all rows measured it is exact


def test_a_hub_of_a_third_of_all_edges_is_met_in_chunks(spark):
    """One vertex has a third of all edges in and out: no task gets more rows than a few chunks, and the rows are those of the join."""
    n = 3000
    left = spark.range(n).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")).repartition(4)
    right = spark.range(n).select(F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("b")).repartition(4)
    right = right.unionByName(spark.createDataFrame([(None, 1)], "k long, b long"))
    want = left.join(right, "k")
    got = match.hub_join(left, right, "k", 50)
    total = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("k", "a", "b").cast("decimal(38,0)"))).first()
    assert total(got) == total(want) and got.columns == ["k", "a", "b"]
    assert match.hub_join(left, right, "k", 5000).count() == want.count()
    keys = spark.newSession()
    keys.conf.set("spark.sql.adaptive.enabled", "false")
    keys.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    keys.conf.set("spark.sql.shuffle.partitions", "64")
    of = lambda df: keys.createDataFrame(df.toPandas().astype("Int64"))
    spread = match.hub_join(of(left), of(right.where("k IS NOT NULL")), "k", 50)
    per_task = [r["n"] for r in spread.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(per_task) == want.count() and max(per_task) < 0.15 * sum(per_task)  # one task had nearly all rows of the plain join


def test_walks_past_hubs(spark):
    links = [(0, k) for k in range(1, 40)] + [(k, 0) for k in range(40, 70)] + [(k, k + 1) for k in range(1, 20)]
    v, e = graph_of(spark, range(70), links)
    told = lambda df: sorted((r.start_id, r.end_id, r.hops, tuple(r.edge_ids)) for r in df.collect())
    assert told(match.walk(v, e, 0, 3, hubs=8)) == told(match.walk(v, e, 0, 3))
