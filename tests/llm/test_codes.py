"""Vector codes, document fingerprints and the audit of sources against plain versions, on small and odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lattix.llm import divergence, fingerprints, vector_codes

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, label, code, error) and the codebooks, one vector after the other in whole numbers."""
    kept = [(i, [math.floor(4096 * float(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    width = len(first[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, v: min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = defaultdict(list)
            for _, v, _ in kept:
                own[nearest(p, v)].append(cut(v, p))
            new.append([[sum(x) // len(own[e]) for x in zip(*own[e], strict=True)] if e in own else old for e, old in enumerate(books[p])])
        books = new
    out = []
    for i, v, lab in kept:
        code = [nearest(p, v) for p in range(parts)]
        out.append((i, lab, "".join(f"{c:02x}" for c in code), sum(far(cut(v, p), books[p][c]) for p, c in enumerate(code))))
    return out, books


def odd_vectors():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(i % 3, 1) for _ in range(16)], i % 4 or None) for i in range(300)]
    rows += [(400 + i, [0.5] * 16, 7) for i in range(150)]  # one very common vector
    rows += [(None, [0.1] * 16, 1), (600, None, 1), (601, [0.0] * 15 + [None], 1), (602, [float("nan")] + [0.0] * 15, 1), (603, [float("inf")] + [0.0] * 15, 2), (604, [float("-inf")] * 16, 2)]
    rows += [rows[0], rows[0], (3, [-2.0] * 16, None), (605, [-0.00001] * 16, 1), (606, [8.0, -8.0] * 8, 3)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece", [4096, 40])
def test_codes_are_those_of_a_plain_version(spark, piece, monkeypatch):
    monkeypatch.setattr(vector_codes, "PIECE_ROWS", piece)
    rows = odd_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("code", F.lit("mine")).withColumn("v", F.lit(1)).repartition(3)
    coded, books = vector_codes.vector_codes(df)
    want, plain_books = plain_codes([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows])
    assert books.tolist() == plain_books
    assert Counter(map(tuple, coded.collect())) == Counter(want)


def test_codes_of_few_equal_or_no_vectors(spark, tmp_path):
    shape = "vec_id long, embedding array<float>, label int"
    none, books = vector_codes.vector_codes(spark.createDataFrame([], shape))
    assert none.count() == 0 and books.shape[1] == 0
    few, books = vector_codes.vector_codes(spark.createDataFrame([(1, [1.0] * 8, None), (2, [1.0] * 8, None), (5, [2.0] * 8, 3)], shape))
    assert sorted(map(tuple, few.collect())) == [(1, None, "00" * 8, 0), (2, None, "00" * 8, 0), (5, 3, "02" * 8, 0)] and books.shape == (8, 3, 1)
    for wrong in ([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], [(1, [1.0] * 9, 1)]):
        with pytest.raises(Exception, match="components"):
            vector_codes.vector_codes(spark.createDataFrame(wrong, shape))
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1e9] * 8, 1)], shape))[0].count()
    spark.createDataFrame(odd_vectors(), shape).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = vector_codes.op11_vector_codes(spark, str(tmp_path))
    want, books = plain_codes([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in odd_vectors()])
    sums = Counter()
    for _, lab, _, error in want:
        sums[lab] += error
    told = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter((i, code, error, sums[lab], told) for i, lab, code, error in want)


def test_balls_cover_their_points_and_owned_balls_need_no_point():
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.normal(c, 30, (400, 4)) for c in (0, 4000, 9000)]).astype(np.int64)
    tree = vector_codes.Tree.over(rows)
    assert tree.count[0] == len(rows) and (tree.sums[0] == rows.sum(0)).all() and (tree.points[tree.of] == rows).all()
    for k in range(len(tree.count)):
        own = tree.points[tree.first[k] : tree.last[k]]
        assert (np.sqrt(((own - tree.center[k]) ** 2).sum(1)) <= tree.radius[k] + 1e-6).all()
    owned, points, _ = tree.owners(np.array([[0] * 4, [4000] * 4, [9000] * 4]))
    assert len(points) == 0 and sum(len(b) for b, _ in owned) < 60  # three groups far apart are taken by their balls


# --- document fingerprints


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def share(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return rows + [(900 + k, t) for k, t in enumerate([None, "", " \t\n", "a", "B a", "b " * 3000, "é" * 500, "one two three " * 40, "😀 ünï cödé\x0b\x0cx"])]


def test_edited_texts_and_likeness(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("k", F.lit(1)).withColumn("low", F.lit(1)).withColumn("n_chars", F.lit("x")).repartition(5)
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(df).collect()}
    rows = sorted((i, t or "") for i, t in texts)
    assert len(got) == len(rows)
    off_edited, off_next = [], []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        few = len(shingles(text) | shingles(edited)) < 100  # bins are then filled from few shingles, and vary together
        for off, told, other in ((off_edited, r.near_edited, edited), (off_next, r.near_next, after)):
            off.append(told - share(text, other))
            assert abs(off[-1]) < (0.35 if few else 0.15)
        assert (r.fingerprint == r.edited_fingerprint) or shingles(text) != shingles(edited)
    assert abs(np.mean(off_edited)) < 0.01 and abs(np.mean(off_next)) < 0.01
    assert len({got[i].fingerprint for i, t in texts if not shingles(t)}) == 1


def test_likeness_is_without_bias(spark):
    """Over texts of few and many words that share a known part; few words leave most bins empty."""
    rng = random.Random(2)
    rows, truth = [], {}
    for k in range(240):
        n = rng.choice([8, 30, 120, 400])
        a = [f"w{rng.randrange(10**9)}" for _ in range(n)]
        b = a[: int(n * rng.choice([0.3, 0.6, 0.9]))] + [f"w{rng.randrange(10**9)}" for _ in range(n // 5)]
        rows.append((k, " ".join(a), " ".join(b)))
        truth[k] = share(" ".join(a), " ".join(b)), n
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(spark.createDataFrame(rows, "id long, a string, b string"), "a", "x"), "b", "y")
    got = {r.id: r.near for r in df.select("id", fingerprints.likeness(F.col("x"), F.col("y")).alias("near")).collect()}
    for many in (False, True):
        off = [got[k] - j for k, (j, n) in truth.items() if (n > 100) == many]
        assert abs(np.mean(off)) < (0.012 if many else 0.05)
        assert np.sqrt(np.mean(np.square(off))) < (0.05 if many else 0.2)


def test_fingerprints_of_odd_tables(spark):
    shape = "doc_id long, text string"
    none = spark.createDataFrame([], shape)
    assert fingerprints.fingerprints(none).count() == 0 and fingerprints.edited_fingerprints(none).count() == 0
    alone = fingerprints.edited_fingerprints(spark.createDataFrame([(4, "a b c d e f g h")], shape)).collect()
    assert [(r.doc_id, r.n_chars, r.near_next, r.edited_sha256) for r in alone] == [(4, 15, 1.0, hashlib.sha256(b"a b c d e f a b").hexdigest())]
    rows = [(1, "x y z q r s"), (1, "x y z q r s"), (1, "x y z q r s"), (None, "t u"), (2, None), (2, "")]
    got = fingerprints.edited_fingerprints(spark.createDataFrame(rows, shape)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    ones = sorted((r.near_next, r.edited_sha256) for r in got if r.doc_id == 1)
    assert ones == [(0.0, hashlib.sha256(b"x y z q r").hexdigest())] + [(1.0, hashlib.sha256(b"x y z q rx ").hexdigest())] * 2
    assert {r.near_next for r in got if r.doc_id == 2} == {0.0, 1.0}


def test_no_python_on_the_way_to_fingerprints(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    for made in (fingerprints.fingerprints(df), fingerprints.edited_fingerprints(df)):
        assert not re.search("Python|Arrow|Pandas", made._jdf.queryExecution().toString())


# --- divergence of sources


def plain_divergence(rows, least=30, top=50):
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))) for lang, source, text in rows]
    docs, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, ws in words:
        groups[lang].add(source)
        docs.update((lang, w) for w in set(ws))
        counts[lang, source].update(ws)
    out = []
    for lang, sources in groups.items():
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            own = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", own)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, r) for r, (item, value) in enumerate(found, 1) if part == "pair" or r <= top]
    return Counter(out)


@pytest.mark.parametrize("block,tile", [(1024, 64), (64, 2)])
def test_divergence_of_odd_rows(spark, block, tile, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    rng = random.Random(1)
    vocabulary = [f"wo{'abcdefghij'[k % 10]}{chr(97 + k // 10 % 26)}{'é' * (k // 260)}" for k in range(300)]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", "ü", "", None, "b" * 40]), " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(300)], k=rng.randrange(60)))) for _ in range(700)]
    rows += [("en", "empty", None), ("en", "empty", ""), ("fr", "a", "Rare words 123"), ("fr", "b", None), ("fr", None, "x"), ("xx", "alone", "a b"), rows[0], rows[0]]
    rows += [("en", "a", "Same-Word same_word" * 5000)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).withColumn("block", F.lit(None)).repartition(4)
    for top in (50, 3):
        got = Counter(map(tuple, divergence.source_divergence(df, least_docs=12, top=top).collect()))
        assert got == plain_divergence(rows, 12, top)
    assert divergence.source_divergence(df.where("lang = 'no'")).count() == 0
