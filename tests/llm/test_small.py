"""Each operator of the subpackage against a plain version, on small and odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lattix.llm import bpe, components, decontaminate, passages, pii, quality, repeats, simhash, suffix_tree, suffixes, url_rules

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \t\n", "a", "b " * 3000, "a a a a a a a a a a a a", "é" * 500, "x" * 3000, "ab" * 700, "one two three " * 40, "Line one\nLine one\nline two words\n\n", "😀 ünï cödé\x0b\x0cx", "A B c D e F g H i J k L"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) < 6000").collect()]
    return rows + [(10_000 + k, t) for k, t in enumerate(ODD)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With columns whose names the operators use for their own."""
    df = spark.createDataFrame(texts, "doc_id long, text string")
    return df.withColumn("n_words", F.lit("mine")).withColumn("row", F.lit(None).cast("string")).withColumn("th", F.lit("x")).withColumn("kept", F.lit("x")).withColumn("shard", F.lit("x")).repartition(5)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("doc_id < 0")


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- URL rules


def plain_verdict(url, rules):
    host, path = (re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url).groups() if url and "://" in url else ("", ""))
    host = lower(host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, None, "allow")
    return host, path, best[2], best[3]


@pytest.mark.parametrize("bound", [200_000, 0])
def test_url_rules(spark, bound, monkeypatch):
    monkeypatch.setattr(url_rules, "BROADCAST_RULES", bound)
    random.seed(4)
    hosts = ["com", "a.com", "b.a.com", "xa.com", "net", "n-a.com", "", "a.com.", "A.COM", "a,b.com", "com.a"]
    paths = ["", "/", "/en/", "/en/x", "/en", "/e?/en/", "/fr/#/", "//"]
    urls = [None, "", "nothing", "://", "x://a.com"] + [f"http://{random.choice(hosts)}{random.choice(paths)}" for _ in range(300)]
    rules = list({(h, p): (h, p, random.choice(["allow", "block"])) for h in hosts[:5] for p in ("/", "/en/", "") if random.random() < 0.8}.values())
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    got = url_rules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {k: plain_verdict(u, rules) for k, u in enumerate(urls)}
    assert url_rules.judge_urls(pages.where("false"), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0
    twice = url_rules.judge_urls(pages.unionAll(pages), spark.createDataFrame([], "host string, path string, verdict string"))
    assert twice.count() == 2 * len(urls) and twice.where("verdict <> 'allow' OR rule IS NOT NULL").isEmpty()


# --- quality


def plain_quality(text):
    w = words(text)
    spots = defaultdict(list)
    for k in range(len(w) - 4):
        spots[tuple(w[k : k + 5])].append(k)
    inside = {j for at in spots.values() if len(at) > 1 for k in at for j in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(len(x.decode()) for x in w), symbols, len(lines) - len(set(lines)), len(inside), len(w) < 10 or 100 * len(inside) > 20 * len(w)


def test_quality(docs, texts, nothing):
    got = {r.doc_id: r for r in quality.measure_quality(docs).collect()}
    assert {k: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for k, r in got.items()} == {k: plain_quality(t) for k, t in texts}
    assert all(not r.kept for r in got.values() if r.base_failed)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}
    assert quality.measure_quality(nothing).count() == 0 and quality.measure_quality(docs.unionAll(docs)).count() == 2 * len(texts)


# --- SimHash


def plain_print(text, size=3):
    w = words(lower(text))
    shingles = [b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def plain_groups(prints):
    ids = list(prints)
    parent = {k: k for k in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return {k: top(k) for k in ids}


def test_simhash(spark, docs, texts, nothing):
    long = " ".join(f"w{k % 977}x{k % 13}" for k in range(40_000))
    more = [(30_000, long), (30_001, long + " more"), (30_001, long + " more")]
    some = texts + more
    prints = {k: plain_print(t) for k, t in some}
    groups = plain_groups(prints)
    got = simhash.near_duplicates(docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)).collect()
    assert len(got) == len(some) and {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {k: (f"{prints[k]:016x}", groups[k]) for k, _ in some}
    assert groups[30_001] == 30_000 and simhash.near_duplicates(nothing).count() == 0


def test_fingerprints_without_an_id(spark):
    """A row without an id takes part: it joins the ids on either side of it."""
    a, b = "some words here and there", "quite another text of words"
    rows = [(None, a), (7, a), (4, a), (None, b), (None, b), (None, None), (9, "")]
    got = sorted(map(repr, ((r.doc_id, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())))
    assert got == sorted(map(repr, [(None, 4), (7, 4), (4, 4), (None, None), (None, None), (None, 9), (9, 9)]))


def test_bit_planes():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(6)])
    planes = simhash.BitPlanes(near)
    for probe in near[:60].tolist():
        want = [k for k, x in enumerate(near.tolist()) if (x ^ probe).bit_count() <= 3]
        assert planes.within(probe).tolist() == want


@pytest.mark.parametrize("tile", [2048, 8])
def test_chains_of_links(spark, tile, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", tile)
    chain = [sum(1 << b for b in range(3 * k)) for k in range(20)] + [0xF0F0 << 40]
    random.seed(2)
    many = chain + [c ^ (1 << random.randrange(64)) for c in chain for _ in range(3)]
    prints = dict(enumerate(dict.fromkeys(many)))
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, k) for k, p in prints.items()], "fp long, node long")
    links = simhash.near_links(nodes)
    got = {r.node: r.component for r in components.components(links).collect()}
    want = plain_groups(prints)
    assert {k: got.get(k, k) for k in want} == want


def test_components_of_a_long_path(spark):
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b").unionAll(spark.createDataFrame([(1000, 1001), (5, 5)], "a long, b long"))
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {k: 0 for k in range(301)} | {1000: 1000, 1001: 1000}
    assert components.components(links.where("false")).count() == 0


# --- passages and repeats


def plain_passages(rows, window):
    first, order = {}, sorted(rows, key=lambda r: r[0])
    for doc, text in order:
        w = words(text)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), (doc, k))
    out = {}
    for doc, text in order:
        w = words(text)
        gone = {j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] != (doc, k) for j in range(k, k + window)}
        out[doc] = len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()
    return out


@pytest.mark.parametrize("window, hot", [(20, 3_000), (3, 3_000), (20, 2), (3, 2)])
def test_passages(docs, texts, nothing, window, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in passages.remove_passages(docs, window=window).collect()}
    assert got == plain_passages(texts, window)
    assert passages.remove_passages(nothing).count() == 0
    again = passages.remove_passages(docs.unionAll(docs), window=window).distinct()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in again.collect()} == got


def plain_repeats(rows, window):
    seen = Counter(b[k : k + window] for _, t in rows for b in [(t or "").encode()] for k in range(len(b) - window + 1))
    out = {}
    for doc, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - window + 1):
            if seen[b[k : k + window]] > 1:
                gone[k : k + window] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out[doc] = len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()
    return out


@pytest.mark.parametrize("window, hot", [(400, 3_000), (50, 3_000), (400, 2), (50, 2)])
def test_repeats(docs, texts, nothing, window, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(docs, window=window).collect()}
    assert got == plain_repeats(texts, window)
    again = suffixes.remove_repeats(docs.unionAll(docs), window=window).distinct()  # every row is a copy
    assert {r.doc_id: (r.n_bytes, r.n_removed) for r in again.collect()} == {k: (len(b), len(b) * (len(b) >= window)) for k, t in texts for b in [(t or "").encode()]}
    assert suffixes.remove_repeats(nothing).count() == 0


def test_copies_stored_in_falling_order(spark):
    random.seed(15)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    shared = [word() for _ in range(60)]
    copied, other = (" ".join([word() for _ in range(30)] + shared + [word() for _ in range(30)]) for _ in range(2))
    rows = [(7, copied), (5, copied), (2, copied), (9, other)]
    piece = pa.RecordBatch.from_pydict({"doc_id": [7, 5, 2], "th": [1, 1, 1], "text": [copied] * 3})
    for units in (repeats.Units(20, 6, True), repeats.Units(400, 64, False)):
        asked = [x for out in repeats._asking(units, 4)(iter([piece])) for x in out["ids"].to_pylist()]
        assert asked and set(np.frombuffer(b"".join(asked), np.int64)) == {2}  # the copy that takes part
    parts = [spark.createDataFrame(part, "doc_id long, text string").repartition(1).sortWithinPartitions(F.desc("doc_id")) for part in (rows[:3], rows[3:])]
    df = parts[0].unionAll(parts[1])
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in passages.remove_passages(df).collect()}
    assert got == plain_passages(rows, 20) and got[9][1] == 60
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(df).collect()}
    assert got == plain_repeats(rows, 400) and got[9][1] >= 419


@pytest.mark.parametrize("first_stays", [True, False])
def test_hot_windows_meet_within_a_task_before_they_are_dealt(first_stays):
    """Rows follow what differs, not how many near copies hold a passage: one a window before."""
    units, shared = repeats.Units(20, 6, True), " ".join(f"w{k}" for k in range(100))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "th": list(range(300)), "text": [f"{shared} end{k}" for k in range(300)]})
    hot = np.unique(units.cut(batch["text"]).anchor)
    rows = [r for out in repeats._hot_windows(units, hot, first_stays)(iter([batch])) for r in out.to_pylist()]
    asks, spans = [r for r in rows if r["until"] is None], [r for r in rows if r["until"] is not None]
    assert len(asks) == 81 + 300  # windows of the passage, and the one of each text's end
    assert sorted((r["doc_id"], r["at"], r["until"]) for r in spans) == [(k, 0, 100) for k in range(first_stays, 300)]


def test_hot_windows_in_parts(docs, texts, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", 2)
    monkeypatch.setattr(repeats, "SETTLED", 40)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in passages.remove_passages(docs, window=5).collect()}
    assert got == plain_passages(texts, 5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(docs, window=60).collect()}
    assert got == plain_repeats(texts, 60)


def test_radix_passes():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    starts, groups = np.arange(3900), np.arange(3900) % 3
    hit = suffixes.repeated_suffixes(groups, data, starts, np.zeros(3900, bool), 17)
    seen = Counter((g, data[s : s + 17].tobytes()) for s, g in zip(starts.tolist(), groups.tolist(), strict=True))
    assert hit.tolist() == [seen[g, data[s : s + 17].tobytes()] > 1 for s, g in zip(starts.tolist(), groups.tolist(), strict=True)]


@pytest.mark.parametrize("depth", [5, 8, 19])
def test_groups_are_compared_byte_for_byte(depth):
    data = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz" * 3 + b"abcdefghijklmnopqrstuvwxyZ" + b"other bytes that differ, of any", np.uint8)
    starts, group = np.array([0, 26, 0, 105, 52, 0, 106, 107]), np.array([0, 0, 1, 1, 1, 2, 2, 2])
    assert suffixes._same_bytes(data, starts, group, depth).tolist() == [True, True, True, False, True, False, False, False]


def test_long_texts_and_repeated_rows(spark):
    rng = random.Random(21)
    text = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(60_000))
    rows = [(1, text), (2, "start " + text[1_000:300_000]), (2, "start " + text[1_000:300_000]), (3, text[100_000:100_350])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    four, ten = passages.remove_passages(df).collect(), suffixes.remove_repeats(df).collect()
    assert len(four) == len(ten) == 4
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in four} == plain_passages(rows, 20)
    assert {r.doc_id: r.n_removed for r in ten} == {1: 299_000, 2: 299_006, 3: 0}  # the repeated row is a copy of itself


def test_anchors_are_told_by_content():
    units = repeats.Units(8, 3, True)
    base = " ".join(random.Random(5).choice("abcdefgh") for _ in range(60))
    cut = units.cut(pa.array([base, "zz yy " + base + " qq", None, ""]))
    sets = [set(cut.anchor[cut.row == k].tolist()) for k in range(4)]
    assert sets[0] <= sets[1] and not sets[2] and not sets[3]


# --- personal data


def plain_spans(text):
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m.group())
        if 16 <= len(d) <= 19 and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_patterns():
    random.seed(6)
    bits = ["1", "22", "255", "300", ".", "@", "a", "b.c", "+", "-", " ", "(", ")", "é", "4111111111111111", "%"]
    for _ in range(4000):
        text = "".join(random.choice(bits) for _ in range(random.randint(1, 25)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_personal_data(spark, docs, texts, nothing):
    more = [(20_000, "mail bob@example.com or 10.0.0.1, card 4111111111111111 4465758382889437, call +1 (212) 555-0199"), (20_001, "Version 2.0. of 2019"), (20_002, "1" * 30_000 + "." * 3000), (20_003, 'token = "0123456789abcdef0123456789abcdef01234567"')]
    more += [(20_004, "pay 4111 1111 1111 1111 4465 7583 8288 9437 now"), (20_005, "x9 4111 1111 1111 1111"), (20_006, "key AKx7Qm2ZpL9vT4sRw8Bn1C, done"), (20_007, " ".join(str(k) for k in range(100_000, 140_000)) + " 4111 1111 1111 1111 4465 7583 8288 9437")]
    more += [(20_008, "ab" * 300 + "1 and " + "c" * 400 + "0123456789abcdef0123456789abcdef01234567")]
    more += [(20_009, " ".join(["7"] * k + ["4111-1111-1111-1111 4465-7583-8288-9437"])) for k in (0,)] + [(20_010, "mail a@b.cd"), (20_010, "mail a@b.cd"), (None, "mail a@b.cd")]
    all_docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    model = pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    by_id = dict(texts + more)
    for r in pii.find_personal_data(all_docs, model).collect():
        base = plain_spans(by_id[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in pii.BASE_KINDS)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        found = [s.split(":") for s in r.spans.split(",") if s]
        assert {(k, int(a), int(b)) for k, a, b in found} >= set(base)
        assert r.doc_id != 20_001 or not found
        assert r.n_spans == len(found)
        text = by_id[r.doc_id] or ""
        told = {(k, text[int(a) : int(b)]) for k, a, b in found}
        two = {("card", "4111 1111 1111 1111"), ("card", "4465 7583 8288 9437")}
        assert r.doc_id not in (20_004, 20_007) or told >= two, told
        assert r.doc_id != 20_005 or ("card", "4111 1111 1111 1111") in told, told
        assert r.doc_id != 20_006 or told == {("secret", "AKx7Qm2ZpL9vT4sRw8Bn1C")}, told
        assert r.doc_id != 20_009 or len([k for k, _ in told if k == "card"]) == 2, told
    masked_docs = pii.mask_personal_data(all_docs, model)
    assert masked_docs.columns == all_docs.columns and masked_docs.count() == all_docs.count()
    masked = {r.doc_id: r.text for r in masked_docs.collect()}
    assert masked[None] == masked[20_010] == "mail [EMAIL]"
    assert masked[20_000].startswith("mail [EMAIL] or [IP], card ") and masked[20_000].endswith("call [PHONE]") and "4111" not in masked[20_000]
    assert masked[10_000] is None and masked[20_001] == by_id[20_001]
    assert pii.find_personal_data(nothing, model).count() == 0 and pii.find_personal_data(nothing).count() == 0


def test_segments_are_the_best_of_all():
    random.seed(7)
    model = pii.SemiMarkov()
    run = [(0, 2), (3, 6), (7, 9), (10, 14)]
    lattice = model.lattice("+1 (2) 55 abcd", run)
    for label in model.LABELS:
        for key in {f for fs in lattice.values() for f in fs}:
            model.weights[label, key] = random.gauss(0, 1)
        for other in model.LABELS:
            model.weights[f">{other}", label] = random.gauss(0, 1)

    def total(cuts):
        before, value = "", 0.0
        for i, j, label in cuts:
            value, before = value + model.step(before, label) + model.score(label, lattice[i, j]), label
        return value

    def every(at):
        if at == len(run):
            yield []
        for end in range(at + 1, len(run) + 1):
            for label in model.LABELS:
                if label or end == at + 1:
                    yield from ([(at, end, label), *rest] for rest in every(end))

    assert total(model.best(model.features("+1 (2) 55 abcd", run), len(run))) == pytest.approx(max(map(total, every(0))))


# --- tokens


def test_tokens(spark, docs, texts, nothing):
    import base64

    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer

    more = [(30_000, " ".join(f"w{k % 977}x{k % 13}" for k in range(40_000))), (30_001, "9" * 70_000), (30_002, "same"), (30_002, "same")]
    docs, texts = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True), texts + more
    assert bpe.count_tokens(docs, public.path("byte_bpe_50k.json")).count() == bpe.encode_and_decode(docs, public.path("byte_bpe_multi_50k.tiktoken")).count() == len(texts)
    whole = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in bpe.count_tokens(docs, public.path("byte_bpe_50k.json")).collect()}
    want = {k: (len((t or "").encode()), len(whole.encode(t or "", add_special_tokens=False).ids)) for k, t in texts}
    assert got == {k: (b, n, n > 1024) for k, (b, n) in want.items()}
    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.encode_and_decode(docs, path, with_ids=True).collect():
        text = dict(texts)[r.doc_id] or ""
        ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
        assert (r.n_tokens, bytes(r.ids), r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, ids, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.count_tokens(nothing, public.path("byte_bpe_50k.json")).count() == bpe.encode_and_decode(nothing, path).count() == 0


def test_special_strings_and_lone_tokens():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    counter, whole = bpe.TokenCounter(path), Tokenizer.from_file(path)
    odd = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", " \n\n  x", "z" * 4000, "ab" * 2500, "don't I'LL", "\x1c \x85\xa0x"]
    assert counter.count(odd) == [len(whole.encode(t, add_special_tokens=False).ids) for t in odd]
    assert all(len(whole.encode(t, add_special_tokens=False).ids) == 1 for t in random.Random(1).sample(sorted(counter.proven), 500))


# --- benchmark windows


def plain_hits(texts, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    grams = defaultdict(set)
    for item, text in items:
        w = cut(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            grams[tuple(w[k : k + n])].add(item)
    sizes, out = {len(g) for g in grams}, {}
    for doc, text in texts:
        w, hit, found = cut(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := grams.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= own
        names = ",".join(sorted(map(str, found)))
        out[doc] = len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)
    return out


@pytest.mark.parametrize("bound", [200_000, 0])
@pytest.mark.parametrize("layout", ["written", "dealt anew", "sorted"])
def test_benchmark_windows(spark, docs, texts, nothing, bound, layout, tmp_path):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, "A b C d"), (901, None), (902, " ,; "), (903, "one two three " * 5), (903, "one two three " * 5), (904, "ΟΔΟΣ ΕΝΑ"), (905, "Straße İx")]
    more = [(30_000, "ΟΔΟΣ'ΕΝΑ y"), (30_001, "οδος ΕΝΑ"), (30_002, "straße İx STRAßE İX"), (30_003, "word " * 30_000 + "a b c d"), (30_004, "a b c d"), (30_004, "a b c d")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    if layout == "written":
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    elif layout == "dealt anew":
        docs = docs.repartition(7)
    else:
        docs = docs.orderBy(F.desc("text"))
    found = decontaminate.find_hits(docs, bench, broadcast_windows=bound).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found}
    assert len(found) == len(texts + more) and got == plain_hits(texts + more, items)
    assert got[30_000][1] == 2 and got[30_002][1] == 4 and got[30_003][1] == 4
    clean = decontaminate.keep_clean(docs, bench, broadcast_windows=bound)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(k for k, v in got.items() if not v[4])
    assert decontaminate.find_hits(nothing, bench, broadcast_windows=bound).count() == decontaminate.keep_clean(nothing, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.find_hits(docs, bench.where("false"), broadcast_windows=bound).collect())


def test_clean_documents_without_an_id(spark):
    rows = [(None, "plain words"), (None, "the very secret test"), (None, None), (1, "the very secret test"), (1, "other words"), (2, "plain words"), (2, "plain words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("mine")).withColumn("doc", F.lit(1))
    bench = spark.createDataFrame([(1, "very secret")], "item_id long, text string")
    got = decontaminate.keep_clean(df, bench)
    assert got.columns == df.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, [rows[0], rows[2], rows[4], rows[5], rows[6]]))


# --- scores


def plain_spelling(counted):
    """log10 of the share of any word among all spellings, from words with their counts; plain dictionaries."""
    classes, prior, depth = suffix_tree.CLASSES, suffix_tree.PRIOR, suffix_tree.DEPTH
    spelled = lambda w: [0] * depth + [int(classes[b]) for b in w] + [1]
    nodes, own = defaultdict(Counter), Counter()
    for w, n in counted.items():
        x = spelled(w)
        for b in w:
            own[b] += n
        for k in range(depth, len(x)):
            for d in range(depth + 1):
                nodes[tuple(x[k - d : k])][x[k]] += n
    total = sum(nodes[()].values())
    share = {(): {s: (nodes[()][s] + 1) / (total + 64) for s in range(64)}}
    for ctx in sorted((c for c in nodes if c), key=len):
        everything, up = sum(nodes[ctx].values()), nodes[ctx[1:]]
        above = sum(up.values())
        saved = sum(n * (math.log((n - 1 + prior * up[s] / above) / (everything - 1 + prior)) - math.log(up[s] / above)) for s, n in nodes[ctx].items())
        if everything >= suffix_tree.SPELLED * total and saved >= suffix_tree.EVIDENCE:
            parent = next(share[ctx[k:]] for k in range(1, len(ctx) + 1) if ctx[k:] in share)
            share[ctx] = {s: (nodes[ctx][s] + prior * parent[s]) / (everything + prior) for s in range(64)}
    within = Counter()
    for b in range(256):
        within[int(classes[b])] += own[b] + 1

    def spell(w):
        x, out = spelled(w), sum(math.log10((own[b] + 1) / within[int(classes[b])]) for b in w)
        for k in range(depth, len(x)):
            out += math.log10(next(share[tuple(x[k - d : k])] for d in range(depth, -1, -1) if tuple(x[k - d : k]) in share)[x[k]])
        return out

    return spell, len(share)


def plain_scores(tokens, held):
    """The word tree in plain dictionaries: scores, and how many contexts it keeps."""
    train = [ws for k, ws in tokens.items() if not held[k]]
    c = Counter(w for ws in train for w in ws)
    total, prior = sum(c.values()), suffix_tree.PRIOR
    frequent = {w for w, n in c.items() if n >= suffix_tree.HOT * total}
    symbol = lambda w: w if w in frequent else "rare"
    rare = {w: n for w, n in c.items() if w not in frequent}
    weight, rare_total = max(1, len(rare)), sum(rare.values())
    share = lambda s: ((rare_total if s == "rare" else c[s]) + 1) / (total + len(frequent) + 1)

    def histories(ws):
        """The last words before each, a text's start as the oldest."""
        own = ("start", *map(symbol, ws))
        return [own[max(0, i + 1 - suffix_tree.LONGEST) : i + 1] for i in range(len(ws))]

    after, candidates = {}, set()
    for ws in train:
        candidates.update(h[-1:] for h in histories(ws))
    kept, often, mass = {}, {}, {}

    def told(context, s):
        """The share that every task knows: frequent next words of the kept contexts, the rest as after one word less."""
        if not context:
            return share(s)
        if context not in kept:
            return told(context[1:], s)
        return (often.get((*context, s), 0) + (kept[context] - mass[context] + prior) * told(context[1:], s)) / (kept[context] + prior)

    for length in range(1, suffix_tree.LONGEST + 1):
        for ws in train:
            for h, w in zip(histories(ws), ws):
                if h[-length:] in candidates and len(h) >= length:
                    after.setdefault(h[-length:], Counter())[symbol(w)] += 1
        fresh = {}
        candidates = {v for v in candidates if v in after}  # nothing follows a text's end
        for v in candidates:
            n, nexts = sum(after[v].values()), after[v]
            if sum(m * (math.log((m - 1 + prior * told(v[1:], s)) / (n - 1 + prior)) - math.log(told(v[1:], s))) for s, m in nexts.items()) >= suffix_tree.EVIDENCE:
                fresh[v] = n
        frequent_next = {(*v, s): n for v in candidates for s, n in after[v].items() if n >= max(2.0, suffix_tree.HOT * total)}
        kept |= fresh
        often |= {k: n for k, n in frequent_next.items() if k[:-1] in fresh}
        mass |= {v: sum(often.get((*v, x), 0) for x in after[v]) for v in fresh}
        candidates = {v for v, n in frequent_next.items() if n >= suffix_tree.LONGER * suffix_tree.HOT * total}
    spell, states = plain_spelling({w.strip(b"\n"): n for w, n in rare.items()})
    out, longest = {}, 0
    for k, ws in tokens.items():
        score = 0.0
        for h, w in zip(histories(ws), ws):
            s = symbol(w)
            v = next((h[-d:] for d in range(min(len(h), suffix_tree.LONGEST), 0, -1) if h[-d:] in kept), ())
            longest = max(longest, len(v))
            score += math.log10((after[v][s] + prior * told(v[1:], s)) / (kept[v] + prior) if v else share(s))
            if s == "rare":
                spelled = math.log10(weight) + spell(w.strip(b"\n"))
                score += (math.log10(c[w] + 10**spelled) if c[w] else spelled) - math.log10(rare_total + weight)
        out[k] = score
    return out, len(kept), states, longest


@pytest.mark.parametrize("hot", [1e-5, 0.002, 2.0])
def test_scores(spark, docs, texts, nothing, hot, monkeypatch):
    monkeypatch.setattr(suffix_tree, "HOT", hot)
    monkeypatch.setattr(suffix_tree, "LONGEST", 3 if hot < 1 else 1)
    more = [(40_000 + k, "now this pair comes again and that pair too " * 30) for k in range(6)] + [(50_000, "some long text of words " * 20_000), (50_001, "x" * 150_000)]
    more += [(50_002 + k, "red fox runs one blue fox runs two " * 6_000) for k in range(2)]
    tokens = {k: [*words(lower(t)), b"\n"] for k, t in texts + more}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in tokens}
    c = Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    total, types = sum(c.values()), len(c)
    want, contexts, states, longest = plain_scores(tokens, held)
    assert longest == (3 if hot < 1 else 0)
    rows = suffix_tree.score_texts(docs.unionByName(spark.createDataFrame(more + more[:1], "doc_id long, text string"), allowMissingColumns=True).where("doc_id <> 40000 OR text IS NULL").unionByName(spark.createDataFrame(more[:1], "doc_id long, text string"), allowMissingColumns=True)).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(tokens) and got.keys() == tokens.keys() and states > 20 * (hot > 1e-5) and contexts >= 4 * (hot < 1)
    for k, ws in tokens.items():
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(ws), sum(c[w] > 0 for w in ws), total)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (total + types + 1)) for w in ws), rel=1e-9)
        assert r.score == pytest.approx(want[k], rel=1e-4, abs=1e-3)
    assert suffix_tree.score_texts(nothing).count() == 0


def test_repeated_rows_are_scored_each(spark):
    df = spark.createDataFrame([(k % 3, f"a b c d{k % 3}") for k in range(9)] + [(None, "a b")], "doc_id long, text string")
    got = suffix_tree.score_texts(df).collect()
    assert len(got) == 10 and len({(r.doc_id, r.score) for r in got}) == 4


def test_tree_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    kept = [(0, 0, rng.integers(1, 50, 64)), (1, 5, rng.integers(0, 9, 64)), (2, 5 + (7 << 6), rng.integers(0, 9, 64))]
    tree = suffix_tree.SpellingTree(kept, rng.integers(0, 9, 256).astype(float))
    assert np.allclose((10.0 ** tree.log).sum(1), 1, atol=1e-4)
    within = np.bincount(suffix_tree.CLASSES, 10.0**tree.byte_log, 64)
    assert np.allclose(within[np.unique(suffix_tree.CLASSES)], 1)
    table = tree.table()
    assert table[5 + (7 << 6) + (9 << 12)] == 2 and table[5 + (8 << 6)] == 1 and table[6] == 0


def test_tokens_hold_every_end():
    x = suffix_tree.Tokens(pa.array(["Ab  c", None, "", "é!"]))
    assert x.count.tolist() == [3, 1, 1, 2] and (x.hashes == suffix_tree.END_HASH).tolist() == [False, False, True, True, True, False, True]
    told = suffix_tree.Spelling(x.data, x.starts, x.ends)
    assert told.symbols[told.real].tolist()[:5] == [3, 4, 1, 5, 1] and int(told.real.sum()) == 6 + 7


def test_scores_beat_a_count_of_words_on_held_out_texts(spark):
    got = suffix_tree.score_texts(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


# --- nulls for ids, and nothing to find


def test_rows_without_an_id(spark):
    import public_tokenizers as public

    rows = [(None, "some words here " * 12), (None, None), (1, "some words here " * 12), (2, "x@example.com")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path, model = public.path("byte_bpe_multi_50k.tiktoken"), pii.SemiMarkov()
    bench = spark.createDataFrame([(None, "some words here"), (5, "x")], "item_id long, text string")
    for made in (quality.measure_quality(df), passages.remove_passages(df), suffixes.remove_repeats(df, window=30), pii.find_personal_data(df, model), bpe.encode_and_decode(df, path), decontaminate.find_hits(df, bench), suffix_tree.score_texts(df)):
        assert made.count() == 4 and made.where("doc_id IS NULL").count() == 2
    assert simhash.near_duplicates(df).count() == 4


def test_texts_without_repeats(spark):
    random.seed(11)
    rows = [(k, " ".join("".join(random.choices("abcdefghij", k=9)) for _ in range(120))) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert passages.remove_passages(df).where("n_removed > 0").isEmpty() and suffixes.remove_repeats(df).where("n_removed > 0").isEmpty()
    assert passages.remove_passages(df).count() == suffixes.remove_repeats(df).count() == suffix_tree.score_texts(df).count() == 4


def test_one_word_in_all_texts(spark):
    df = spark.createDataFrame([(k, "same " * k) for k in range(60)], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_tree.score_texts(df).collect()}
    train = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 != 2]
    assert got[59].n_known == 60 and got[59].train_tokens == sum(k + 1 for k in train)


def test_similar_texts(spark):
    random.seed(12)
    word = lambda: "".join(random.choices("abcdefghijklmnop", k=7))
    base = [[word() for _ in range(300)] for _ in range(6)]
    rows = [(k, " ".join(b)) for k, b in enumerate(base)]
    for k, b in enumerate(base):
        for c in range(8):
            copy = list(b)
            for _ in range(4):  # of 296 shingles at most 20 differ
                copy[random.randrange(300)] = word()
            rows.append((100 + 10 * k + c, " ".join(copy)))
    rows += [(900, None), (901, ""), (902, "two words"), (903, "two words"), (904, "other words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_texts(df).collect()}
    assert got == {k: k for k in range(6)} | {100 + 10 * k + c: k for k in range(6) for c in range(8)} | {900: 900, 901: 900, 902: 902, 903: 902, 904: 904}
    assert sorted(r.doc_id for r in simhash.keep_one_of_each(df).collect()) == [0, 1, 2, 3, 4, 5, 900, 902, 904]


def test_one_of_each_of_odd_rows(spark):
    text = "one two three four five six seven eight nine ten"
    other = "a text that has not been seen before at all"
    rows = [(5, text), (5, other), (3, text), (3, text), (None, text), (None, other), (None, None), (8, None), (9, " "), (6, "x " * 40_000), (7, "x " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("mine")).withColumn("whole", F.lit(1)).withColumn("doc", F.lit(2)).withColumn("size", F.lit(2))
    got = simhash.keep_one_of_each(df)
    assert got.columns == df.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, [rows[k] for k in (1, 2, 3, 4, 5, 6, 7, 9)]))
    assert simhash.similar_texts(df).count() == len(rows) and simhash.keep_one_of_each(df.where("false")).count() == 0


def plain_texts(rows, size=5):
    """Which of the rows (id, text) stay: of similar texts the one of the smallest id, whatever other texts have that id."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append(frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset())
    top = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if top[a] != top[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                top = [top[a] if v == top[b] else v for v in top]
    groups = defaultdict(list)
    for k, g in enumerate(top):
        groups[g].append(k)
    return groups, sets


@pytest.mark.parametrize("most", [16, 0])
def test_unlike_texts_of_one_id_are_kept(spark, most, monkeypatch):
    monkeypatch.setattr(simhash, "MOST_TILES", most)
    random.seed(15)
    word = lambda: "".join(random.choices("abcdefghijklmnop", k=7))
    text = lambda: [word() for _ in range(120)]
    a, b = text(), text()
    near = lambda t: t[:50] + [word()] + t[51:]
    three = [(3, " ".join(near(b))), (5, " ".join(b)), (5, " ".join(a))]
    df = spark.createDataFrame(three, "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one_of_each(df).collect())) == sorted([three[0], three[2]])
    base = [text() for _ in range(12)]
    rows = [(random.randrange(15), " ".join(t)) for t in base] + [(random.randrange(15), " ".join(near(random.choice(base)))) for _ in range(60)]
    kept = list(map(tuple, simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()))
    groups, _ = plain_texts(rows)
    assert len(kept) == len(groups)
    for members in groups.values():  # one text of each group, of its smallest id
        own = [r for r in kept if r in {rows[k] for k in members}]
        assert [r[0] for r in own] == [min(rows[k][0] for k in members)]


def plain_components(rows, size=5):
    sets = {}
    for k, t in rows:
        w = (t or "").lower().split()
        sets[k] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    top = {k: k for k, _ in rows}
    for a in sets:
        for b in sets:
            if a < b and top[a] != top[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((top[a], top[b]))
                top = {k: low if v == high else v for k, v in top.items()}
    return top


@pytest.mark.parametrize("most", [16, 0])
def test_links_need_the_whole_share(spark, most, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    monkeypatch.setattr(simhash, "MOST_TILES", most)
    random.seed(14)
    word = lambda: "".join(random.choices("abcdefghijklmnop", k=7))
    rows = []
    for k in range(8):
        base = [word() for _ in range(300)]
        rows.append((100 * k, " ".join(base)))
        # 28 other words in a row leave 264 of 328 shingles, over 0.8, and 29 leave 263 of 329
        for c, n in enumerate([28, 28, 29, 29, 34, 40, 50, 60, 80]):
            at = random.randrange(4, 296 - n)
            rows.append((100 * k + c + 1, " ".join(base[:at] + [word() for _ in range(n)] + base[at + n :])))
    small = [word() for _ in range(9)]
    rows += [(2000, " ".join(small)), (2001, " ".join(small[:8])), (2002, " ".join(small[:7]))]  # 5, 4 and 3 shingles
    got = {r.doc_id: r.component_id for r in simhash.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_components(rows)
    assert got == want and len(set(want.values())) > 40 and want[1] == 0 and want[3] == 3 and want[2001] == 2000 and want[2002] == 2002


@pytest.mark.parametrize("at_once", [1, 60, 10_000])
def test_shards_are_sorted_in_parts(at_once, monkeypatch):
    random.seed(13)
    base = [bytes(random.choices(b"abcdef", k=40)) for _ in range(12)]
    segments = [random.choice(base)[a : a + 30] for a in (random.randrange(10) for _ in range(80))]
    rows = {"anchor": [s[10] for s in segments], "doc_id": list(range(80)), "th": [0] * 80, "copied": [False] * 80, "at": [5] * 80, "segment": segments}
    monkeypatch.setattr(suffixes, "AT_ONCE", at_once)
    got = set()
    for doc, _, a, b in suffixes._repeats(20)(rows):
        got |= {(doc, k) for k in range(a - 5, b - 5 - 19)}
    seen = Counter((s[10], s[k : k + 20]) for s in segments for k in range(11))
    assert got == {(d, k) for d, s in enumerate(segments) for k in range(11) if seen[s[10], s[k : k + 20]] > 1}


def test_contexts_are_as_long_as_they_are_tested():
    """One word alone left most of the tree out; numbers come back from their byte planes as they were."""
    assert suffix_tree.LONGEST >= 3
    for kind in (np.int64, np.int32, np.uint8, np.float32, np.float64):
        for values in (np.arange(300).astype(kind), np.zeros(0, kind)):
            back = suffix_tree._of_planes(suffix_tree._planes(values), kind)
            assert back.dtype == kind and (back == values).all() and len(back) == len(values)
