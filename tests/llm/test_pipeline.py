"""The pipeline's stages, each judged on its own input."""

import hashlib
import random

from pyspark.sql import functions as F

import corpus_pipeline
from lattix.llm import bpe, catalog, decontaminate, pii, quality
from lattix.llm.batches import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF))
        seen.append((name, docs, out))
        docs = out
    for _, _, out in seen[:-1]:
        assert out.columns == columns
    good = {r.doc_id for r in quality.measure_quality(seen[0][1]).where("kept").collect()}
    assert {r.doc_id for r in seen[0][2].collect()} == good
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = {r.doc_id for r in decontaminate.find_hits(seen[2][1], bench).where("NOT contaminated").collect()}
    assert {r.doc_id for r in seen[2][2].collect()} == clean
    for r in seen[3][2].collect():
        assert not [s for s in pii.base_spans(r.text) if s[0] in ("email", "phone")] and r.n_chars == len(r.text)
    texts = {r.doc_id: r.text for r in seen[4][1].collect()}
    codec = bpe.Codec(__import__("public_tokenizers").path("byte_bpe_multi_50k.tiktoken"))
    assert {r.doc_id: codec.decode(bytes(r.ids)).decode() for r in seen[4][2].collect()} == texts


def test_the_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 50


def test_odd_rows(spark, tmp_path):
    """Rows without an id, without a text, repeated, of one id, long, and with columns named like the stages' own."""
    rng = random.Random(8)
    prose = [" ".join("".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(60)) for _ in range(8)]
    test = " ".join(f"item{k}" for k in range(12))
    long = " ".join("".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(30_000))
    rows = [
        (1, prose[0]), (2, prose[0]), (2, prose[1]), (3, prose[2]), (3, prose[2]), (None, prose[0]), (None, prose[3]), (None, None), (4, None), (5, ""),
        (6, prose[4] + " " + test), (None, prose[5] + " " + test), (7, prose[6] + " mail a.b@example.com"), (8, "a b " * 200), (9, long), (10, long + " more"),
    ]
    kept = [rows[k] for k in (0, 2, 3, 4, 5, 6, 12, 14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("lang", "source", "key", "doc", "digest", "row", "hash", "piece", "size"):
        docs = docs.withColumn(name, F.lit("mine"))
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, test), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen, at = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = written(stage(spark, at, str(tmp_path)))
        assert at.columns == docs.columns
        seen.append(sorted(map(repr, ((r.doc_id, r.text) for r in at.collect()))))
    masked = [(k, t.replace("a.b@example.com", "[EMAIL]")) for k, t in kept]
    assert seen[0] == sorted(map(repr, [r for r in rows if r[1] and not r[1].startswith("a b")]))
    assert seen[2] == sorted(map(repr, kept)) and seen[3] == sorted(map(repr, masked))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(repr((r.doc_id, r.decoded_sha256)) for r in out) == sorted(repr((k, hashlib.sha256(t.encode()).hexdigest())) for k, t in masked)
    nothing = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in sorted(catalog.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{k}" for k in range(1, 11)]
