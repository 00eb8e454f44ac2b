"""The corpus pipeline: stages over the documents, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lattix.llm import bpe, decontaminate, pii, quality, simhash
from lattix.llm.batches import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id stays: shingles of five words, 0.8 shared."""
    return simhash.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts; n_chars follows."""
    return pii.mask_personal_data(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text, with digests of the ids and of the text decoded from them."""
    import public_tokenizers

    return bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE", byte_pairs),
]

#: SQL can't express the stages after the first; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
