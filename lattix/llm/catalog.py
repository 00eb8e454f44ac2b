"""Queries and SQL of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lattix.llm.bpe import op6_token_counts, op8_bpe_encode_decode
from lattix.llm.decontaminate import OP7_SQL, op7_benchmark_decontamination
from lattix.llm.divergence import OP13_SQL, op13_source_divergence
from lattix.llm.fingerprints import op12_document_fingerprints
from lattix.llm.passages import OP4_SQL, op4_substring_dedup
from lattix.llm.pii import op5_pii
from lattix.llm.quality import OP2_SQL, op2_quality_rules
from lattix.llm.simhash import op3_simhash_near_dedup
from lattix.llm.suffix_tree import op9_lm_scoring
from lattix.llm.suffixes import op10_suffix_array_dedup
from lattix.llm.url_rules import OP1_SQL, op1_url_filters
from lattix.llm.vector_codes import op11_vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_quality_rules": op2_quality_rules,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_pii": op5_pii,
    "op6_token_counts": op6_token_counts,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_bpe_encode_decode": op8_bpe_encode_decode,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_source_divergence": op13_source_divergence,
}
ORACLE_SQL: dict[str, str] = {"op1_url_filters": OP1_SQL, "op2_quality_rules": OP2_SQL, "op4_substring_dedup": OP4_SQL, "op7_benchmark_decontamination": OP7_SQL, "op13_source_divergence": OP13_SQL}
