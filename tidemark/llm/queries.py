"""The registered text queries: each applies one operator to a whole table.

Those without a SQL twin need a tokeniser or something learned; tests/llm holds them against brute force.
"""

from __future__ import annotations

from tidemark.llm import sql
from tidemark.llm.common import benchmark, documents, labels
from tidemark.llm.decontamination import benchmark_matches
from tidemark.llm.divergence import source_divergence
from tidemark.llm.fertility import quality_rules
from tidemark.llm.jaccard_join import similar_groups
from tidemark.llm.lempel_ziv import remove_repeated_passages
from tidemark.llm.line_dedup import without_repeated_lines
from tidemark.llm.merkle import proofs
from tidemark.llm.packing import pack
from tidemark.llm.personal_data import personal_data
from tidemark.llm.quality_rank import quality_scores
from tidemark.llm.secret_worklist import scan_secrets
from tidemark.llm.sharding import shards_of
from tidemark.llm.toxicity import toxicity_scores


def op1_bootstrapped_pii(spark, sf_dir):
    return personal_data(documents(spark, sf_dir))


def op2_best_fit_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir))


def op3_tokeniser_fertility(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir))


def op4_relative_lempel_ziv(spark, sf_dir):
    return remove_repeated_passages(documents(spark, sf_dir), with_text=False)


def op5_line_dedup(spark, sf_dir):
    return without_repeated_lines(documents(spark, sf_dir))


def op6_secret_worklist(spark, sf_dir):
    return scan_secrets(documents(spark, sf_dir))


def op7_benchmark_decontamination(spark, sf_dir):
    return benchmark_matches(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op8_jaccard_join(spark, sf_dir):
    return similar_groups(documents(spark, sf_dir))


def op9_noisy_channel_toxicity(spark, sf_dir):
    return toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir))


def op10_quality_ranking(spark, sf_dir):
    return quality_scores(documents(spark, sf_dir), labels(spark, sf_dir))


def op11_merkle_manifest(spark, sf_dir):
    return proofs(documents(spark, sf_dir))


def op12_source_divergence(spark, sf_dir):
    return source_divergence(documents(spark, sf_dir))


def op13_virtual_slots(spark, sf_dir):
    return shards_of(documents(spark, sf_dir))


QUERIES = {
    "op1_bootstrapped_pii": op1_bootstrapped_pii,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_tokeniser_fertility": op3_tokeniser_fertility,
    "op4_relative_lempel_ziv": op4_relative_lempel_ziv,
    "op5_line_dedup": op5_line_dedup,
    "op6_secret_worklist": op6_secret_worklist,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_noisy_channel_toxicity": op9_noisy_channel_toxicity,
    "op10_quality_ranking": op10_quality_ranking,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_source_divergence": op12_source_divergence,
    "op13_virtual_slots": op13_virtual_slots,
}

ORACLES = {
    "op4_relative_lempel_ziv": sql.LEMPEL_ZIV,
    "op5_line_dedup": sql.LINE_DEDUP,
    "op7_benchmark_decontamination": sql.DECONTAMINATION,
    "op8_jaccard_join": sql.JACCARD_JOIN,
    "op11_merkle_manifest": sql.MERKLE,
    "op12_source_divergence": sql.DIVERGENCE,
    "op13_virtual_slots": sql.SHARDING,
}
