"""Registered queries of the text operators: thin calls over the given tables."""

from __future__ import annotations

from . import (
    alignment,
    bagminhash,
    decontamination,
    filter_audit,
    fingerprint,
    packing,
    passages,
    pii,
    secret_scan,
    suffix_dedup,
    tokens,
    toxicity,
    url_filter,
)
from .common import table


def op1_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op2_mixture_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op3_toxicity_grammar(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_bagminhash_dedup(spark, sf_dir):
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_token_counts(spark, sf_dir):
    return tokens.length_histogram(tokens.token_lengths(table(spark, sf_dir, "documents")))


def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op7_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op8_edit_fingerprints(spark, sf_dir):
    return fingerprint.compare_edited(table(spark, sf_dir, "documents"))


def op9_spaced_seed_decontamination(spark, sf_dir):
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_compact_windows(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op11_contextual_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("found")


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(
        filter_audit.mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    )


def op13_token_alignment(spark, sf_dir):
    return alignment.align_documents(table(spark, sf_dir, "documents")).drop("groups")


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_mixture_packing": op2_mixture_packing,
    "op3_toxicity_grammar": op3_toxicity_grammar,
    "op4_bagminhash_dedup": op4_bagminhash_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_edit_fingerprints": op8_edit_fingerprints,
    "op9_spaced_seed_decontamination": op9_spaced_seed_decontamination,
    "op10_compact_windows": op10_compact_windows,
    "op11_contextual_pii": op11_contextual_pii,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_alignment": op13_token_alignment,
}
ORACLE_SQL: dict[str, str] = {"op12_filter_audit": filter_audit.ORACLE_SQL}
