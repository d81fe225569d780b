"""The queries of the numbered operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from kartoteka.llm import decontaminate, discriminant, interactions, jaccard, langid, maxent, mixing, pii, quality, ranking, secrets, toxicity, urls
from kartoteka.llm.common import read


def op1_secret_ledger(spark, sf_dir):
    return secrets.report(read(spark, sf_dir, "documents"))


def op2_poisson_mix(spark, sf_dir):
    return mixing.report(read(spark, sf_dir, "documents"))


def op3_link_trust(spark, sf_dir):
    return urls.judge(read(spark, sf_dir, "pages"))


def op4_surrogates(spark, sf_dir):
    return pii.report(read(spark, sf_dir, "documents"))


def op5_hashed_maxent(spark, sf_dir):
    return maxent.report(read(spark, sf_dir, "documents"))


def op6_suffix_decontamination(spark, sf_dir):
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_line_quality(spark, sf_dir):
    return quality.report(read(spark, sf_dir, "documents"))


def op8_string_kernel_toxicity(spark, sf_dir):
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_byte_gru(spark, sf_dir):
    return langid.report(read(spark, sf_dir, "documents"))


def op10_chosen_path_join(spark, sf_dir):
    return jaccard.report(read(spark, sf_dir, "documents"))


def op11_threshold_search(spark, sf_dir):
    return ranking.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_filter_interactions(spark, sf_dir):
    return interactions.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_quadratic_quality(spark, sf_dir):
    return discriminant.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {
    "op1_secret_ledger": op1_secret_ledger,
    "op2_poisson_mix": op2_poisson_mix,
    "op3_link_trust": op3_link_trust,
    "op4_surrogates": op4_surrogates,
    "op5_hashed_maxent": op5_hashed_maxent,
    "op6_suffix_decontamination": op6_suffix_decontamination,
    "op7_line_quality": op7_line_quality,
    "op8_string_kernel_toxicity": op8_string_kernel_toxicity,
    "op9_byte_gru": op9_byte_gru,
    "op10_chosen_path_join": op10_chosen_path_join,
    "op11_threshold_search": op11_threshold_search,
    "op12_filter_interactions": op12_filter_interactions,
    "op13_quadratic_quality": op13_quadratic_quality,
}
ORACLES = {
    "op2_poisson_mix": mixing.ORACLE_SQL,
    "op3_link_trust": urls.ORACLE_SQL,
    "op6_suffix_decontamination": decontaminate.ORACLE_SQL,
    "op7_line_quality": quality.ORACLE_SQL,
    "op11_threshold_search": ranking.ORACLE_SQL,
    "op12_filter_interactions": interactions.ORACLE_SQL,
}
