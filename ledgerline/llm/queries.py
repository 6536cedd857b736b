"""The queries of this subpackage, opN_<name>, and their SQL where SQL can say it."""

from __future__ import annotations

from . import common, decontam, interaction, jaccard, mixing, neighbours, packing, pii, quality, ranked, sharding, suffixes, tokenfile, toxicity


def op1_decontamination(spark, sf_dir):
    return decontam.digest(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op2_personal_data(spark, sf_dir):
    return pii.digest(common.table(spark, sf_dir, "documents"))


def op3_repeated_strings(spark, sf_dir):
    return suffixes.strip(common.table(spark, sf_dir, "documents"))


def op4_token_file(spark, sf_dir):
    return tokenfile.digest(common.table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark, sf_dir):
    return jaccard.classes(common.table(spark, sf_dir, "documents"))


def op6_language_model(spark, sf_dir):
    return mixing.score(common.table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    return quality.digest(common.table(spark, sf_dir, "documents"))


def op8_toxicity(spark, sf_dir):
    return toxicity.digest(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op9_packing(spark, sf_dir):
    return packing.digest(common.table(spark, sf_dir, "documents"))


def op10_sharding(spark, sf_dir):
    return sharding.assign(common.table(spark, sf_dir, "documents"))


def op11_voronoi_search(spark, sf_dir):
    return neighbours.digest(common.table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark, sf_dir):
    return ranked.digest(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op13_filter_interactions(spark, sf_dir):
    return interaction.audit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_personal_data, op3_repeated_strings, op4_token_file, op5_jaccard_join, op6_language_model, op7_quality_rules, op8_toxicity, op9_packing, op10_sharding, op11_voronoi_search, op12_ranked_search, op13_filter_interactions)}
ORACLES = {"op1_decontamination": decontam.ORACLE, "op5_jaccard_join": jaccard.ORACLE, "op7_quality_rules": quality.ORACLE, "op10_sharding": sharding.ORACLE, "op11_voronoi_search": neighbours.ORACLE, "op12_ranked_search": ranked.ORACLE, "op13_filter_interactions": interaction.ORACLE}
