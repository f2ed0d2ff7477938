"""Queries of the subpackage, each over its whole table, and their SQL oracles."""

from __future__ import annotations

import corpus_pipeline

from . import op01_substrings, op02_toxicity, op03_templates, op04_dac, op05_licenses, op06_forest, op07_language, op08_minhash, op09_mixing, op10_lines, op11_variants, op12_disclosure, op13_cover_tree


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substrings(spark, sf_dir):
    found = op01_substrings.repeated_substrings(_table(spark, sf_dir, "documents"))
    return found.drop("removed")


def op2_toxicity(spark, sf_dir):
    return op02_toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_templates(spark, sf_dir):
    return op03_templates.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_dac(spark, sf_dir):
    return op04_dac.token_files(spark, _table(spark, sf_dir, "documents"))


def op5_licenses(spark, sf_dir):
    return op05_licenses.license_scan(_table(spark, sf_dir, "documents"))


def op6_forest(spark, sf_dir):
    return op06_forest.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_language(spark, sf_dir):
    return op07_language.page_languages(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op8_minhash(spark, sf_dir):
    return op08_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_mixing(spark, sf_dir):
    return op09_mixing.mixed_rows(spark, _table(spark, sf_dir, "documents"))


def op10_lines_query(spark, sf_dir):
    return op10_lines.repeated_passages(_table(spark, sf_dir, "documents"), every=True)


def op11_variants_query(spark, sf_dir):
    return op11_variants.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_disclosure_query(spark, sf_dir):
    return op12_disclosure.digests(op12_disclosure.personal_data(_table(spark, sf_dir, "documents")))


def op13_cover_tree_query(spark, sf_dir):
    return op13_cover_tree.compress(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_substrings": op1_substrings,
    "op2_toxicity": op2_toxicity,
    "op3_templates": op3_templates,
    "op4_dac": op4_dac,
    "op5_licenses": op5_licenses,
    "op6_forest": op6_forest,
    "op7_language": op7_language,
    "op8_minhash": op8_minhash,
    "op9_mixing": op9_mixing,
    "op10_lines": op10_lines_query,
    "op11_variants": op11_variants_query,
    "op12_disclosure": op12_disclosure_query,
    "op13_cover_tree": op13_cover_tree_query,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op1_substrings": op01_substrings.ORACLE,
    "op5_licenses": op05_licenses.oracle_sql(),
    "op6_forest": op06_forest.ORACLE,
    "op8_minhash": op08_minhash.ORACLE,
    "op9_mixing": op09_mixing.ORACLE,
    "op10_lines": op10_lines.ORACLE,
    "op13_cover_tree": op13_cover_tree.ORACLE,
}
