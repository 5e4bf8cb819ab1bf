"""The registered queries of this package and the SQL they are checked against."""

from __future__ import annotations

import corpus_pipeline
from commentflow.llm import (
    fingerprints, license_scan, line_dedup, mixing, packing, quality_rules, resampling, sentencepiece_codec, simhash, spelling,
    substring_dedup, suffix_dedup, toxicity,
)
from commentflow.llm.tables import documents


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


def op2_license_scan(spark, sf_dir):
    return license_scan.license_scan(documents(spark, sf_dir))


def op8_line_dedup(spark, sf_dir):
    return line_dedup.removed_lines(documents(spark, sf_dir))


def op9_mixing(spark, sf_dir):
    return mixing.mixture(documents(spark, sf_dir))


def op3_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return toxicity.toxicity(docs, toxicity.train(docs, toxicity.labelled(spark, sf_dir)))


def op4_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op6_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.round_trip(documents(spark, sf_dir))


def op7_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op11_resampling(spark, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resample(documents(spark, sf_dir), target).drop("n_words")


def op12_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), with_ids=False)


def op13_spelling(spark, sf_dir):
    return spelling.spelling_variants(documents(spark, sf_dir))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_fingerprints": op4_fingerprints,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_quality_rules": op7_quality_rules,
    "op8_line_dedup": op8_line_dedup,
    "op9_mixing": op9_mixing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_resampling": op11_resampling,
    "op12_packing": op12_packing,
    "op13_spelling": op13_spelling,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op2_license_scan": license_scan.SQL,
    "op7_quality_rules": quality_rules.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op9_mixing": mixing.SQL,
    "op11_resampling": resampling.SQL,
    "op13_spelling": spelling.SQL,
}

if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
