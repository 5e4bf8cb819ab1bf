"""A training-corpus pipeline: toxicity, line dedup, near-dedup, source mixing, SentencePiece.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commentflow.llm import line_dedup, mixing, near_dedup, sentencepiece_codec, toxicity
from commentflow.llm.tables import documents, stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the labelled ones among them, does not call toxic."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, toxicity.labelled(spark, sf_dir)))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that occur earlier, equal or nearly so."""
    return line_dedup.dedup_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents linked by five-word shingles alike by 0.8 or more."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target weights of their sources ask, shuffled inside shards."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of pieces, digest and ids of every document copy, and whether the ids decode to the text."""
    return sentencepiece_codec.round_trip(docs, with_ids=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("simhash", dedup_documents),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: The classifier chain and the tokenizer have no SQL form; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
