"""Corpus pipeline: language ID, SimHash near-dedup, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run``
writes the result of each stage as Parquet to the shared folder and reads
it back as the next one's input. All stages but the last return the
columns of ``documents``. Missing optional columns are a mistake of the
caller; nulls, empty texts, repeated rows and empty tables have the
results that the operators' docstrings define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexicarve.llm import fm_decontam, langid_viterbi, pareto_mix, ring_sharding, simhash_mih
from lexicarve.llm.common import read_table, shared


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that can have a language: rejected is only null or a text without a letter.

    The model is fitted on the stage's own input. Its score does not decide:
    it is low for texts of several languages and 0 for scripts without one.
    """
    model = langid_viterbi.train(langid_viterbi.learnable(docs))
    return langid_viterbi.keep_identified(docs, model, 0.0)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id."""
    return simhash_mih.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words repeat benchmark windows."""
    return fm_decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return pareto_mix.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return ring_sharding.assign(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("source_mix", mix_sources),
    ("sharding", shard),
]

# Language ID is a learned model, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = shared(docs, f"stage-{name}")
    return docs
