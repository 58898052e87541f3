"""A training corpus from raw documents: quality rules, near duplicates, personal
data, packing. Each stage works on all that the one before it kept.

Null texts fail the quality rules. Null keys are kept apart by their texts; repeated
rows go with the near duplicates, ties among which are broken by the hash of the text.
An empty table passes all stages as one. Columns beyond those of documents stay as
they are, up to the packing, which returns pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachgrid.llm import packing, pii, quality, simhash
from reachgrid.llm.shared import store
from reachgrid.session import tune


def _recounted(kept: DataFrame) -> DataFrame:
    """n_chars of the texts as they are now."""
    if "n_chars" not in kept.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and so do lines that too many documents share."""
    tune(spark)
    return _recounted(quality.passed(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: SimHash fingerprints of
    four-word shingles link at four or fewer differing bits. The one with the smallest
    key stays."""
    tune(spark)
    return simhash.one_of_each(docs, words=4, bits=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes the name of its kind."""
    tune(spark)
    return _recounted(pii.masked(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in training sequences, with their ids."""
    tune(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: The fingerprints (XXH64), the learnt contexts and the tokenizer are beyond SQL;
#: tests/llm/test_pipeline.py follows the stages by brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
