"""The corpus pipeline: documents through five of the training-data operators.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept; ``run`` writes each result to the shared folder and reads it back
as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapmart.llm import mixing, ngram_join, packing, pii, toxicity
from snapmart.llm.common import documents, store_at
from snapmart.llm.queries import tokenizer_path
from snapmart.sources.scratch import remove, scratch_path, scratch_scope

#: SQL cannot express the stages; they are tested against brute force.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity model rejects."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate component."""
    return ngram_join.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows the text."""
    return pii.mask(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources meet their targets."""
    return mixing.take_copies(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("personal data", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage made on its way is deleted after it."""
    out, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        with scratch_scope(spark) as made:
            path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
            out = store_at(stage(spark, out, sf_dir), path)
            made.remove(path)
        if before:
            remove(spark, before)
        before = path
    return out
