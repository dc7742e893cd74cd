"""Corpus pipeline: operators of :mod:`tidecast.llm` applied one after the
other to ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all that its
predecessor kept; all but the last return the columns of ``documents``.
Rows without a doc_id can't be named in a decision and stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import decontam, exact_dedup, mixing, simhash, toxicity
from tidecast.session import ensure_checkpoint_dir


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id stands in ``dropped``."""
    return docs.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, fitted on the labelled rows of ``docs``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without(docs, toxicity.score(docs, toxicity.train(docs, labels)).where("predicted = 1"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, exact_dedup.exact_dedup(docs).where("not kept"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, simhash.simhash_groups(docs, shingle=3, radius=3).where("doc_id <> component_id"))


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, decontam.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: for each document that is left, its source's weight and how often it is drawn."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("decontamination", not_in_benchmark),
    ("source_mixing", mixed),
]

#: A trained network, edit distances and seeded permutations have no SQL form;
#: tests/llm/test_pipeline.py checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
