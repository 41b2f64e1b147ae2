"""The corpus pipeline: five stages, each over all that the one before kept.

Every stage but the last returns the columns of its input. ``run`` applies them to the
documents of a folder; between stages the rows are written to the shared folder and read
again. An empty table passes all stages; null texts leave at the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mainspool.llm import decontaminate, language, ordinal, sentencepieces, simhash
from mainspool.llm.common import table
from mainspool.llm.queries import PIECES, grades
from mainspool.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, by text, declared language and source."""
    return language.identify(docs).where("kept").select(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose top grade (good and not toxic) is more likely than not."""
    rated = table(spark, sf_dir, "documents")
    model = ordinal.train(rated, grades(spark, sf_dir), "grade")
    return ordinal.grade(docs, model).where("tail_probability >= 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked fingerprints, that of the smallest id."""
    return simhash.keep_one(docs).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    keep = [c for c in docs.columns if c != "text"]
    return sentencepieces.encode(docs, sentencepieces.load(PIECES), keep=keep)


STAGES = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("sentencepiece", encode_pieces),
]

#: SQL expresses none of the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
