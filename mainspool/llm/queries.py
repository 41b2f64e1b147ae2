"""The pipeline operators' queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mainspool.llm import decision_list, decontaminate, dialogue, html_text, infill, language, licenses, mixing, ordinal, sentencepieces, sharding, simhash, training_order
from mainspool.llm.common import table
from mainspool.session import scratch_path

#: Where the public model file lies; never copied into the repository.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: how the public byte-level vocabulary splits texts.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings 0 to 2: a point for good quality, a point for not being toxic."""
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("grade"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sharding.sizes(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32")
    return sharding.shard(docs, 8, ties=["text_crc32"]).withColumn("grown_shard", F.lit(None).cast("int"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents"), sentencepieces.load(PIECES), keep=["doc_id"])


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), keep=["doc_id", "lang", "source"])


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.item_id", "l.score", F.col("l.question").alias("question_overlap"), F.col("l.answer").alias("answer_overlap"))


def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ordinal.train(docs, grades(spark, sf_dir), "grade")
    found = ordinal.grade(docs, model, keep=["doc_id"])
    return found.withColumn("kept", F.col("tail_probability") >= 0.5)


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "training-order")
    return training_order.write_order(table(spark, sf_dir, "documents"), path, training_order.load(RANKS), PATTERN, key=20)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", F.explode("licenses").alias("l")).select("doc_id", "l.*")


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the rearranged texts, and of those put back from them."""
    moved = infill.restore(infill.transform(table(spark, sf_dir, "documents"), keep=["doc_id"]))
    digests = (F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored"))
    return moved.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair(dialogue.damage(table(spark, sf_dir, "conversations")), dropped="dropped")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_sentencepiece,
        op3_language_id,
        op4_decontamination,
        op5_decision_list,
        op6_simhash,
        op7_quality_classifier,
        op8_training_order,
        op9_html_text,
        op10_license_scan,
        op11_source_mix,
        op12_infill,
        op13_conversation_repair,
    )
}

ORACLES: dict[str, str] = {"op1_sharding": sharding.oracle(8), "op11_source_mix": mixing.oracle(), "op12_infill": infill.oracle(), "op13_conversation_repair": dialogue.oracle()}
