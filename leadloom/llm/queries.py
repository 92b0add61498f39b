"""One query per operator over the given tables, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import (
    bpe,
    chat,
    contamination,
    crossparse,
    edits,
    hamming,
    importance,
    interactions,
    jaccard,
    kdtree,
    pii,
    quality,
    warc,
)
from leadloom.llm.common import fold, table
from leadloom.session import scratch_path

RANKS = "byte_bpe_multi_50k.tiktoken"


def ranks() -> str:
    return public_tokenizers.path(RANKS)


def op1_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every embedding whose id is divisible by 100."""
    codes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code"))
    return hamming.search(codes, codes.filter(F.col("id") % 100 == 0), k=10)


def op2_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes."""
    rows = kdtree.shard(table(spark, sf_dir, "documents"), shards=8)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_benchmark_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold three quarters of a benchmark item."""
    return contamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after four edits made of its own text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    changed = docs.withColumn("edits", edits.sample_edits(F.col("doc_id"), F.col("text")))
    return edits.count(changed, ranks(), public_tokenizers.PATTERN)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs), redact=False)


def op6_byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they stand for, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, ranks(), public_tokenizers.PATTERN).drop("exact")


def op7_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as each of its participants sees it."""
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document that shingle overlap links it with."""
    return jaccard.components(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = fold(F.col("doc_id"), 4)
    sample = crossparse.learn(docs.filter(remainder != 2))
    rows = docs.select("doc_id", "text", (remainder == 2).alias("held_out"))
    return crossparse.predict(rows, sample)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from four fifths of the labels."""
    stats = quality.measured(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(stats, labels.filter(fold(F.col("doc_id"), 5) != 0))
    return quality.score_measured(stats, model).select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.KEEP).cast("int").alias("predicted"),
    )


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from the documents of each language in all 120 orders."""
    marks = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    counts = interactions.mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), marks)
    return interactions.audit(counts, "".join(interactions.TEXT_FILTERS) + interactions.REPEATED, list(marks))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by how much their words are those of the benchmark."""
    return importance.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op13_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through an archive and one without repeated payloads, and back."""
    root = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), f"{root}/captured")
    warc.deduplicate(spark, f"{root}/captured", f"{root}/deduplicated")
    return warc.resolve(spark, f"{root}/deduplicated").drop("uri")


QUERIES = {
    f.__name__: f
    for f in (
        op1_hamming_top_k,
        op2_kd_tree_shards,
        op3_benchmark_contamination,
        op4_edited_token_counts,
        op5_personal_data,
        op6_byte_bpe_round_trip,
        op7_perspective_rotation,
        op8_ngram_jaccard_join,
        op9_language,
        op10_quality,
        op11_filter_interactions,
        op12_importance_resampling,
        op13_warc_revisits,
    )
}

ORACLES = {
    "op1_hamming_top_k": hamming.ORACLE,
    "op3_benchmark_contamination": contamination.ORACLE,
    "op7_perspective_rotation": chat.ORACLE,
    "op11_filter_interactions": interactions.ORACLE,
    "op12_importance_resampling": importance.ORACLE,
    "op13_warc_revisits": warc.ORACLE,
}
