"""From raw documents to clean, tokenised training data, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the
shared folder and reads it again as the next stage's documents.  All but the last return
the columns of documents.  SQL cannot express the stages (random features, conditional
random fields, byte-pair merges), so ``ORACLE_SQL`` is None and the tests hold ``run``
against a plain version in memory.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import bpe, contamination, jaccard, pii, quality
from leadloom.llm.common import table
from leadloom.llm.queries import ranks
from leadloom.operators.ranking import with_position
from leadloom.session import cut_lineage, ship_package

ORACLE_SQL = None


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on all labels, does not reject."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(quality.measured(docs), labels)
    scored = quality.score(docs, model, to="_quality")
    return scored.filter(F.col("_quality") >= quality.KEEP).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle overlap, that of the smallest id.

    Texts decide, whatever their ids: rows that repeat an id and rows without one are numbered
    behind all ids, so each is a document of its own that may be a copy of any other.
    """
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = cut_lineage(ids.filter(F.col("_rows") > 1).select("_id"))
    single = docs.filter(F.col("doc_id").isNotNull()).join(repeated, F.col("doc_id") == F.col("_id"), "left_anti")
    again = docs.join(repeated, F.col("doc_id") == F.col("_id"), "left_semi").unionAll(docs.filter(F.col("doc_id").isNull()))
    top = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0))).first()[0]
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    numbered = cut_lineage(with_position(again, order, "_node").withColumn("_node", F.col("_node") + F.lit(top)))
    named = single.withColumn("_node", F.col("doc_id")).unionByName(numbered)
    components = jaccard.components(named.select(F.col("_node").alias("doc_id"), "text"))
    spare = cut_lineage(components.filter(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias("_node")))
    return named.join(spare, "_node", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold three quarters of any benchmark item."""
    found = cut_lineage(contamination.contained(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct())
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    found = pii.find(docs.withColumn("_text", F.col("text")), pii.fit(docs), text="_text").withColumn("text", F.col("redacted"))
    chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    return found.withColumn("n_chars", chars).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, and whether the ids decode to the text."""
    encoded = bpe.encode(docs, ranks(), public_tokenizers.PATTERN)
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("bigint"))


STAGES = [
    ("quality classifier", drop_poor),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_personal_data),
    ("byte-level BPE", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
