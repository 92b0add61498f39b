"""Stored identity keys of the permanent base, so that a batch is checked without reading the base.

The index is a table of ``key``, ``lead_id`` and ``batch_id``, bucketed and sorted by ``key`` and
partitioned by batch.  A check joins it bucket by bucket: the index is never shuffled, whatever
its size, and the wide base is not opened.  Every load adds one partition; a repeated batch
replaces its own and no other.

The table is external and lies in ``<index_path>/keys-<buckets>``, so the number of buckets cannot
be mistaken; a session that does not know it yet registers it and finds its partitions.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators import batch
from leadloom.sources import files
from leadloom.sources.tables import BATCH_COLUMN, find_base

#: Enough for buckets of a gigabyte at some billions of leads.
BUCKETS = 64


def _register(spark: SparkSession, index_path: str, buckets: int) -> str:
    """Name of the table; partitions written by others are found."""
    kept = [name for name in files.names(spark, index_path) if name.startswith("keys-")]
    folder = kept[0] if kept else f"keys-{buckets}"
    location = f"{index_path.rstrip('/')}/{folder}"
    name = f"leadloom_keys_{hashlib.md5(location.encode()).hexdigest()}"
    quoted = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (key STRING, lead_id STRING, {BATCH_COLUMN} STRING) USING parquet "
        f"PARTITIONED BY ({BATCH_COLUMN}) CLUSTERED BY (key) SORTED BY (key) INTO {folder.removeprefix('keys-')} BUCKETS "
        f"LOCATION '{quoted}'"
    )
    if kept:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
    return name


def _buckets_of(spark: SparkSession, name: str) -> int:
    described = spark.sql(f"DESCRIBE EXTENDED {name}").where(F.col("col_name") == "Num Buckets").first()
    return int(described["data_type"])


def store_keys(spark: SparkSession, index_path: str, leads: DataFrame, batch_id: str | int, buckets: int = BUCKETS) -> None:
    """Make the keys of the cleaned ``leads`` the batch's own, whatever it had before."""
    name = _register(spark, index_path, buckets)
    # One file a bucket; a key that many leads have is combined before it is shuffled.
    spread = batch.known_keys(leads).repartition(_buckets_of(spark, name), "key")
    view = f"{name}_new"
    spread.select("key", F.col("matched_lead_id").alias("lead_id")).createOrReplaceTempView(view)
    value = str(batch_id).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({BATCH_COLUMN} = '{value}') SELECT key, lead_id FROM {view}")
    spark.catalog.dropTempView(view)


def build(spark: SparkSession, base_path: str, index_path: str, buckets: int = BUCKETS) -> None:
    """Index of a base that has none, all batches in one pass; a repeat starts anew."""
    base = find_base(spark, base_path)
    location = f"{index_path.rstrip('/')}/keys-{buckets}"
    files.delete(spark, index_path)
    name = _register(spark, index_path, buckets)
    if base is None:
        return
    keys = (
        base.select(BATCH_COLUMN, "lead_id", F.explode(batch.identity_keys(clean=True)).alias("key"))
        .groupBy("key", BATCH_COLUMN)
        .agg(F.min("lead_id").alias("lead_id"))
        .repartition(buckets, "key")
        .select("key", "lead_id", BATCH_COLUMN)
    )
    view = f"{name}_all"
    keys.createOrReplaceTempView(view)
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({BATCH_COLUMN}) SELECT key, lead_id, {BATCH_COLUMN} FROM {view}")
    finally:
        spark.conf.set(setting, before)
    spark.catalog.dropTempView(view)
    # Says that all batches are in; without it the index is built again.
    spark.range(0).write.mode("overwrite").parquet(f"{location}/_complete")


def read_index(spark: SparkSession, index_path: str, buckets: int = BUCKETS) -> DataFrame:
    """``key``, ``lead_id`` and ``batch_id`` of all batches."""
    return spark.table(_register(spark, index_path, buckets))


def held_keys(spark: SparkSession, base_path: str, index_path: str, buckets: int = BUCKETS) -> DataFrame:
    """The index of a base; built first where it is not there or was not finished."""
    kept = [name for name in files.names(spark, index_path) if name.startswith("keys-")]
    if not kept or "_complete" not in files.names(spark, f"{index_path}/{kept[0]}"):
        build(spark, base_path, index_path, buckets)
    return read_index(spark, index_path, buckets)
