"""Exact positions in a sorted table without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.session import cut_lineage


def with_position(
    df: DataFrame, order_by: Sequence[Column], name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Add the 1-based position in ``order_by`` order, counted anew for each ``within`` value.

    Rows that tie in ``order_by`` follow a digest of the whole row, so equal input gives
    equal positions.  Rows are range-partitioned on ``within`` and
    ``order_by`` together, so one value that holds a third of all rows still
    spreads over many tasks.  A window then numbers only the small table of row
    counts per task and value.  The sorted rows are checkpointed first because
    range bounds come from a sample and must not change between the two uses.
    """
    keys = [F.col(c).asc_nulls_first() for c in within]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order_by = [*order_by, F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]).asc()]
    placed = cut_lineage(
        df.repartitionByRange(tasks, *keys, *order_by)
        .sortWithinPartitions(*keys, *order_by)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_task", F.shiftright("_at", 33))
    )
    blocks = placed.groupBy("_task", *within).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    # One row per task and value: bounded by the tasks plus the number of values.
    earlier = Window.partitionBy(*within).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        F.col("_task").alias("_block"),
        *[F.col(c).alias(f"_of_{c}") for c in within],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    match = F.col("_task") == F.col("_block")
    for c in within:
        match = match & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return (
        placed.join(starts, match)
        .withColumn(name, (F.col("_at") + F.col("_shift")).cast("bigint"))
        .drop("_at", "_task", "_block", "_shift", *[f"_of_{c}" for c in within])
    )
