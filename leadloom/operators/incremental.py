"""Duplicate removal that follows a growing base: each load costs as much as what it touches.

The outcome of the five-key rule over all leads ever absorbed is kept as a stored *state*: one
line for each distinct row and key, with the row's place in the order, all its keys, its copies
and whether it is kept.  Lines are partitioned by a hash of the key, so the lines of a few keys
lie in a few files.

A row's outcome depends on earlier rows only, so a load changes outcomes along the order.  The
new rows are decided first, by the same search as everywhere, with the kept rows that stand
before them fixed.  Where an outcome changed, the later rows that share a key and may change
with it are decided next: rows that were kept if the changed row is kept now, rows that were
dropped if it is not.  This goes on until nothing changes.  It ends, because the earliest wrong
outcome is put right in every round, and what it ends with is the outcome of a full run.

Each load writes its changed lines to a folder of its own, the later line of a row counting.  A
load that is repeated reads what was there before it and replaces its folder, so it changes
nothing twice.  ``compact`` writes one snapshot; a snapshot counts from the moment it is complete,
and only then are the folders that it stands for deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.operators.identity import BLOCK_ROWS, ORDER, Resolution, key_rows, settle, tangled_rows
from leadloom.session import cut_lineage
from leadloom.sources import files

#: Partitions of a new state.  A load opens those of the keys it touches.
PARTS = 256

ROW = T.StructType(
    [
        T.StructField("touch_rank", T.IntegerType()),
        T.StructField("no_lead_id", T.BooleanType()),
        T.StructField("lead_id", T.StringType()),
        T.StructField("row_id", T.StringType()),
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("copies", T.LongType()),
        T.StructField("kept", T.BooleanType()),
    ]
)
LINE = T.StructType(
    [*ROW.fields, T.StructField("key", T.StringType()), T.StructField("version", T.LongType()), T.StructField("part", T.IntegerType())]
)


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _order(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in ORDER])


def _root(spark: SparkSession, path: str, parts: int = PARTS) -> tuple[str, int]:
    """Where the lines are, and their number of partitions, which stays what it was at first."""
    there = [name for name in files.names(spark, path) if name.startswith("parts-")]
    name = there[0] if there else f"parts-{parts}"
    return f"{path}/{name}", _number(name)


def _number(name: str) -> int:
    return int(name.rpartition("-")[2])


def _folders(spark: SparkSession, path: str, before: int | None) -> list[str]:
    """The newest complete snapshot and the complete changes after it, up to the load before ``before``."""
    done = [f.name for f in files.folders(spark, path) if f.complete and (before is None or _number(f.name) < before)]
    snapshots = [name for name in done if name.startswith("snapshot-")]
    start = max(map(_number, snapshots), default=-1)
    return snapshots[-1:] + [name for name in done if name.startswith("changes-") and _number(name) > start]


def _lines(spark: SparkSession, path: str, before: int | None, parts: list[int] | None = None) -> DataFrame:
    """The lines that count, of some partitions or of all."""
    found = spark.createDataFrame([], LINE)
    for name in _folders(spark, path, before):
        lines = spark.read.schema(LINE).parquet(f"{path}/{name}")
        found = found.unionByName(lines if parts is None else lines.where(F.col("part").isin(parts)))
    columns = [c for c in LINE.fieldNames() if c not in ("key", "row_id", "part")]
    last = F.max_by(F.struct(*columns), "version").alias("last")
    return found.groupBy("key", "row_id").agg(last).select("key", "row_id", *[f"last.{c}" for c in columns])


def _save(rows: DataFrame, path: str, version: int, parts: int) -> None:
    lines = rows.select(*ROW.fieldNames(), F.explode("keys").alias("key"), F.lit(version).cast("bigint").alias("version"))
    placed = lines.withColumn("part", _part("key", parts))
    placed.repartition("part").sortWithinPartitions("part", "key").write.partitionBy("part").mode("overwrite").parquet(path)


def _decided(rows: DataFrame, block_rows: int) -> DataFrame:
    """``kept`` for rows against which no row outside stands."""
    settled = settle(tangled_rows(rows.drop("kept")), block_rows)[0].drop("shared")
    free = rows.drop("kept").join(settled.select("row_id"), "row_id", "left_anti").withColumn("kept", F.lit(True))
    return free.unionByName(settled)


@dataclass
class Absorbed:
    """Rows that a load decided (``row_id``, order, ``keys``, ``copies``, ``kept``), how often it looked, and how many stored lines it read."""

    rows: DataFrame
    rounds: int
    lines_read: int


def absorb(
    spark: SparkSession, path: str, leads: DataFrame, version: int, block_rows: int = BLOCK_ROWS, parts: int = PARTS
) -> Absorbed:
    """Take prepared leads (with ``row_id``) into the state at ``path`` as load number ``version``.

    Loads are numbered upwards; the last one can be repeated until it is part of a snapshot.
    """
    path, parts = _root(spark, path, parts)
    later = [f.name for f in files.folders(spark, path) if f.complete and _number(f.name) + f.name.startswith("snapshot-") > version]
    if later:
        raise ValueError(f"{later[-1]} is there already")
    new = cut_lineage(key_rows(leads)).where(F.size("keys") > 0)
    # Rows whose outcome is known by now; the latest counts.
    looked_at = cut_lineage(spark.createDataFrame([], ROW))
    asked = new.withColumn("kept", F.lit(None).cast("boolean"))
    rounds = lines_read = 0
    while True:
        rounds += 1
        asked = cut_lineage(asked)
        wanted = asked.select(F.explode("keys").alias("key")).distinct()
        touched = sorted(r.part for r in wanted.select(_part("key", parts).alias("part")).distinct().collect())  # ``parts`` at most
        stored = _lines(spark, path, version, touched).join(wanted, "key", "left_semi").drop("version")
        if rounds == 1:
            # Rows that are there already only have more copies.
            known = cut_lineage(stored.join(asked.select("row_id", F.col("copies").alias("more")), "row_id").dropDuplicates(["row_id"]))
            looked_at = known.select(*[F.col(c) + F.col("more") if c == "copies" else F.col(c) for c in ROW.fieldNames()]).toDF(*ROW.fieldNames())
            asked = asked.join(known.select("row_id"), "row_id", "left_anti")
        changed_now = looked_at.select(*ROW.fieldNames(), F.explode("keys").alias("key")).join(wanted, "key", "left_semi")
        around = cut_lineage(stored.join(looked_at.select("row_id"), "row_id", "left_anti").unionByName(changed_now))
        lines_read += around.count()
        outside = around.join(asked.select("row_id"), "row_id", "left_anti")
        stands = outside.where("kept").select("key", _order().alias("owner"))
        blocked = (
            asked.select("row_id", _order().alias("self"), F.explode("keys").alias("key"))
            .join(stands, "key")
            .where(F.col("owner") < F.col("self"))
            .select("row_id")
            .distinct()
        )
        blocked = cut_lineage(blocked)
        refused = asked.join(blocked, "row_id", "left_semi").withColumn("kept", F.lit(False))
        decided = cut_lineage(_decided(cut_lineage(asked.join(blocked, "row_id", "left_anti")), block_rows).unionByName(refused))
        was = asked.select("row_id", F.coalesce("kept", F.lit(False)).alias("was"))
        changed = decided.join(was, "row_id").where(F.col("kept") != F.col("was"))
        looked_at = cut_lineage(looked_at.join(decided.select("row_id"), "row_id", "left_anti").unionByName(decided))
        turned = changed.select(F.explode("keys").alias("key"), "kept", _order().alias("self")).groupBy("key", "kept").agg(F.min("self").alias("self"))
        next_rows = (
            outside.join(turned.withColumnRenamed("kept", "now"), "key")
            .where((F.col("now") == F.col("kept")) & (F.col("self") < _order()))
            .select(*ROW.fieldNames())
            .dropDuplicates(["row_id"])
        )
        asked = cut_lineage(next_rows)
        if asked.isEmpty():
            break
    _save(looked_at, f"{path}/changes-{version:010d}", version, parts)
    return Absorbed(looked_at, rounds, lines_read)


def compact(spark: SparkSession, path: str) -> None:
    """One snapshot instead of all folders so far; a load that ends half-way is left out."""
    rows = current(spark, path)
    path, parts = _root(spark, path)
    found = _folders(spark, path, None)
    if len(found) < 2:
        return
    version = _number(found[-1])
    _save(rows, f"{path}/snapshot-{version:010d}", version, parts)
    for name in found:
        files.delete(spark, f"{path}/{name}")


def current(spark: SparkSession, path: str) -> DataFrame:
    """Every distinct keyed row with ``kept``, over all loads."""
    return _lines(spark, _root(spark, path)[0], None).where(F.col("key") == F.col("keys")[0]).select(*ROW.fieldNames())


def resolution(spark: SparkSession, path: str) -> Resolution:
    """The state as the outcome of a search, for ``drop_duplicates`` and ``duplicate_audit``."""
    rows = current(spark, path)
    return Resolution(rows.drop("kept"), rows, 0)
