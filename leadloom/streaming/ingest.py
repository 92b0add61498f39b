"""Incremental load as a stream of files."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from leadloom import rules
from leadloom.operators.additional import pack
from leadloom.operators.batch import check_batch, check_keys, clean_new_leads, new_rows, rejections
from leadloom.schema import CLEAN_KEYS, LEAD_TYPES, RAW_SCHEMA
from leadloom.session import cut_lineage
from leadloom.sources import files, key_index
from leadloom.sources.tables import (
    BATCH_COLUMN,
    CSV_OPTIONS,
    LINE_OPTIONS,
    align_raw,
    append_to_base,
    batch_path,
    compact_base,
    csv_schema,
    divide_lines,
    find_base,
)


@dataclass(frozen=True)
class LoadCounts:
    """What a load did, counted while its tables were written."""

    incoming: int
    rejected: int
    added: int
    added_by_type: dict[str, int]
    with_signals: int


def load_batch(
    incoming: DataFrame,
    base_path: str,
    rejections_path: str,
    batch_id: str | int,
    as_of: date,
    within_batch: bool = False,
    brand: rules.Brand = rules.Brand(),
    index_path: str | None = None,
    compact_at: int | None = None,
) -> LoadCounts:
    """Check one batch against the base, add the new leads, log the others.

    Both outputs go to the batch's own partition, and the batch is not compared
    with what an earlier attempt of itself wrote: a repeat gives the same result.

    With an ``index_path`` the batch is checked against the keys stored there, and the base
    is not read; the index is built from the base if it is not there yet, and gets the keys of
    the new leads.  With ``compact_at``, partitions are gathered when there are that many.
    """
    spark = incoming.sparkSession
    incoming = pack(align_raw(incoming))
    if index_path is not None:
        held = key_index.held_keys(spark, base_path, index_path)
        checked = check_keys(incoming, held.where(F.col(BATCH_COLUMN) != str(batch_id)))
    elif (base := find_base(spark, base_path)) is not None:
        checked = check_batch(incoming, base.where(F.col(BATCH_COLUMN) != str(batch_id)))
    else:
        checked = incoming.withColumns(
            {"reason": F.lit(None).cast("string"), "matched_lead_id": F.lit(None).cast("string")}
        )
    counts = write_load(checked, base_path, rejections_path, batch_id, as_of, within_batch, brand)
    if index_path is not None:
        key_index.store_keys(spark, index_path, loaded_rows(spark, base_path, batch_id), batch_id)
    if compact_at is not None and len([n for n in files.names(spark, base_path) if n.startswith(BATCH_COLUMN)]) >= compact_at:
        compact_base(spark, base_path)
    return counts


def write_load(
    checked: DataFrame,
    base_path: str,
    rejections_path: str,
    batch_id: str | int,
    as_of: date,
    within_batch: bool = False,
    brand: rules.Brand = rules.Brand(),
) -> LoadCounts:
    """Write the two outputs of a checked batch, each to the batch's own partition."""
    arrived, added = Observation(), Observation()
    checked = cut_lineage(
        checked.observe(arrived, F.count(F.lit(1)).alias("incoming"), F.count_if(F.col("reason").isNotNull()).alias("rejected"))
    )
    fresh = clean_new_leads(new_rows(checked), as_of, within_batch, brand)
    rejections(checked).write.mode("overwrite").parquet(batch_path(rejections_path, batch_id))
    by_type = [F.count_if(F.col("lead_type") == kind).alias(kind) for kind in LEAD_TYPES]
    signals = F.count_if(F.col("personalisation_signals") != "").alias("with_signals")
    append_to_base(fresh.observe(added, F.count(F.lit(1)).alias("added"), *by_type, signals), base_path, batch_id)
    new = added.get
    return LoadCounts(
        arrived.get["incoming"], arrived.get["rejected"], new["added"], {k: new[k] for k in LEAD_TYPES}, new["with_signals"]
    )


def loaded_rows(spark: SparkSession, base_path: str, batch_id: str | int) -> DataFrame:
    """What a load added, with the columns its keys are made of; no other partition is opened."""
    return spark.read.schema(CLEAN_KEYS).parquet(batch_path(base_path, batch_id))


def incoming_schema(spark: SparkSession, path: str, file_format: str, options: dict) -> StructType:
    """Columns of the files that are there; the known ones if there is no file yet."""
    try:
        return spark.read.options(**options).format(file_format).load(path).schema
    except AnalysisException as failure:
        if failure.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return RAW_SCHEMA
        raise


def ingest_stream(
    spark: SparkSession,
    incoming_path: str,
    base_path: str,
    rejections_path: str,
    checkpoint_path: str,
    as_of: date,
    file_format: str = "parquet",
    max_files_per_batch: int = 1000,
    within_batch: bool = False,
    brand: rules.Brand = rules.Brand(),
    stream_name: str = "stream",
    multi_line: bool = True,
    index_path: str | None = None,
    compact_at: int | None = None,
) -> StreamingQuery:
    """Load all files that are new since the last run, then stop.

    Columns are those of the files found at the start; additional ones go to the base.
    CSV lines with more fields than the header are logged in ``<rejections_path>-lines``.
    With an ``index_path`` no micro-batch reads the base, see ``load_batch``.

    Each micro-batch is joined with the base as it is at that moment, so leads of
    one batch are known to the next.  Its partition carries the stream's name and the
    id that the checkpoint keeps, so another stream, or the same one after it lost its
    checkpoint, never writes to a partition of this one.
    """
    options = {"multiLine": multi_line, **CSV_OPTIONS} if file_format == "csv" else {"mergeSchema": True}
    schema = incoming_schema(spark, incoming_path, file_format, options)
    if file_format == "csv":
        schema, options = csv_schema(schema), options | LINE_OPTIONS
    reader = spark.readStream.schema(schema).options(**options).option("maxFilesPerTrigger", max_files_per_batch)

    def load(incoming: DataFrame, batch_id: int) -> None:
        kept = spark.read.schema("id string").json(f"{checkpoint_path}/metadata").first()
        name = f"{stream_name}-{kept['id']}-{batch_id}"
        if file_format == "csv":
            incoming, surplus = divide_lines(incoming)
            surplus.write.mode("overwrite").parquet(batch_path(f"{rejections_path}-lines", name))
        load_batch(incoming, base_path, rejections_path, name, as_of, within_batch, brand, index_path, compact_at)

    return (
        reader.format(file_format)
        .load(incoming_path)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
