"""Incremental load as a stream that keeps the identity keys of the base in its state.

No micro-batch reads the base or an index of it.  Two streams are grouped by key: the keys that
arriving leads ask for, and the keys that were taken up, which come as files: those of the base
when the stream starts, later those of the leads that a micro-batch added.  What a micro-batch
adds is therefore known to the next, not to itself, as in ``ingest_stream``.  A group is one
aggregate, whether its key is held and by which least lead, so a micro-batch costs a look-up for
each of its keys, combined before the shuffle; the leads themselves go past the groups and meet
the answers in a join as large as the micro-batch.  So whether a lead is new may hang on all its
keys, while state knows one key each.  Keys that were asked for and not found stay in the state too.

State lies in a key-value store on the executors' disks, of which only changes are saved with each
micro-batch.  A micro-batch that was not finished is done again from the state and the files that
its checkpoint names, and replaces what it had written.

The number of state partitions is that of ``spark.sql.shuffle.partitions`` at the first start.

A checkpoint of an earlier version holds the state of a Python function (``answer``) that is called
for each key.  Such a stream goes on in that form, at some milliseconds of a core for each key; a
new ``progress_path`` takes up the base anew, and reads the incoming files that are there again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from leadloom import rules
from leadloom.functions.keys import identity_keys
from leadloom.functions.logic import ColumnLike, as_column
from leadloom.operators.additional import pack
from leadloom.operators.batch import check_keys, held_keys, known_keys
from leadloom.session import cut_lineage
from leadloom.sources import files
from leadloom.sources.tables import (
    BATCH_COLUMN,
    CSV_OPTIONS,
    LINE_OPTIONS,
    align_raw,
    batch_path,
    csv_schema,
    divide_lines,
    find_base,
)
from leadloom.streaming.ingest import incoming_schema, loaded_rows, write_load

KEY_SCHEMA = f"key string, lead_id string, {BATCH_COLUMN} string"
#: Groups in which leads pass through the stateful step of ``answer``, for each partition of the state.
PASSING = 4

ROW, LINE, ASKED, HELD = "row", "line", "asked", "held"
ENTRY = "kind string, key string, lead_id string, fields array<string>"

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def answer(group: tuple[str], entries: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Pass leads on; take in held keys; say once whether a key that is asked for is held, and by which least lead."""
    (key,) = group
    known, changed, asked = state.exists, False, False
    least = state.get[0] if known else None
    for part in entries:
        kind = part["kind"]
        passing = part[(kind == ROW) | (kind == LINE)]
        if len(passing):
            yield passing[["kind", "key", "lead_id", "fields"]]
        asked = asked or bool((kind == ASKED).any())
        held = part.loc[kind == HELD, "lead_id"]
        if len(held):
            here = min(held.dropna(), default=None)
            if not known or (here is not None and (least is None or here < least)):
                least, known, changed = here, True, True
    if changed:
        state.update((least,))
    if asked and known:
        yield pd.DataFrame({"kind": [HELD], "key": [key], "lead_id": [least], "fields": [None]})


def _entry(kind: str, key: ColumnLike | None = None, lead_id: ColumnLike | None = None, fields: Column | None = None) -> list[Column]:
    """Columns of ``ENTRY``."""
    text = [F.lit(None) if c is None else as_column(c) for c in (key, lead_id)]
    fields = F.lit(None) if fields is None else fields
    return [
        F.lit(kind).alias("kind"),
        text[0].cast("string").alias("key"),
        text[1].cast("string").alias("lead_id"),
        fields.cast("array<string>").alias("fields"),
    ]


def _fields(leads: DataFrame) -> Column:
    return F.array(*[F.col("`" + name.replace("`", "``") + "`") for name in leads.columns])


def answers_by_state(leads: DataFrame, lines: DataFrame | None, taken: DataFrame) -> DataFrame:
    """Leads and lines as they came, and the keys of this micro-batch that are held, each with its least lead."""
    asked = leads.select(F.explode(identity_keys()).alias("key"), F.lit(None).cast("string").alias("lead_id"), F.lit(False).alias("held"))
    found = (
        asked.unionByName(taken.select("key", "lead_id", F.lit(True).alias("held")))
        .groupBy("key")
        .agg(F.bool_or("held").alias("held"), F.min("lead_id").alias("lead_id"))
        .where("held")
    )
    answered = found.select(*_entry(HELD, "key", "lead_id")).unionByName(leads.select(*_entry(ROW, fields=_fields(leads))))
    return answered if lines is None else answered.unionByName(lines.select(*_entry(LINE, lead_id="line")))


def answers_by_function(leads: DataFrame, lines: DataFrame | None, taken: DataFrame) -> DataFrame:
    """The same by ``answer``, for checkpoints that hold its state."""
    groups = PASSING * int(leads.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def place(of: Column) -> Column:
        # Copies of one lead in several files pass through several groups.
        return F.concat(F.lit("pass-"), F.pmod(F.xxhash64(of, F.spark_partition_id()), F.lit(groups)))

    fields = _fields(leads)
    asks = F.transform(F.array_distinct(identity_keys()), lambda key: F.struct(*_entry(ASKED, key)))
    own = F.array(F.struct(*_entry(ROW, place(fields), fields=fields)))
    entries = leads.select(F.inline(F.concat(own, asks))).unionByName(taken.select(*_entry(HELD, "key", "lead_id")))
    if lines is not None:
        entries = entries.unionByName(lines.select(*_entry(LINE, place(F.col("line")), "line")))
    return entries.groupBy("key").applyInPandasWithState(answer, ENTRY, "lead_id string", "append", "NoTimeout")


def has_function_state(spark: SparkSession, checkpoint: str) -> bool:
    """Whether the checkpoint is one of an earlier version, whose state ``answer`` keeps."""
    if not files.exists(spark, f"{checkpoint}/state/0/_metadata"):
        return False  # nothing was loaded yet
    kept = spark.read.format("state-metadata").load(checkpoint).select("operatorName")
    return not kept.where(F.col("operatorName") != "stateStoreSave").isEmpty()


def take_up_base(spark: SparkSession, base_path: str, keys_path: str) -> None:
    """Write the keys of those batches of the base that are not among the stream's files yet."""
    mark = f"{BATCH_COLUMN}="
    there = {name for name in files.names(spark, keys_path) if name.startswith(mark)}
    base = find_base(spark, base_path)
    if base is not None:
        batches = [row[0] for row in base.select(BATCH_COLUMN).distinct().collect()]  # one row for each batch
        missing = [b for b in batches if batch_path("", b).removeprefix("/") not in there]
        if missing:
            # One file set for all: its name is that of no batch, so each gets an empty partition too.
            keys = held_keys(base.where(F.col(BATCH_COLUMN).isin(missing))).groupBy("key").agg(F.min("lead_id").alias("lead_id"))
            number = sum(name.startswith(f"{mark}taken-") for name in there)
            keys.write.mode("overwrite").parquet(f"{keys_path}/{mark}taken-{number:08d}")
            for b in missing:
                keys.limit(0).coalesce(1).write.mode("overwrite").parquet(batch_path(keys_path, b))
    elif not there:
        spark.createDataFrame([], "key string, lead_id string").coalesce(1).write.mode("overwrite").parquet(
            f"{keys_path}/{mark}taken-{0:08d}"
        )


def keyed_stream(
    spark: SparkSession,
    incoming_path: str,
    base_path: str,
    rejections_path: str,
    progress_path: str,
    as_of: date,
    file_format: str = "parquet",
    max_files_per_batch: int = 1000,
    within_batch: bool = False,
    brand: rules.Brand = rules.Brand(),
    stream_name: str = "stream",
    multi_line: bool = True,
    every: str = "0 seconds",
) -> StreamingQuery:
    """Load files as they come, until stopped.  See ``ingest_keyed`` for a run that ends by itself.

    Base and log are those of ``ingest_stream``.  ``progress_path`` holds the checkpoint and the keys
    taken up.  While it runs the stream is the only writer of the base; batches that others loaded
    before it was started are taken up then.  A batch of theirs that is loaded again with other leads needs a
    new ``progress_path``.
    """
    checkpoint, keys_path = f"{progress_path}/checkpoint", f"{progress_path}/keys"
    take_up_base(spark, base_path, keys_path)
    csv = file_format == "csv"
    options = {"multiLine": multi_line, **CSV_OPTIONS} if csv else {"mergeSchema": True}
    schema = incoming_schema(spark, incoming_path, file_format, options)
    if csv:
        schema, options = csv_schema(schema), options | LINE_OPTIONS
    reader = spark.readStream.schema(schema).options(**options).option("maxFilesPerTrigger", max_files_per_batch)
    incoming = reader.format(file_format).load(incoming_path)
    leads, surplus = divide_lines(incoming) if csv else (incoming, None)
    leads = align_raw(leads)
    names = leads.columns
    taken = spark.readStream.schema(KEY_SCHEMA).parquet(keys_path)
    by_function = has_function_state(spark, checkpoint)
    answers = (answers_by_function if by_function else answers_by_state)(leads, surplus, taken)

    def load(answered: DataFrame, batch_id: int) -> None:
        answered = cut_lineage(answered)  # state must not be asked twice
        if answered.where(F.col("kind") != HELD).isEmpty():
            return
        kept = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()
        name = f"{stream_name}-{kept['id']}-{batch_id}"
        if csv:
            lines = answered.where(F.col("kind") == LINE).select(F.col("lead_id").alias("line"))
            lines.write.mode("overwrite").parquet(batch_path(f"{rejections_path}-lines", name))
        rows = answered.where(F.col("kind") == ROW)
        rows = rows.select(*[F.col("fields")[i].alias(n) for i, n in enumerate(names)])
        known = answered.where(F.col("kind") == HELD).select("key", "lead_id")
        write_load(check_keys(pack(rows), known), base_path, rejections_path, name, as_of, within_batch, brand)
        new = known_keys(loaded_rows(spark, base_path, name)).withColumnRenamed("matched_lead_id", "lead_id")
        new.write.mode("overwrite").parquet(batch_path(keys_path, name))

    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        return (
            answers.writeStream.foreachBatch(load)
            .outputMode("append" if by_function else "update")
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=every)
            .start()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def ingest_keyed(*args, **settings) -> None:
    """``keyed_stream`` until all files that are there are loaded and their keys are in the state; same arguments."""
    stream = keyed_stream(*args, **settings)
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
