"""Reading and writing lead tables.

The permanent base is a folder with one partition for each batch:

* ``batch_id=id-<batch>`` holds a batch as it was loaded.  ``compact_base`` gathers small ones in
  ``batch_id=merged-<number>``, where ``_of_batch`` says whose a row is, and records the batches in
  ``_merged`` once all is written.  A partition of its own always counts before the gathered rows
  of the same batch, and a later gathering before an earlier one: a run that ends half-way leaves
  nothing twice, and a batch loaded again after it was gathered replaces its rows.
* ``_schemas`` has one small file for each set of columns a batch has brought, so reading the base
  opens no data file to learn its columns.
"""

from __future__ import annotations

import hashlib
import json
from datetime import date
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.operators.batch import append_columns
from leadloom.schema import CONFIRMATION_SCHEMA, RAW_SCHEMA
from leadloom.sources import files

BATCH_COLUMN = "batch_id"
BATCH_MARK = "id-"
MERGED_MARK = "merged-"
OF_BATCH = "_of_batch"
FIRST_LOAD = "first_load"
RUN_DATE = "run_date"
LINE = "_line"


# Headers are checked in every file: a file with another column order is refused.
CSV_OPTIONS = {"header": True, "nullValue": "", "quote": '"', "escape": '"', "enforceSchema": False}


def csv_schema(found: T.StructType) -> T.StructType:
    """The columns as text, and the line itself where its number of fields is another."""
    texts = [T.StructField(field.name, T.StringType()) for field in found]
    return T.StructType([*texts, T.StructField(LINE, T.StringType())])


#: With ``csv_schema``: all columns are parsed even if few are read, or nobody would count the fields.
LINE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE, "columnPruning": False}


def surplus_fields(columns: list[str]) -> Column:
    """Whether the line has more fields than there are columns; a quoted comma divides nothing."""
    outside = F.regexp_replace(LINE, '"([^"]|"")*"', "")
    surplus = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) >= len(columns)
    # Spark refuses to read the line alone: another column is looked at in every plan.
    looked = F.length(F.coalesce(F.col("`" + columns[0].replace("`", "``") + "`"), F.lit(""))) >= 0
    return F.coalesce(surplus, F.lit(False)) & looked


def divide_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leads, and the lines that cannot be read without losing a field.

    A line with too few fields is a lead whose last columns are missing.
    """
    surplus = surplus_fields([c for c in lines.columns if c != LINE])
    return lines.where(~surplus).drop(LINE), lines.where(surplus).select(F.col(LINE).alias("line"))


def read_leads_csv(spark: SparkSession, path: str, multi_line: bool = True, quarantine_path: str | None = None) -> DataFrame:
    """CSV with a header; every column is text, blanks are null.

    Columns are found by name; missing ones are null and additional ones are
    kept, as text, too.  Texts may contain line breaks, which makes one file one
    task: for huge files without them pass ``multi_line=False``.

    Lines with more fields than the header are written to ``quarantine_path``, replacing
    what is there; without such a path the first of them ends the job with an error.
    """
    options = {"multiLine": multi_line, **CSV_OPTIONS}
    header = spark.read.options(**options).csv(path).schema
    lines = spark.read.options(**options, **LINE_OPTIONS).schema(csv_schema(header)).csv(path)
    if quarantine_path is None:
        refused = F.raise_error(F.concat(F.lit("more fields than the header has: "), F.col(LINE)))
        passed = lines.where(~surplus_fields(header.names) | F.isnotnull(refused.cast("string")))
        return align_raw(passed.drop(LINE))
    leads, surplus = divide_lines(lines)
    surplus.write.mode("overwrite").parquet(quarantine_path)
    return align_raw(leads)


def read_leads_parquet(spark: SparkSession, path: str) -> DataFrame:
    return align_raw(spark.read.parquet(path))


def align_raw(found: DataFrame) -> DataFrame:
    """The known columns first, as text, then any additional columns."""
    there = {name.lower() for name in found.columns}
    known = [
        (F.col(field.name) if field.name in there else F.lit(None)).cast("string").alias(field.name)
        for field in RAW_SCHEMA
    ]
    other = [
        F.col("`" + name.replace("`", "``") + "`").cast("string").alias(name)
        for name in found.columns
        if name.lower() not in RAW_SCHEMA.names
    ]
    return found.select(*known, *other)


def read_leads(
    spark: SparkSession, path: str, file_format: str = "parquet", multi_line: bool = True, quarantine_path: str | None = None
) -> DataFrame:
    """Leads of a format; the last two arguments count for CSV, see ``read_leads_csv``."""
    return read_leads_csv(spark, path, multi_line, quarantine_path) if file_format == "csv" else read_leads_parquet(spark, path)


def write_leads(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Replace an output table."""
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer.options(
            header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    else:
        writer.parquet(path)


def write_dated(df: DataFrame, path: str, day: date, file_format: str = "parquet") -> None:
    """Write the output of one day; a repeat replaces that day, even by nothing, and no other."""
    write_leads(df.drop(RUN_DATE), f"{path}/{RUN_DATE}={day.isoformat()}", file_format)


def read_dated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All days of an output, with ``run_date``; a filter on it keeps other days' files closed."""
    fields = [f for f in schema if f.name != RUN_DATE]
    return spark.read.schema(T.StructType([*fields, T.StructField(RUN_DATE, T.DateType())])).parquet(path)


def append_to_base(new: DataFrame, base_path: str, batch_id: str | int) -> None:
    """Add rows to the permanent base without touching the rows already there.

    A batch owns one partition; writing the same batch again replaces only that
    partition, so a repeated job adds nothing twice.  A ``batch_id`` column of the
    rows gives way to the partition's.
    """
    rows = new.drop(BATCH_COLUMN, OF_BATCH)
    record_schema(new.sparkSession, base_path, rows.schema)
    rows.write.mode("overwrite").parquet(batch_path(base_path, batch_id))


def batch_path(path: str, batch_id: str | int) -> str:
    """Partition of a batch.  The mark in front keeps Spark from reading ids as numbers or dates."""
    return f"{path}/{BATCH_COLUMN}={BATCH_MARK}{quote(str(batch_id), safe='')}"


def _schemas(spark: SparkSession, base_path: str) -> list[T.StructType]:
    if "_schemas" not in files.names(spark, base_path):
        return []
    lines = spark.read.text(f"{base_path}/_schemas/*").collect()  # one for each set of columns
    return [T.StructType.fromJson(json.loads(line.value)) for line in sorted(lines, key=lambda line: line.value)]


def merged_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns by name, in any case; the first spelling stays, and types must agree."""
    fields: dict[str, T.StructField] = {}
    for field in (f for schema in schemas for f in schema):
        known = fields.setdefault(field.name.lower(), T.StructField(field.name, field.dataType))
        if known.dataType != field.dataType:
            raise ValueError(f"{field.name} is {known.dataType.simpleString()} in the base and {field.dataType.simpleString()} here")
    return T.StructType(list(fields.values()))


def record_schema(spark: SparkSession, base_path: str, schema: T.StructType) -> None:
    """Note the columns of a batch before it is written; known ones need no note."""
    known = _schemas(spark, base_path)
    if not known and (found := _discovered(spark, base_path)) is not None:
        # A base from before columns were noted.
        known = [T.StructType([f for f in found.schema if f.name not in (BATCH_COLUMN, OF_BATCH)])]
        _note_schema(spark, base_path, known[0])
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    if not known or merged_schema([*known, plain]) != merged_schema(known):
        _note_schema(spark, base_path, plain)


def _note_schema(spark: SparkSession, base_path: str, schema: T.StructType) -> None:
    text = schema.json()
    name = hashlib.md5(text.encode()).hexdigest()
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base_path}/_schemas/{name}")


def _discovered(spark: SparkSession, base_path: str) -> DataFrame | None:
    """The base with the columns its files name: every footer is read."""
    if not files.exists(spark, base_path) or set(files.names(spark, base_path)) <= {"_schemas", "_merged"}:
        return None
    return spark.read.options(mergeSchema=True, basePath=base_path).parquet(base_path)


def _gatherings(spark: SparkSession, base_path: str, names: list[str]) -> dict[str, list[str]]:
    """The batches of every finished gathering, by its partition value."""
    if "_merged" not in names:
        return {}
    lines = spark.read.text(f"{base_path}/_merged/*").collect()  # a line for each gathering
    found = [json.loads(line.value) for line in lines]
    return {f["name"]: f["batches"] for f in sorted(found, key=lambda f: f["name"])}


def _singles(names: list[str]) -> set[str]:
    start = f"{BATCH_COLUMN}={BATCH_MARK}"
    return {unquote(name.removeprefix(start)) for name in names if name.startswith(start)}


def find_base(spark: SparkSession, base_path: str) -> DataFrame | None:
    """The whole base, or none if its path does not exist; any other failure is raised.

    Later batches may have brought additional columns.
    """
    schemas = _schemas(spark, base_path)
    names = files.names(spark, base_path)
    gathered = _gatherings(spark, base_path, names)
    if schemas:
        if not any(name.startswith(f"{BATCH_COLUMN}=") for name in names):
            return None
        kinds = [T.StructField(OF_BATCH, T.StringType()), T.StructField(BATCH_COLUMN, T.StringType())]
        schema = T.StructType([*merged_schema(schemas).fields, *kinds])
        found = spark.read.schema(schema).option("basePath", base_path).parquet(base_path)
    else:
        found = _discovered(spark, base_path)
        if found is None:
            return None
        found = found.withColumn(OF_BATCH, F.lit(None).cast("string"))
    value = F.col(BATCH_COLUMN).cast("string")
    live = ~value.startswith(MERGED_MARK)
    later = _singles(names)
    for name in reversed(gathered):
        own = value == name
        gone = sorted(later & set(gathered[name]))
        live = live | (own & ~F.col(OF_BATCH).isin(gone) if gone else own)
        later |= set(gathered[name])
    marked = F.substr(value, F.lit(len(BATCH_MARK) + 1))
    batch = F.when(value.startswith(BATCH_MARK), marked).when(value.startswith(MERGED_MARK), F.col(OF_BATCH)).otherwise(value)
    rows = found.where(live) if any(name.startswith(f"{BATCH_COLUMN}={MERGED_MARK}") for name in names) else found
    return rows.withColumn(BATCH_COLUMN, batch).drop(OF_BATCH)


def compact_base(spark: SparkSession, base_path: str, least_bytes: int = 256 << 20, file_bytes: int = 256 << 20) -> int:
    """Gather the partitions below ``least_bytes`` in one, ordered by lead; returns how many there were.

    Large gatherings are left alone, so a row is rewritten about as often as the logarithm of
    its base.  Run one at a time; a batch that is loaded again meanwhile keeps its partition.
    """
    start = f"{BATCH_COLUMN}="
    found = [f for f in files.folders(spark, base_path) if f.name.startswith(start)]
    gathered = _gatherings(spark, base_path, files.names(spark, base_path))
    unfinished = [f for f in found if f.name.startswith(start + MERGED_MARK) and f.name.removeprefix(start) not in gathered]
    for folder in unfinished:
        files.delete(spark, f"{base_path}/{folder.name}")
    small = [f for f in found if f.size < least_bytes and f not in unfinished]
    base = find_base(spark, base_path)
    if base is None or len(small) < 2:
        return 0
    batches = _singles([f.name for f in small])
    batches |= {b for f in small for b in gathered.get(f.name.removeprefix(start), ())}
    number = 1 + max([int(name.removeprefix(MERGED_MARK)) for name in gathered], default=0)
    name = f"{MERGED_MARK}{number:08d}"
    tasks = 1 + sum(f.size for f in small) // file_bytes
    record_schema(spark, base_path, base.drop(BATCH_COLUMN).schema)
    rows = base.where(F.col(BATCH_COLUMN).isin(sorted(batches))).withColumnRenamed(BATCH_COLUMN, OF_BATCH)
    ordered = rows.repartitionByRange(tasks, "lead_id").sortWithinPartitions("lead_id")
    ordered.write.mode("overwrite").parquet(f"{base_path}/{start}{name}")
    _note_gathering(spark, base_path, name, sorted(batches))
    for folder in small:
        if files.modified(spark, f"{base_path}/{folder.name}") == folder.modified:
            files.delete(spark, f"{base_path}/{folder.name}")
            if folder.name.startswith(start + MERGED_MARK):
                files.delete(spark, f"{base_path}/_merged/{folder.name.removeprefix(start)}")
    return len(small)


def _note_gathering(spark: SparkSession, base_path: str, name: str, batches: list[str]) -> None:
    note = json.dumps({"name": name, "batches": batches})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base_path}/_merged/{name}")


def base_exists(spark: SparkSession, base_path: str) -> bool:
    return find_base(spark, base_path) is not None


def read_base(spark: SparkSession, base_path: str) -> DataFrame:
    """The whole base, which must exist."""
    base = find_base(spark, base_path)
    if base is None:
        raise FileNotFoundError(base_path)
    return base


def read_source(
    spark: SparkSession, base_path: str, first_load_path: str, file_format: str = "csv", multi_line: bool = True
) -> DataFrame:
    """The permanent base if there is one, otherwise the first load."""
    base = find_base(spark, base_path)
    if base is not None:
        return align_raw(base.drop(BATCH_COLUMN))
    return read_leads(spark, first_load_path, file_format, multi_line)


def with_first_load(base: DataFrame, first_load: DataFrame) -> DataFrame:
    """Base and first load together, for a run that starts from both."""
    return append_columns(base, first_load)


def no_confirmations(spark: SparkSession) -> DataFrame:
    """The confirmations table as it is every morning: empty, with its schema."""
    return spark.createDataFrame([], CONFIRMATION_SCHEMA)
