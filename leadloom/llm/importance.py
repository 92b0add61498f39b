"""Target-distribution importance resampling with array-scored weights and exact ranks.

A document's features are its runs of up to ``longest`` words, hashed to ``buckets``.  The
gain of a bucket is the scaled log ratio of its smoothed share in the target texts and in
the documents; one array of gains scores every document.  Adding Gumbel noise made from the
id and taking the highest scores draws without replacement in proportion to the exponential
of the weight.

Ranks come from parallel sorting by regular sampling (Shi, Schaeffer, 1992): every task
sorts its documents and writes them as a run; samples at regular places of all runs give
splitters; rows are dealt to the segments between splitters; each segment is merged by one
task; prefix sums of the segments' sizes make places in a segment exact ranks.  Where a row
stands in its run settles ties of repeated rows, so even one row repeated without end spreads
over segments.  Segments behind the last drawn rank are counted, not exchanged.

What is gathered is bounded by parameters: ``buckets`` counts and gains, about
``SAMPLES`` samples a segment and one size a segment.

Defined results: words are lower-cased in A-Z only and are runs of letters, digits and
characters beyond ASCII; a null or empty text has no feature, weight 0 and a score; a null id
is hashed as an empty text and stands behind ids that tie with it; repeated rows are documents
of their own and take neighbouring ranks; without target texts all targets count 0; an empty
table gives an empty table; other columns play no part.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.common import column_or, in_batches
from leadloom.session import cut_lineage

BUCKETS = 10_000
#: Samples a segment: its size differs from the mean by about one part in so many.
SAMPLES = 32
#: Bytes of a text whose words are objects at the same time.
STRETCH = 1 << 20
# Of the UTF-8 bytes of a text lower-cased in A-Z: digits, a-z and whatever is not ASCII.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


class Buckets(dict):
    """Bucket of each feature; forgets all when there are many."""

    LIMIT = 200_000

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, some at a time."""
    data = text.encode("utf-8", "surrogatepass").lower()
    start = 0
    while start < len(data):
        gap = _GAP.search(data, start + STRETCH)
        end = gap.start() if gap else len(data)
        yield _WORDS.findall(data, start, end)
        start = end


def features_of(text: str, longest: int, known: Buckets) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them), some at a time."""
    before: list[bytes] = []
    for words in words_of(text):
        found = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        if longest > 1:
            row, more = before + words, [found]
            for size in range(2, longest + 1):
                ends = range(max(len(before), size - 1), len(row))
                more.append(np.fromiter((known[b" ".join(row[e - size + 1 : e + 1])] for e in ends), np.int64, len(ends)))
            before = row[-(longest - 1) :]
            found = np.concatenate(more)
        yield len(words), found


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = 1) -> DataFrame:
    """bucket and n: how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = Buckets(buckets), np.zeros(buckets, np.int64)
        waiting, held = [], 0
        for batch in in_batches(batches, 500):
            for x in column_or(batch, text):
                for _, found in features_of(x, longest, known):
                    waiting.append(found)
                    held += len(found)
                    if held > STRETCH:
                        counts += np.bincount(np.concatenate(waiting), minlength=buckets)
                        waiting, held = [], 0
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=buckets)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["bucket", "n"])

    return texts.select(text).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", buckets: int = BUCKETS, longest: int = 1) -> list[int]:
    """The gain of every bucket: 1,000 times the log ratio of the smoothed shares, rounded down."""
    def dense(table: DataFrame, column: str) -> list[int]:
        found = {r.bucket: r.n for r in bucket_counts(table, column, buckets, longest).collect()}  # ``buckets`` rows at most
        return [found.get(b, 0) for b in range(buckets)]

    s, t = dense(docs, text), dense(target, target_text)
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return [floor(1000 * log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)]


def weigh(docs: DataFrame, gain: list[int], key: str = "doc_id", text: str = "text", longest: int = 1) -> DataFrame:
    """id, n_words, n_features and weight of every document."""
    worth = np.array(gain, np.int64)
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [T.StructField("id", kind)] + [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(len(worth))
        for batch in in_batches(batches, 500):
            rows = np.zeros((3, batch.num_rows), np.int64)
            for i, x in enumerate(column_or(batch, text)):
                for n_words, found in features_of(x, longest, known):
                    rows[:, i] += n_words, len(found), worth[found].sum()
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows)], names=schema.fieldNames())

    return docs.select(F.col(key).alias("id"), text).mapInArrow(run, schema)


def noise(key: Column, seed: int) -> Column:
    """1,000 times Gumbel noise from the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-1000 * F.log(-F.log(uniform)))


def _order(score: int, key: object, run: int, place: int) -> tuple:
    return (-score, key is None, 0 if key is None else key, run, place)


def sorted_runs(rows: DataFrame, eligible: Column) -> DataFrame:
    """The rows as each task sorted them, with ``eligible``, ``run`` and ``place`` in the run."""
    at = F.monotonically_increasing_id()
    return cut_lineage(
        rows.withColumn("eligible", eligible)
        .sortWithinPartitions(F.col("eligible").desc(), F.col("score").desc(), F.col("id").asc_nulls_last())
        .withColumn("_at", at)
        .withColumns({"run": F.shiftright("_at", 33), "place": F.col("_at").bitwiseAND((1 << 33) - 1)})
        .drop("_at")
    )


def splitters(runs: DataFrame, total: int, segments: int) -> list[tuple]:
    """Ends of all segments but the last, from samples at regular places of the runs.

    A run begins its steps at a place of its own, so that runs shorter than a step count too.
    """
    step = max(1, total // (segments * SAMPLES))
    sampled = F.pmod(F.col("place") + F.pmod(F.xxhash64("run"), F.lit(step)), F.lit(step)) == 0
    found = sorted(_order(*r) for r in runs.filter(F.col("eligible") & sampled).select("score", "id", "run", "place").collect())
    return [found[i * len(found) // segments] for i in range(1, segments)] if found else []


def with_segment(runs: DataFrame, ends: list[tuple]) -> DataFrame:
    """The eligible rows and the number of the segment each belongs to."""
    rows = runs.filter("eligible").drop("eligible")
    schema = T.StructType([*rows.schema.fields, T.StructField("segment", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("score", "id", "run", "place"))
            found = [bisect_left(ends, _order(*row)) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    seed: int = 2024,
    least_words: int = 20,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    longest: int = 1,
    segments: int | None = None,
) -> DataFrame:
    """``key``, n_features, weight, score and rank of every document; documents not drawn have no rank.

    Of N documents with ``least_words`` words or more, floor(``percent`` * N / 100) are drawn.
    """
    segments = segments or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weighed = weigh(docs, gains(docs, target, text, target_text, buckets, longest), key, text, longest)
    runs = sorted_runs(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), F.col("n_words") >= least_words)
    total = runs.filter("eligible").count()
    drawn = percent * total // 100
    dealt = cut_lineage(with_segment(runs, splitters(runs, total, segments)))
    # One row for each segment.
    before = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("segment").agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.select("segment", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    placed = dealt.join(F.broadcast(starts), "segment")
    merged = Window.partitionBy("segment").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "run", "place")
    rank = F.col("start") + F.row_number().over(merged)
    columns = [F.col("id").alias(key), "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    return (
        placed.filter(F.col("start") < drawn)
        .withColumn("rank", rank)
        .select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
        .unionAll(placed.filter(F.col("start") >= drawn).select(*columns, none))
        .unionAll(runs.filter(~F.col("eligible")).select(*columns, none))
    )


def drawn_documents(docs: DataFrame, ranked: DataFrame, key: str = "doc_id") -> DataFrame:
    """The drawn documents with their texts; rows that repeat an id are drawn if one of them is."""
    return docs.join(ranked.filter(F.col("rank").isNotNull()).select(key), key, "left_semi")


ORACLE = r"""
WITH RECURSIVE k AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab
), d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), t AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), dw AS (SELECT row, unnest(words) AS word FROM d),
tw AS (SELECT unnest(words) AS word FROM t),
w AS (SELECT DISTINCT word FROM (SELECT word FROM dw UNION ALL SELECT word FROM tw)),
b AS (
  SELECT word, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(strlen(word)), lambda i:
      16 * (strpos('0123456789ABCDEF', substr(hex(word), CAST(2 * i + 1 AS BIGINT), 1)) - 1)
      + strpos('0123456789ABCDEF', substr(hex(word), CAST(2 * i + 2 AS BIGINT), 1)) - 1)),
    lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1]))) % 10000 AS bucket
  FROM w CROSS JOIN k
), s AS (SELECT bucket, count(*) AS n FROM dw JOIN b USING (word) GROUP BY bucket),
g AS (SELECT bucket, count(*) AS n FROM tw JOIN b USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(g.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000) AS DOUBLE)
    / CAST((s.n + 1) * ((SELECT coalesce(sum(n), 0) FROM g) + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN g USING (bucket)
), v AS (
  SELECT row, count(*) AS n_features, sum(gain) AS weight FROM dw JOIN b USING (word) JOIN gain USING (bucket) GROUP BY row
), u AS (
  SELECT d.doc_id, len(words) >= 20 AS eligible, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN v USING (row)
), z AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM u
), r AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS LAST) AS place,
    count(*) OVER (PARTITION BY eligible) AS total FROM z
)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= 10 * total // 100 THEN place END AS rank FROM r
"""
