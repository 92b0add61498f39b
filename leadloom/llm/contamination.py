"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Items and documents are sets of distinct word shingles.  An item's signature is its bottom-k
MinHash sketch, the k smallest hashes of its shingles.  How long it must be follows from the
containment that is asked for and from the item's size: a document that holds ``needs`` of its n
shingles lacks n - needs at most, so of k = n - needs + 1 hashes it has one, however long the
document is.  A sketch as long as that misses nothing.

Items are partitioned by size, in powers of two, and by the width of their shingles.  Of each
partition two numbers steer the search: the fewest shingles a document needs to hold an item of
it, and the largest hash in its sketches.  A document probes the partitions that it is large
enough for, and of its own hashes only those up to the largest of these partitions; all others
are never shuffled.  Large items have sketches of about a quarter of their shingles, the
smallest quarter of the hashes, so long documents skip most of theirs.

Candidates are verified on the shingles themselves, and only their documents are read again.
Only DataFrame functions are used.  Spark joins the sketches by broadcast when the written
sketch table is below its broadcast threshold and by a shuffle beyond it.  The partitions'
numbers, one row for each power of two and width, are the only thing the driver sees.

Defined results: words are lower-cased and divided by space, tab and line ends; an item of
fewer than ``size`` words is one shingle of as many words, which longer documents hold where
they hold these words in a row; null and empty texts neither contain nor are contained;
repeated rows count once per id; the texts of a repeated id count together, those of a document
as one set, an item's as shingles of both; an empty table on either side gives an empty table;
rows without an id are no document or item; other columns play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from leadloom.llm.common import SHINGLE_WORDS
from leadloom.session import cut_lineage

THRESHOLD = 0.75


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text.cast("string")), r"[\x20\x09-\x0D]+"), "")


def _shingle_rows(words: DataFrame, width: int | None, size: int, bound: Column | None = None) -> DataFrame:
    """key, width, words and place of every shingle; without a ``width``, of the width that an item has.

    ``bound`` is computed once for each text and passes through.
    """
    own = F.least(F.size("words"), F.lit(size)) if width is None else F.lit(width)
    rows = words.withColumn("width", own).withColumn("n_places", F.size("words") - F.col("width") + 1)
    extra, there = [], (F.col("width") > 0) & (F.col("n_places") > 0)
    if bound is not None:
        rows, extra, there = rows.withColumn("bound", bound), ["bound"], F.col("bound").isNotNull()
    # A filter on the texts' words would divide every text a second time: texts without a shingle give a place without number.
    places = F.explode_outer(F.when(there, F.sequence(F.lit(0), F.col("n_places") - 1))).alias("place")
    return rows.select("key", "width", "words", *extra, places).filter(F.col("place").isNotNull())


def _words_of(table: DataFrame, key: str, text: str) -> DataFrame:
    return table.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), _words(F.col(text)).alias("words"))


def _at(width: int) -> list[Column]:
    """The words of a shingle of known width."""
    return [F.get("words", F.col("place") + k) for k in range(width)]


def _at_most(size: int) -> list[Column]:
    """The words of a shingle, none behind its width."""
    return [F.when(F.col("width") > k, word) for k, word in enumerate(_at(size))]


def item_shingles(items: DataFrame, key: str = "item_id", text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """item, width, shingle, code: the distinct shingles of each item."""
    return (
        _shingle_rows(_words_of(items, key, text), None, size)
        .select(F.col("key").alias("item"), "width", F.concat_ws(" ", *_at_most(size)).alias("shingle"), F.xxhash64(*_at_most(size)).alias("code"))
        .distinct()
    )


def needed(count: Column, threshold: float) -> Column:
    """Shingles that must be shared, out of ``count``; the threshold counts in whole hundredths."""
    return F.ceil(count * round(threshold * 100) / 100)


def sketches(shingles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """item, width, needs, size_class, code: the MinHash sketch of each item.

    ``needs`` is of shingles of that width; an id with texts of several widths may need one only.
    An item's shingles meet in one task; items are short.
    """
    by_hash = Window.partitionBy("item").orderBy("code", "shingle")
    whole = Window.partitionBy("item")
    return (
        shingles.withColumn("n_item", F.count(F.lit(1)).over(whole))
        .withColumn("one_width", F.min("width").over(whole) == F.max("width").over(whole))
        .withColumn("rank", F.row_number().over(by_hash))
        .withColumn("needs", needed(F.col("n_item"), threshold))
        .filter(F.col("rank") <= F.col("n_item") - F.col("needs") + 1)
        .withColumn("needs", F.when(F.col("one_width"), F.col("needs")).otherwise(1))
        .withColumn("size_class", F.floor(F.log2("n_item")).cast("int"))
        .select("item", "width", "needs", "size_class", "code")
    )


def partitions(index: DataFrame) -> list[Row]:
    """width, size_class, fewest and largest: what a document needs for a partition, and the largest hash in it."""
    grouped = index.groupBy("width", "size_class").agg(F.min("needs").alias("fewest"), F.max("code").alias("largest"))
    return grouped.orderBy("width", "size_class").collect()


def probes(words: DataFrame, parts: list[Row], size: int = SHINGLE_WORDS) -> DataFrame:
    """doc, n_places, width and code of the document hashes that can be in a sketch of a partition that fits."""
    found = None
    for width in sorted({p.width for p in parts}):
        # A width below ``size`` has items of one shingle only; others may share shingles of several widths' items.
        n_places = F.size("words") - width + 1
        largest = [F.when(n_places >= p.fewest, F.lit(p.largest)) for p in parts if p.width == width]
        bound = largest[0] if len(largest) == 1 else F.greatest(*largest)
        rows = (
            _shingle_rows(words, width, size, bound)
            .select(F.col("key").alias("doc"), "width", "bound", F.xxhash64(*_at(width)).alias("code"))
            .filter(F.col("code") <= F.col("bound"))
            .drop("bound")
        )
        found = rows if found is None else found.unionAll(rows)
    return found


def contained(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    size: int = SHINGLE_WORDS,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Pairs in which a document holds at least ``threshold`` of an item's shingles.

    Columns: doc_id, item_id, n_item (shingles of the item), n_shared, containment.
    """
    shingles = cut_lineage(item_shingles(items, item_key, item_text, size))
    index = cut_lineage(sketches(shingles, threshold).distinct())
    parts = partitions(index)
    words = _words_of(docs, key, text)
    if parts:
        hits = probes(words, parts, size).join(index.select("item", "width", "code"), ["width", "code"]).select("doc", "item").distinct()
    else:
        hits = words.select(F.col("key").alias("doc"), F.lit(None).cast(shingles.schema["item"].dataType).alias("item")).filter("false")
    candidates = cut_lineage(hits)
    # Verification: exact shingles of the documents that were hit.
    hit_docs = candidates.select(F.col("doc").alias("of_doc")).distinct()
    sizes = shingles.groupBy(F.col("item").alias("of")).agg(F.count(F.lit(1)).alias("n_item"))
    wanted = candidates.join(shingles.select("item", "width", "shingle"), "item")
    again = _words_of(docs.join(hit_docs, F.col(key) == F.col("of_doc"), "left_semi"), key, text)
    widths = sorted({p.width for p in parts}) or [size]
    texts = [
        _shingle_rows(again, width, size).select(F.col("key").alias("doc"), "width", F.concat_ws(" ", *_at(width)).alias("shingle"))
        for width in widths
    ]
    held = (
        reduce(DataFrame.unionAll, texts)
        .join(wanted, ["doc", "width", "shingle"])
        .distinct()
        .groupBy("doc", "item")
        .agg(F.count(F.lit(1)).alias("n_shared"))
    )
    return (
        held.join(sizes, F.col("item") == F.col("of"))
        .filter(F.col("n_shared") >= needed(F.col("n_item"), threshold))
        .select(
            F.col("doc").alias("doc_id"),
            F.col("item").alias("item_id"),
            "n_item",
            "n_shared",
            (F.col("n_shared") / F.col("n_item")).alias("containment"),
        )
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id AS k, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
), b AS (
  SELECT item_id AS k, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), bs AS (
  SELECT DISTINCT k, width, array_to_string(w[i:i + width - 1], ' ') AS s
  FROM (SELECT k, w, least(len(w), 5) AS width, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM b WHERE len(w) > 0)
), ds AS (
  SELECT DISTINCT k, width, array_to_string(w[i:i + width - 1], ' ') AS s
  FROM (SELECT k, w, width, unnest(generate_series(1, len(w) - width + 1)) AS i FROM d, (SELECT DISTINCT width FROM bs) WHERE len(w) >= width)
), n AS (SELECT k, count(*) AS n_item FROM bs GROUP BY k)
SELECT ds.k AS doc_id, bs.k AS item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM ds JOIN bs USING (width, s) JOIN n ON n.k = bs.k
GROUP BY ds.k, bs.k, n_item HAVING 100 * count(*) >= 75 * n_item
"""
