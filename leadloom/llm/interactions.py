"""Filter interaction audit by difference arrays over Lehmer ranks.

Filters are applied in some order, and each takes out what is left and fails it.  Which
step removes a document depends only on its *mask*, the set of filters it fails: the first
filter of the order that is in the mask.  Orders are numbered lexicographically by their
Lehmer code, so all orders that begin alike are neighbours.  A mask is removed in step s by
the orders that begin with s - 1 filters outside the mask and one inside, that is on some
intervals of ranks.  The number of documents with the mask is added where an interval begins
and taken away behind its end; the prefix sum over the ranks then holds what every order
removes in that step, without looking at one order after the other.

Documents are counted by part and mask first (at most 2 ** filters rows for each part), in
aggregations that combine before they shuffle: rows with equal texts become one row for
each part and mark, so a text held by a third of all rows is never gathered.  Only ids,
digests and counts are shuffled, texts never.

Defined results: a null text counts as empty; a null part is the empty string; a document
without an id has no smaller id, so it repeats nothing, nor does anything repeat it; rows
with the same id and text do not repeat each other; of several marks of one id the largest
counts; an empty table gives an empty table; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEPARATORS = r"[\x20\x09-\x0D]+"
#: Orders are listed one by one, and they grow with the factorial.
MOST_FILTERS = 7


def short(words: Column, least: int) -> Column:
    """Fewer than ``least`` words."""
    return F.size(words) < least


def repetitive(words: Column, percent: int) -> Column:
    """Distinct words are less than ``percent`` of all words."""
    return 100 * F.size(F.array_distinct(words)).cast("bigint") < percent * F.size(words).cast("bigint")


def shouting(text: Column, percent: int) -> Column:
    """Capitals A-Z are more than ``percent`` of the characters."""
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return 100 * capitals.cast("bigint") > percent * F.length(text).cast("bigint")


def holds(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


#: Filters that look at one text, by letter; each takes the text and its words.
TEXT_FILTERS = {
    "A": lambda text, words: short(words, 100),
    "B": lambda text, words: repetitive(words, 80),
    "C": lambda text, words: shouting(text, 10),
    "D": lambda text, words: holds(text, r"[#$%&*|]"),
}
#: The filter that looks at all texts.
REPEATED = "E"


def _mask(conditions: Sequence[Column]) -> Column:
    """Bit i says that condition i holds."""
    total = F.lit(0)
    for i, condition in enumerate(conditions):
        total = total + F.when(condition, 1 << i).otherwise(0)
    return total


def mask_counts(
    docs: DataFrame,
    labels: DataFrame,
    marks: Mapping[str, Column],
    filters: Mapping[str, object] = TEXT_FILTERS,
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """part, mask, n, and the number of documents with each mark.

    Bits of the mask follow ``filters``; the bit behind them says that a smaller id has the
    same text.  ``marks`` are conditions on ``labels``, which has ``key``.
    """
    rows = (
        docs.select(F.col(key).alias("id"), F.coalesce(part, F.lit("")).alias("part"), F.coalesce(text, F.lit("")).alias("text"))
        .withColumn("words", F.array_remove(F.split("text", SEPARATORS), ""))
        .select(
            "id",
            "part",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            _mask([condition(F.col("text"), F.col("words")) for condition in filters.values()]).alias("mask"),
        )
    )
    known = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("of"))
    known = known.agg(*[F.max(F.coalesce(mark, F.lit(False))).alias(f"is_{name}") for name, mark in marks.items()])
    same = ["digest", "part", "mask", *[f"is_{name}" for name in marks]]
    ids = rows.join(known, F.col("id") == F.col("of"), "left").groupBy("id", *same).agg(F.count(F.lit(1)).alias("n"))
    known_id = F.col("id").isNotNull()
    texts = ids.groupBy(*same).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(known_id, 0).otherwise(F.col("n"))).alias("n_nameless"),
        F.min(F.when(known_id, F.struct("id", "n"))).alias("first"),
    )
    # One row for each part, mark and text here, however many copies there are.
    least = F.min("first.id").over(Window.partitionBy("digest"))
    original = F.col("n_nameless") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    bit = 1 << len(filters)
    split = F.array(
        F.struct(F.col("mask"), original.alias("n")),
        F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - original).alias("n")),
    )
    return (
        texts.withColumn("least", least)
        .select("part", *[f"is_{name}" for name in marks], F.inline(split))
        .filter(F.col("n") > 0)
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(f"is_{name}"), F.col("n")).otherwise(0)).alias(name) for name in marks])
    )


def lehmer_rank(beginning: Sequence[int], size: int) -> int:
    """Rank of the first order of ``size`` filters that begins so."""
    rank, left = 0, list(range(size))
    for chosen in beginning:
        place = left.index(chosen)
        rank += place * factorial(len(left) - 1)
        del left[place]
    return rank


def intervals(size: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank behind the last) for every mask and step."""
    out = []
    for step in range(1, size + 1):
        for beginning in permutations(range(size), step):
            first = lehmer_rank(beginning, size)
            free = [i for i in range(size) if i not in beginning]
            for chosen in range(1 << len(free)):
                mask = 1 << beginning[-1]
                mask |= sum(1 << f for k, f in enumerate(free) if chosen >> k & 1)
                out.append((mask, step, first, first + factorial(size - step)))
    return out


def audit(counts: DataFrame, names: str, marks: Sequence[str]) -> DataFrame:
    """What every order of the filters removes in every step.

    ``counts`` is from ``mask_counts``; bit i of a mask is the filter ``names[i]``.  Columns:
    part, filter_order, step, filter, kept, removed, redundant, unique_fails, shapley and
    ``<mark>_lost`` for each mark.
    """
    size = len(names)
    if size > MOST_FILTERS:
        raise ValueError(f"{size} filters have too many orders to list")
    sums = ["n", *marks]
    spark = counts.sparkSession
    # Fixed by the number of filters: 840 rows for five.
    spans = spark.createDataFrame(intervals(size), "mask int, step int, first int, behind int")
    ends = F.array(
        F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("behind").alias("rank"), F.lit(-1).alias("sign"))
    )
    changes = (
        counts.join(F.broadcast(spans), "mask")
        .select("part", "step", *sums, F.inline(ends))
        .filter(F.col("rank") < factorial(size))
        .groupBy("part", "step", "rank")
        .agg(*[F.sum(F.col(c) * F.col("sign")).alias(f"d_{c}") for c in sums])
    )
    failing = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) > 0, F.col("n")).otherwise(0)) for i in range(size)]
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(size)]
    orders = F.array(*[F.lit("".join(order)) for order in permutations(names)])
    grid = (
        counts.groupBy("part")
        .agg(F.sum("n").alias("total"), F.array(*failing).alias("failing"), F.array(*alone).alias("alone"))
        .withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(size) - 1))))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(size))))
        .withColumn("filter_order", F.element_at(orders, F.col("rank") + 1))
        .withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
        .withColumn("place", F.instr(F.lit(names), F.col("filter")))
    )
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        grid.join(changes, ["part", "step", "rank"], "left")
        .withColumns({f"gone_{c}": F.sum(F.coalesce(f"d_{c}", F.lit(0))).over(along) for c in sums})
        .select(
            "part",
            "filter_order",
            "step",
            "filter",
            (F.col("total") - F.sum("gone_n").over(so_far)).alias("kept"),
            F.col("gone_n").alias("removed"),
            (F.element_at("failing", F.col("place")) - F.col("gone_n")).alias("redundant"),
            F.element_at("alone", F.col("place")).alias("unique_fails"),
            *[F.col(f"gone_{c}").alias(f"{c}_lost") for c in marks],
            F.sum("gone_n").over(Window.partitionBy("part", "filter")).alias("shapley"),
        )
    )


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN l USING (doc_id)
), m AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM f GROUP BY ALL
), x(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
), s AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS before,
    n, n_good, n_toxic, contains(fails, filter) AS failing, translate(fails, before, '') <> fails AS gone, fails = filter AS alone
  FROM m CROSS JOIN o CROSS JOIN (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)
), r AS (
  SELECT part, filter_order, step, filter,
    coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0) AS kept,
    coalesce(sum(n) FILTER (failing AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (failing AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
    coalesce(sum(n_good) FILTER (failing AND NOT gone), 0) AS good_lost,
    coalesce(sum(n_toxic) FILTER (failing AND NOT gone), 0) AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r
"""
