"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of any length, in words of 64 bits, is cut into segments of 16 bits, and every segment has
an index from its value to codes.  A search looks up the values at distance 0 from its own in all segments, then
those at distance 1, and so on.  Once all values up to radius r were looked up, every code
within ``segments * (r + 1) - 1`` bits has been met and its distance verified, so the search
of a query ends as soon as its k-th verified distance is covered.  A code met before is not
verified again.

Codes are searched in blocks: distinct codes are dealt to blocks by hash, queries to groups,
and each pair of block and group is one task with an index of its own.  The
best of all blocks are merged by a window that keeps k rows per task before it shuffles.
Equal codes are one code with its k smallest ids, which is all a result can use.

Defined results: rows without an id or vector are neither queries nor answers; a query
meets itself if it is in the table; ties go to smaller ids; a repeated id counts once for
each code it has; codes of different lengths are compared as if zeros followed the shorter one;
fewer than k rows give fewer answers; an empty table gives an empty table;
other columns play no part.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from leadloom.session import cut_lineage

WORD_BITS = 64
SEGMENT_BITS = 16
#: Distinct codes of a block, and queries of a group, about.
BLOCK_CODES = 262_144
GROUP_QUERIES = 32_768
#: Groups are made smaller than that, down to this, while cores would have no work.
LEAST_QUERIES = 256


def sign_code(vector: Column) -> Column:
    """Words of 64 bits: bit i of the code says whether element i is above zero; no value (null) is not."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def word(number: Column) -> Column:
        part = F.slice(vector, number * WORD_BITS + 1, F.lit(WORD_BITS))
        bits = F.transform(part, lambda x, i: F.when(x > 0, F.call_function("shiftleft", one, i)).otherwise(none))
        return F.aggregate(bits, none, lambda a, b: a.bitwiseOR(b))

    last = F.floor((F.size(vector) - 1) / WORD_BITS).cast("int")
    return F.when(F.size(vector) > 0, F.transform(F.sequence(F.lit(0), last), word)).when(F.size(vector) == 0, F.array(none))


def _words(df: DataFrame, name: str) -> Column:
    """A code as an array of words without zeros at its end; a plain number is one word."""
    code = F.col(name) if isinstance(df.schema[name].dataType, ArrayType) else F.when(F.col(name).isNotNull(), F.array(name))
    code = F.transform(code, lambda x: F.coalesce(x.cast("bigint"), F.lit(0).cast("bigint")))
    zeros = F.array_position(F.transform(F.reverse(code), lambda x: x != 0), True) - 1
    return F.when(zeros >= 0, F.slice(code, 1, (F.size(code) - zeros).cast("int"))).when(
        code.isNotNull(), F.array().cast("array<bigint>")
    )


def matrix(codes: pd.Series, width: int) -> np.ndarray:
    """One row of ``width`` words for each code."""
    sizes = np.array([len(c) for c in codes], np.int64)
    out = np.zeros((len(sizes), width), np.uint64)
    if sizes.sum():
        out[np.arange(width) < sizes[:, None]] = np.concatenate(codes.to_list()).astype(np.int64).view(np.uint64)
    return out


@lru_cache(maxsize=SEGMENT_BITS + 1)
def flips(radius: int) -> np.ndarray:
    """All segment values with ``radius`` bits set."""
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(SEGMENT_BITS), radius)], np.int64)


class Index:
    """For each segment, the codes in the order of its values and where each value starts."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        parts = segments(codes)
        self.order = [np.argsort(p, kind="stable").astype(np.int32) for p in parts.T]
        values = np.arange((1 << SEGMENT_BITS) + 1)
        self.starts = [np.searchsorted(p[o], values).astype(np.int32) for p, o in zip(parts.T, self.order, strict=True)]

    def met(self, own: np.ndarray, radius: int, seen: np.ndarray) -> np.ndarray:
        """Codes with a segment that is ``radius`` bits away, those that were ``seen`` left out and each once."""
        out = []
        for value, order, starts in zip(own, self.order, self.starts, strict=True):
            values = int(value) ^ flips(radius)
            begin, end = starts[values].astype(np.int64), starts[values + 1]
            counts = end - begin
            found = np.repeat(begin - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
            found = order[found]
            found = found[~seen[found]]  # one segment has one value, so nothing is found twice here
            seen[found] = True
            out.append(found)
        return np.concatenate(out)

    def nearest(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of all codes up to the distance of the k-th."""
        own = segments(query[None, :])[0]
        seen = np.zeros(len(self.codes), bool)
        places, distances = np.empty(0, np.int64), np.empty(0, np.int64)
        for radius in range(SEGMENT_BITS + 1):
            met = self.met(own, radius, seen)
            places = np.concatenate([places, met])
            distances = np.concatenate([distances, np.bitwise_count(self.codes[met] ^ query).sum(axis=1, dtype=np.int64)])
            if len(places) >= min(k, len(self.codes)):
                last = np.partition(distances, min(k, len(distances)) - 1)[min(k, len(distances)) - 1]
                if last <= len(own) * (radius + 1) - 1 or len(places) == len(self.codes):
                    near = distances <= last
                    return places[near], distances[near]
        return places, distances


def segments(codes: np.ndarray) -> np.ndarray:
    """The segments of each code, lowest bits first."""
    return np.ascontiguousarray(codes).astype("<u8").view("<u2")


def search(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` nearest rows of each query: query_id, neighbour_id, distance, rank.

    Both tables have ``id`` and ``code``: a number, or an array of 64-bit words, lowest first.
    """
    by_id = Window.partitionBy("code").orderBy("id")
    distinct = cut_lineage(
        rows.select("id", _words(rows, "code").alias("code"))
        .filter(F.col("id").isNotNull() & F.col("code").isNotNull())
        .distinct()
        .withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= k)  # equal codes: no more than k ids can be among k results
        .groupBy("code")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    asked = cut_lineage(
        queries.select(F.col("id").alias("query_id"), _words(queries, "code").alias("query"))
        .filter(F.col("query_id").isNotNull() & F.col("query").isNotNull())
        .distinct()
    )
    held = distinct.agg(F.count(F.lit(1)), F.max(F.size("code"))).first()
    wants = asked.agg(F.count(F.lit(1)), F.max(F.size("query"))).first()
    width = max(held[1] or 0, wants[1] or 0, 1)
    blocks = -(-held[0] // BLOCK_CODES) or 1
    cores = rows.sparkSession.sparkContext.defaultParallelism
    groups = max(-(-wants[0] // GROUP_QUERIES), min(-(-wants[0] // LEAST_QUERIES), -(-2 * cores // blocks)), 1)
    data = distinct.select(
        F.pmod(F.xxhash64("code"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        "code",
        "ids",
    )
    wanted = asked.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
        F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("group"),
        "query_id",
        "query",
    )

    def find(own: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(asks):
            return pd.DataFrame({"query_id": [], "neighbour_id": [], "distance": []}).astype("int64")
        index = Index(matrix(own["code"], width))
        ids = own["ids"].to_list()
        out = []
        for query_id, query in zip(asks["query_id"], matrix(asks["query"], width), strict=True):
            places, distances = index.nearest(query, k)
            found = sorted((int(d), int(i)) for p, d in zip(places, distances, strict=True) for i in ids[p])[:k]
            out += [(query_id, i, d) for d, i in found]
        return pd.DataFrame(out, columns=["query_id", "neighbour_id", "distance"]).astype("int64")

    found = data.groupBy("block", "group").cogroup(wanted.groupBy("block", "group")).applyInPandas(find, "query_id bigint, neighbour_id bigint, distance bigint")
    best = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return found.withColumn("rank", F.row_number().over(best).cast("bigint")).filter(F.col("rank") <= k)


ORACLE = """
WITH c AS (SELECT DISTINCT vec_id, [coalesce(x > 0, false) FOR x IN embedding] AS bits FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (
  SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id,
    CAST(list_sum([CASE WHEN coalesce(q.bits[i], false) <> coalesce(r.bits[i], false) THEN 1 ELSE 0 END
      FOR i IN range(1, greatest(len(q.bits), len(r.bits), 1) + 1)]) AS BIGINT) AS distance
  FROM c q CROSS JOIN c r WHERE q.vec_id % 100 = 0
), n AS (SELECT query_id, neighbour_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM d)
SELECT * FROM n WHERE rank <= 10
"""
