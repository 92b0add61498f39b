"""Connected components of a table of links by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.session import cut_lineage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(links: DataFrame) -> DataFrame:
    """Links with ``least``: the smallest of ``a`` and its neighbours.  Nodes are joined, never gathered."""
    least = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("smallest"))
    return links.join(least, F.col("a") == F.col("node")).select("a", "b", F.least("a", "smallest").alias("least"))


def _links(a: Column, b: Column) -> list[Column]:
    return [a.alias("a"), b.alias("b")]


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for every node of ``links`` (a, b).

    Every round hangs larger neighbours on the smallest (large star), then smaller ones
    on the smallest of them (small star); rounds grow with the logarithm of a chain.
    """
    own = cut_lineage(links.filter(F.col("a") != F.col("b")).select(*_links(F.greatest("a", "b"), F.least("a", "b"))).distinct())
    before = None
    while True:
        large = _with_least(_both_ways(own)).filter(F.col("b") > F.col("a")).select(*_links(F.col("b"), F.col("least"))).distinct()
        down = _with_least(large)
        small = (
            down.select(*_links(F.col("b"), F.col("least")))
            .union(down.select(*_links(F.col("a"), F.col("least"))))
            .filter(F.col("a") != F.col("b"))
            .distinct()
        )
        own = cut_lineage(small)
        state = own.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if state == before:
            break
        before = state
    roots = own.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return own.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
