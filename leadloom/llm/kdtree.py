"""K-d tree sharding with exact distributed weighted medians.

Rows live in a space of integer metadata dimensions.  A node of the tree that still holds
several shards is split in two on its widest dimension (relative to the range of that
dimension over all rows) at the weighted quantile that gives each side its number of
shards; weights are bytes.  The quantile is exact: every pass adds up bytes by node and by
one of ``BINS`` equal ranges of the values that are left, a window over those sums picks
the range that holds the quantile, and the next pass looks only inside it.  Rows that tie
on the value are split the same way by their id.  Passes read a narrow table of numbers,
written anew for each level of the tree, so plans do not grow with its depth;
what moves is one sum per node, range and task, and what reaches the driver is one row per
node.  Only DataFrame functions are used.

Defined results: a null text has no bytes, every row weighs its bytes plus 1; null
dimensions are -1, as is a null id; rows with equal values and equal ids stay together, so
repeated rows are never split; an empty table gives an empty table; other columns play no
part.  Sides differ from their share by at most half the row (or repeated rows) at the cut.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.session import cut_lineage

BINS = 4096
#: Rows that one task numbers at a time, about.
SLOT_ROWS = 20_000
_RANGE = 1 << 62


@dataclass
class Node:
    """A node that holds the shards ``first`` to ``first + count - 1``."""

    first: int
    count: int


@dataclass
class Search:
    """The quantile lies in ``[low, high]`` and has ``before`` bytes below ``low``; ``target`` is its share."""

    node: int
    low: int
    high: int
    before: int
    target: int

    @property
    def width(self) -> int:
        return (self.high - self.low) // BINS + 1


def document_dimensions() -> dict[str, Column]:
    """Source and language by hash, length and id."""
    return {
        "source": F.crc32(F.col("source").cast("string").cast("binary")),
        "lang": F.crc32(F.col("lang").cast("string").cast("binary")),
        "n_chars": F.col("n_chars").cast("bigint"),
        "doc_id": F.col("doc_id").cast("bigint"),
    }


def _as_rows(df: DataFrame, rows: list[tuple[int, ...]], names: list[str]) -> DataFrame:
    """A small table of whole numbers, at most one row per shard, in one literal of the plan."""
    values = F.from_json(F.lit(json.dumps([dict(zip(names, r, strict=True)) for r in rows])), f"array<struct<{', '.join(f'{n}: bigint' for n in names)}>>")
    return df.sparkSession.range(1).select(F.inline(values))


def _narrow(docs: DataFrame, dimensions: Mapping[str, Column]) -> DataFrame:
    text = F.col("text").cast("string")
    axes = [F.coalesce(F.pmod(c, F.lit(_RANGE)), F.lit(-1)).cast("bigint").alias(f"axis_{i}") for i, c in enumerate(dimensions.values())]
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("bigint").alias("text_crc32"),
        F.coalesce(F.pmod(F.col("doc_id").cast("bigint"), F.lit(_RANGE)), F.lit(-1)).cast("bigint").alias("tie"),
        *axes,
        F.lit(0).cast("bigint").alias("node"),
    )


def _quantiles(rows: DataFrame, value: Column, searches: list[Search]) -> dict[int, tuple[int, int]]:
    """For each node the smallest ``value`` at which its bytes reach the target, and the bytes below that value."""
    found: dict[int, tuple[int, int]] = {}
    while searches:
        names = ["at_node", "low", "high", "width", "before", "target"]
        table = _as_rows(rows, [(s.node, s.low, s.high, s.width, s.before, s.target) for s in searches], names)
        inside = (
            rows.withColumn("value", value)
            .join(F.broadcast(table), (F.col("node") == F.col("at_node")) & F.col("value").between(F.col("low"), F.col("high")))
            .groupBy("node", "low", "width", "before", "target", F.expr("(value - low) div width").alias("bin"))
            .agg(F.sum("size").alias("bytes"))
        )
        # One row per range and node: at most BINS rows of a node meet here.
        so_far = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hit = (
            inside.withColumn("reached", F.col("before") + F.sum("bytes").over(so_far))
            .filter((F.col("reached") >= F.col("target")) & (F.col("reached") - F.col("bytes") < F.col("target")))
            .select("node", (F.col("low") + F.col("bin") * F.col("width")).alias("from"), (F.col("reached") - F.col("bytes")).alias("below"))
        )
        by_node = {s.node: s for s in searches}
        searches = []
        for row in hit.collect():  # one row per node
            own = by_node[row["node"]]
            if own.width == 1:
                found[own.node] = (row["from"], row["below"])
            else:
                high = min(row["from"] + own.width - 1, own.high)
                searches.append(Search(own.node, row["from"], high, row["below"], own.target))
    return found


def _value(axes: int) -> Column:
    """A row's value in the dimension ``axis``."""
    return F.element_at(F.array(*[F.col(f"axis_{i}") for i in range(axes)]), (F.col("axis") + 1).cast("int"))


def _split(rows: DataFrame, nodes: dict[int, Node], axes: int, whole: list[tuple[int, int]]) -> tuple[DataFrame, dict[int, Node]]:
    """Split every node that holds several shards."""
    stats = rows.groupBy("node").agg(
        F.sum("size").alias("bytes"),
        F.min("tie").alias("tie_low"),
        F.max("tie").alias("tie_high"),
        *[f(f"axis_{i}").alias(f"{name}_{i}") for i in range(axes) for name, f in (("low", F.min), ("high", F.max))],
    )
    axis_of: dict[int, int] = {}
    searches, ties = [], {}
    for row in stats.collect():  # one row per node
        own = nodes[row["node"]]
        if own.count > 1:
            widths = [(row[f"high_{i}"] - row[f"low_{i}"]) / max(1, whole[i][1] - whole[i][0]) for i in range(axes)]
            axis = axis_of[row["node"]] = max(range(axes), key=lambda i: (widths[i], -i))
            target = -(-row["bytes"] * (own.count // 2) // own.count)
            searches.append(Search(row["node"], row[f"low_{axis}"], row[f"high_{axis}"], 0, target))
            ties[row["node"]] = (row["tie_low"], row["tie_high"], target)
    if not searches:
        return rows, {}
    chosen = _as_rows(rows, list(axis_of.items()), ["of_node", "axis"])
    by_axis = rows.join(F.broadcast(chosen), F.col("node") == F.col("of_node")).select("node", "size", "tie", _value(axes).alias("at"))
    cuts = _quantiles(by_axis, F.col("at"), searches)
    equal = by_axis.join(
        F.broadcast(_as_rows(rows, [(n, v) for n, (v, _) in cuts.items()], ["cut_node", "cut"])),
        (F.col("node") == F.col("cut_node")) & (F.col("at") == F.col("cut")),
    )
    tied = _quantiles(
        equal, F.col("tie"), [Search(n, ties[n][0], ties[n][1], below, ties[n][2]) for n, (_, below) in cuts.items()]
    )
    at_cut = equal.join(
        F.broadcast(_as_rows(rows, [(n, t) for n, (t, _) in tied.items()], ["tie_node", "tie_cut"])),
        (F.col("node") == F.col("tie_node")) & (F.col("tie") == F.col("tie_cut")),
    )
    weight = {r["node"]: r["bytes"] for r in at_cut.groupBy("node").agg(F.sum("size").alias("bytes")).collect()}
    split, children = [], {}
    for n, (tie, below) in tied.items():
        own = nodes[n]
        goes_left = 2 * (ties[n][2] - below) >= weight[n]
        left, right = 2 * n + 1, 2 * n + 2
        split.append((n, axis_of[n], cuts[n][0], tie if goes_left else tie - 1, left, right))
        children[left] = Node(own.first, own.count // 2)
        children[right] = Node(own.first + own.count // 2, own.count - own.count // 2)
    table = _as_rows(rows, split, ["at_node", "axis", "cut", "last_tie", "left", "right"])
    is_left = (_value(axes) < F.col("cut")) | ((_value(axes) == F.col("cut")) & (F.col("tie") <= F.col("last_tie")))
    moved = rows.join(F.broadcast(table), F.col("node") == F.col("at_node"), "left").withColumn(
        "node", F.when(F.col("at_node").isNull(), F.col("node")).when(is_left, F.col("left")).otherwise(F.col("right"))
    )
    return cut_lineage(moved.select(*rows.columns)), children


def shard(
    docs: DataFrame,
    dimensions: Mapping[str, Column] | None = None,
    shards: int | None = None,
    target_bytes: int | None = None,
) -> DataFrame:
    """Put every row into a shard: doc_id, size, text_crc32, shard, slot.

    Give either the number of shards or the bytes that a leaf should have.  ``slot``
    counts the rows of a shard from 0 without gaps.
    """
    dimensions = dict(dimensions or document_dimensions())
    axes = len(dimensions)
    rows = cut_lineage(_narrow(docs, dimensions))
    whole = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        *[F.coalesce(f(f"axis_{i}"), F.lit(0)).alias(f"{name}_{i}") for i in range(axes) for name, f in (("low", F.min), ("high", F.max))],
    ).first()
    if shards is None:
        shards = max(1, -(-whole["bytes"] // (target_bytes or 1 << 30)))
    ranges = [(whole[f"low_{i}"], whole[f"high_{i}"]) for i in range(axes)]
    nodes = {0: Node(0, shards)}
    leaves: dict[int, int] = {0: 0} if shards == 1 else {}
    while any(n.count > 1 for n in nodes.values()):
        rows, nodes = _split(rows, nodes, axes, ranges)
        leaves |= {n: own.first for n, own in nodes.items() if own.count == 1}
    if not leaves:  # no rows
        leaves = {0: 0}
    named = rows.join(F.broadcast(_as_rows(rows, list(leaves.items()), ["leaf", "shard_of"])), F.col("node") == F.col("leaf"))
    named = named.select("doc_id", "size", "text_crc32", "tie", F.col("shard_of").cast("int").alias("shard"))
    blocks = named.groupBy(F.col("shard").alias("of_shard")).agg(F.greatest(F.lit(1), F.expr(f"count(*) div {SLOT_ROWS}")).alias("blocks"))
    placed = named.join(F.broadcast(blocks), F.col("shard") == F.col("of_shard")).select(  # one row per shard
        "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("tie", "text_crc32", "size"), "blocks").alias("block")
    )
    # One row per shard and block: the shards, and the rows divided by SLOT_ROWS.
    earlier = Window.partitionBy("in_shard").orderBy("in_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(F.col("shard").alias("in_shard"), F.col("block").alias("in_block"))
        .agg(F.count(F.lit(1)).alias("held"))
        .select("in_shard", "in_block", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    )
    inner = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("within", F.row_number().over(inner))
        .join(starts, (F.col("shard") == F.col("in_shard")) & (F.col("block") == F.col("in_block")))
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("within") - 1).cast("bigint").alias("slot"))
    )
