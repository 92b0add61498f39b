"""Duplicate removal on five identity keys, newest record first.

Rows are looked at from the newest to the oldest.  A row is kept unless it shares
a key with a row that was kept before it; dropped rows do not pass their keys on.
This is the lexicographically first maximal independent set of the "shares a key"
graph, found here by blocks (after Blelloch, Fineman, Shun, "Greedy Sequential Maximal
Independent Set and Matching are Parallel on Average", SPAA 2012).

* A row whose keys nobody else has is kept at once.  The rest is sorted and cut into blocks
  of about ``BLOCK_ROWS`` rows, however many blocks that makes.
* In every round each block is walked in order by one task.  What earlier blocks will do is
  not known yet, so a row's outcome is worked out as far as it goes: kept, dropped, or the
  same as (or the opposite of) the outcome of one other row.
* Rows that hang on another row are settled by pointer doubling: in each step a row takes over
  what the row it hangs on hangs on, and whether it is the opposite.  A chain over many blocks
  thus takes steps in the logarithm of the blocks.
* Rows that hang on several others wait for the next round, in which the rows still open are
  cut into blocks anew.  The first block of a round is settled in any case.
* A key is never gathered into one group: its first open row is a ``min`` (combined
  before the shuffle) and its rows meet the taken keys in a join with one row for each key.
* Only row id, order and keys take part; the wide rows are shuffled at most once and never sorted to collapse copies.
* Each round is written to the shared folder, so lost executors cost one step at most.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.functions.keys import identity_keys, kind_of, value_of
from leadloom.functions.logic import fill, first_match
from leadloom.session import cut_lineage, scratch_path

BLOCK_ROWS = 20_000

# Newest first, undated last, then by lead id; row_id makes the order total.
ORDER = ("touch_rank", "no_lead_id", "lead_id", "row_id")


def with_row_id(leads: DataFrame) -> DataFrame:
    """Add ``row_id``, a 128-bit digest of the whole row: equal rows get equal ids."""
    content = [
        F.coalesce(F.col(name).cast("string"), F.lit("\x00")) for name in sorted(leads.columns)
    ]
    return leads.withColumn("row_id", F.md5(F.concat_ws("\x1f", *content)))


def newest_first_rank(touch_date: str = "last_touch_date") -> Column:
    return F.coalesce(-F.unix_date(touch_date), F.lit(2**31 - 1)).cast("int")


def _order_struct() -> Column:
    return F.struct(*ORDER)


@dataclass
class Resolution:
    """Outcome of the duplicate search, one row per distinct keyed lead.

    ``rows`` has ``row_id``, the order columns, ``keys`` and ``copies`` (how many identical
    rows there were).  ``settled`` has the same and ``kept`` for those rows that share a key
    or have copies; all others are kept.  ``rounds`` is for diagnosis: block walks and steps
    of pointer doubling.
    """

    rows: DataFrame
    settled: DataFrame
    rounds: int

    @property
    def decided(self) -> DataFrame:
        free = self.rows.join(self.settled.select("row_id"), "row_id", "left_anti")
        return free.withColumn("kept", F.lit(True)).unionByName(self.settled)

    @property
    def dropped(self) -> DataFrame:
        return self.settled.where(~F.col("kept"))


def key_rows(leads: DataFrame) -> DataFrame:
    """Narrow table of the distinct rows and their keys."""
    return (
        leads.select(
            "row_id",
            newest_first_rank().alias("touch_rank"),
            F.col("lead_id").isNull().alias("no_lead_id"),
            "lead_id",
            identity_keys(clean=True).alias("keys"),
        )
        .groupBy(*ORDER, "keys")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def tangled_rows(rows: DataFrame) -> DataFrame:
    """Rows with copies or with keys that others have too; ``shared`` are those keys."""
    members = rows.select("row_id", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > 1)
    # A row has five keys at most.
    own = members.join(shared, "key", "left_semi").groupBy("row_id").agg(F.collect_list("key").alias("shared"))
    joined = rows.join(own, "row_id", "left").where(F.col("shared").isNotNull() | (F.col("copies") > 1))
    return joined.withColumn("shared", F.coalesce("shared", F.array().cast("array<string>")))


def _blocked(rows: DataFrame, order: Sequence[Column], blocks: int) -> DataFrame:
    """The rows with ``place``, which grows with the order, and ``block``, a run of places.

    Bounds of blocks come from a sample, which decides how large they are and nothing else.
    """
    sorted_rows = rows.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    placed = sorted_rows.withColumn("place", F.monotonically_increasing_id())
    return cut_lineage(placed.withColumn("block", F.least(F.shiftright("place", 33), F.lit(blocks - 1))))


# What is known of a key or row: taken or kept, free or dropped, unclear, or else 2 * place (+ 1):
# as the row at that place is kept (or is not).
_YES, _NO, _UNCLEAR = -1, -2, -3


def _walk(links: pd.DataFrame) -> pd.DataFrame:
    """Work out the rows of one block in order.

    ``links`` has a line per row and key.  ``before`` says which open row of an earlier block
    has the key: none, one (its place) or several (a negative number).
    """
    links = links.sort_values("place", kind="stable")
    known: dict[str, int] = {}
    places, verdicts, targets, odds = [], [], [], []
    lines = zip(links["place"].tolist(), links["key"].tolist(), links["before"].tolist(), strict=True)
    for place, group in groupby(lines, itemgetter(0)):
        states = {key: known.get(key, _NO if before is None or before != before else 2 * int(before) if before >= 0 else _UNCLEAR) for _, key, before in group}
        others = {s for s in states.values() if s >= 0}
        if _YES in states.values() or any(s ^ 1 in others for s in others):
            outcome = _NO
        elif _UNCLEAR in states.values() or len(others) > 1:
            outcome = 2 * place
        else:
            outcome = others.pop() ^ 1 if others else _YES
        for key, state in states.items():
            if outcome == _YES or (outcome >= 0 and state == outcome ^ 1):
                known[key] = _YES
            elif outcome == _NO or state in (_YES, outcome):
                known[key] = state
            else:
                known[key] = outcome if state == _NO else _UNCLEAR
        places.append(place)
        verdicts.append(None if outcome >= 0 else outcome == _YES)
        targets.append(outcome >> 1 if outcome >= 0 else place)
        odds.append(outcome >= 0 and outcome & 1 == 1)
    return pd.DataFrame(
        {"place": places, "verdict": pd.array(verdicts, dtype="boolean"), "target": places if not targets else targets, "odd": odds}
    ).astype({"place": "int64", "target": "int64", "odd": "bool"})


def _spans(members: DataFrame) -> DataFrame:
    """First and last open block of each key that open rows of several blocks have, its first row, and how many it has."""
    blocks = members.groupBy(F.col("key").alias("of")).agg(
        F.min("block").alias("first"), F.max("block").alias("last"), F.min("place").alias("owner"), F.count(F.lit(1)).alias("held")
    )
    return blocks.where(F.col("first") < F.col("last"))


def _hangs() -> Column:
    return F.col("verdict").isNull() & (F.col("target") != F.col("place"))


def _taken_over(rows: DataFrame, of: DataFrame) -> DataFrame:
    """Rows that hang on one of ``of`` take over what that is; ``again`` if that hangs on another one itself."""
    found = of.select(F.col("place").alias("at"), F.col("verdict").alias("its"), F.col("target").alias("next"), F.col("odd").alias("turned"))
    joined = rows.join(found, _hangs() & (F.col("target") == F.col("at")), "left")
    return joined.select(
        "place",
        F.coalesce("verdict", F.col("its") != F.col("odd")).alias("verdict"),
        F.coalesce("next", "target").alias("target"),
        (F.col("odd") != F.coalesce("turned", F.lit(False))).alias("odd"),
        (F.col("its").isNull() & (F.col("next") != F.col("at"))).alias("again"),
    )


def _follow(worked_out: DataFrame) -> tuple[DataFrame, int]:
    """Settle rows that hang on settled ones, however long the way; and the number of doublings."""
    ends = worked_out.where(_hangs()).select(F.col("target").alias("of")).distinct()
    on_the_way = cut_lineage(worked_out.join(ends, F.col("place") == F.col("of"), "left_semi"))
    steps = 0
    while True:
        steps += 1
        on_the_way = cut_lineage(_taken_over(on_the_way, on_the_way))
        if on_the_way.where("again").isEmpty():
            return _taken_over(worked_out, on_the_way).drop("again"), steps


def _one_round(open_rows: DataFrame, blocks: int) -> tuple[DataFrame, int]:
    """Open rows with ``kept`` true, false or null (not decided yet), and the steps this took."""
    members = open_rows.select("place", "block", F.explode("shared").alias("key"))
    if blocks == 1:
        links, across = members.withColumn("before", F.lit(None).cast("bigint")), None
    else:
        across = cut_lineage(_spans(members))
        before = F.when(F.col("first") < F.col("block"), F.when(F.col("held") == 2, F.col("owner")).otherwise(-1))
        links = members.join(across, F.col("key") == F.col("of"), "left").select("place", "block", "key", before.alias("before"))
    outcome = links.groupBy("block").applyInPandas(_walk, "place bigint, verdict boolean, target bigint, odd boolean")
    if across is None:
        # Rows without shared keys have no link; nobody stands against them.
        return open_rows.join(outcome, "place", "left").withColumn("kept", F.coalesce("verdict", F.lit(True))).drop("verdict", "target", "odd"), 1
    followed, steps = _follow(cut_lineage(outcome))
    state = cut_lineage(
        open_rows.join(followed, "place", "left")
        .withColumn("verdict", F.when(F.size("shared") == 0, True).otherwise(F.col("verdict")))
        .drop("target", "odd")
    )
    # Rows of later blocks that share a key with a row that is kept now.
    taken = state.where("verdict").select(F.explode("shared").alias("of")).join(across, "of", "left_semi").distinct()
    hit = (
        state.where(F.col("verdict").isNull())
        .select("place", F.explode("shared").alias("key"))
        .join(taken, F.col("key") == F.col("of"))
        .select(F.col("place").alias("hit"))
        .distinct()
    )
    kept = F.when(F.col("hit").isNotNull(), F.lit(False)).otherwise(F.col("verdict"))
    return state.join(hit, F.col("place") == F.col("hit"), "left").withColumn("kept", kept).drop("verdict", "hit"), 1 + steps


def settle(tangled: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """Rows with ``shared`` keys in the order of ``ORDER``: ``kept`` for each, and the number of rounds.

    All other columns pass through.
    """
    open_rows, order, parts, rounds = cut_lineage(tangled), [F.col(c).asc_nulls_first() for c in ORDER], [], 0
    columns = [*tangled.columns, "kept"]
    while count := open_rows.count():
        blocks = -(-count // block_rows)
        state, steps = _one_round(_blocked(open_rows, order, blocks), blocks)
        state, rounds = cut_lineage(state), rounds + steps
        parts.append(state.where(F.col("kept").isNotNull()).select(columns))
        if blocks == 1:
            break
        open_rows, order = state.where(F.col("kept").isNull()).drop("kept", "block"), [F.col("place")]
    if not parts:
        return open_rows.withColumn("kept", F.lit(True)), rounds
    return reduce(DataFrame.unionByName, parts), rounds


def resolve_duplicates(leads: DataFrame, block_rows: int = BLOCK_ROWS) -> Resolution:
    """Decide for every distinct lead with a key whether it is kept."""
    # Filtered after the cut: a filter on the keys would be pushed into the scan
    # and compute them twice.
    rows = cut_lineage(key_rows(leads)).where(F.size("keys") > 0)
    settled, rounds = settle(tangled_rows(rows), block_rows)
    return Resolution(rows, settled.drop("shared"), rounds)


def drop_duplicates(leads: DataFrame, resolution: Resolution | None = None) -> DataFrame:
    """Leads that survive the five-key rule; ``leads`` are normalised and have ``row_id``.

    Leads without any key are always kept, every copy of them.  Most rows only pass an
    anti join with the narrow table of ids that are dropped or occur repeatedly; equal
    rows collapse among the repeated ids alone.  Both joins read the same shuffle of the
    leads, which should be a written table.
    """
    resolution = resolution or resolve_duplicates(leads)
    # Says what holds anyway; without it only one of the two scans would test for it.
    leads = leads.where(F.col("row_id").isNotNull())
    repeated = F.col("kept") & (F.col("copies") > 1)
    special = resolution.settled.where(~F.col("kept") | repeated).select("row_id")
    once = leads.join(special, "row_id", "left_anti")
    collapsed = leads.join(resolution.settled.where(repeated).select("row_id"), "row_id", "left_semi")
    return once.unionByName(collapsed.dropDuplicates(["row_id"]))


def duplicate_reason(key: Column, store: Column, city: Column) -> Column:
    """Reason text for the key that gave a duplicate away."""
    return first_match(
        (
            kind_of(key) == kind,
            fill(template, key=value_of(key), store=F.coalesce(store, F.lit("")), city=F.coalesce(city, F.lit(""))),
        )
        for kind, template in rules.DUPLICATE_REASONS.items()
    )


def duplicate_audit(leads: DataFrame, resolution: Resolution) -> DataFrame:
    """Every dropped lead with the first key kind that matched and the kept lead.

    ``copies`` counts identical input rows that this line stands for; further
    copies of a kept row are listed as duplicates of that row.
    """
    decided = resolution.decided
    owners = decided.where("kept").select(
        F.explode("keys").alias("key"), _order_struct().alias("owner")
    )
    matches = (
        resolution.dropped.select("row_id", "copies", _order_struct().alias("self"), F.explode("keys").alias("key"))
        .join(owners, "key")
        .where(F.col("owner") < F.col("self"))
        .groupBy("row_id", "copies")
        .agg(F.min(F.struct("key", F.col("owner.lead_id").alias("lead_id"))).alias("match"))
    )
    again = decided.where(F.col("kept") & (F.col("copies") > 1)).select(
        "row_id",
        (F.col("copies") - 1).alias("copies"),
        F.struct(F.col("keys")[0].alias("key"), "lead_id").alias("match"),
    )
    wide = leads.select("row_id", "lead_id", "handle", "store_name", "city").dropDuplicates(["row_id"])
    key = F.col("match.key")
    return wide.join(matches.unionByName(again), "row_id").select(
        "lead_id",
        "handle",
        "store_name",
        kind_of(key).alias("matched_on"),
        duplicate_reason(key, F.col("store_name"), F.col("city")).alias("reason"),
        F.lit(rules.DUPLICATE_ACTION).alias("action"),
        F.col("match.lead_id").alias("matched_lead_id"),
        "copies",
    )
