"""Incremental load: which incoming leads are new, and why the others are not."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.functions.keys import identity_keys
from leadloom.functions.text import clean_handle, strip
from leadloom.operators.additional import pack, packed_name, unpack, unpacked
from leadloom.operators.classify import classify_leads, note_hints
from leadloom.operators.geo import repair_geography
from leadloom.operators.identity import drop_duplicates, duplicate_reason, with_row_id
from leadloom.operators.normalise import normalise_leads
from leadloom.schema import CLEAN_COLUMNS, LEAD_TYPES, REJECTION_COLUMNS
from leadloom.session import cut_lineage


def known_keys(existing: DataFrame) -> DataFrame:
    """Every identity key of the existing leads with one lead that has it."""
    return (
        existing.select("lead_id", F.explode(identity_keys(clean=True)).alias("key"))
        .groupBy("key")
        .agg(F.min("lead_id").alias("matched_lead_id"))
    )


def held_keys(existing: DataFrame) -> DataFrame:
    """``key`` and ``lead_id``: one row for every identity key of every existing lead."""
    return existing.select("lead_id", F.explode(identity_keys(clean=True)).alias("key"))


def check_batch(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows with ``reason`` and ``matched_lead_id``; both null for new leads.

    All existing leads are read; see ``check_keys`` and ``leadloom.sources.key_index``
    for a check that does not.
    """
    return check_keys(incoming, held_keys(existing))


def check_keys(incoming: DataFrame, held: DataFrame) -> DataFrame:
    """``check_batch`` against ``held`` keys (``key``, ``lead_id``), several rows for a key allowed.

    The held keys are cut down to those that occur in the batch before they
    are grouped, so a small batch is broadcast to the large table and not the
    other way round.  Rows of the batch are not compared with each other.
    """
    rows = with_row_id(pack(incoming))
    keys = rows.select("row_id", F.explode(identity_keys()).alias("key")).distinct()
    wanted = keys.select("key").distinct()
    found = held.join(wanted, "key", "left_semi").groupBy("key").agg(F.min("lead_id").alias("matched_lead_id"))
    # Keys begin with the number of their kind: the least key is the first check.
    hits = (
        keys.join(found, "key")
        .groupBy("row_id")
        .agg(F.min(F.struct("key", "matched_lead_id")).alias("hit"))
    )
    checked = rows.join(hits, "row_id", "left")
    return checked.withColumns(
        {
            "reason": F.when(
                F.col("hit").isNotNull(), duplicate_reason(F.col("hit.key"), strip("store_name"), strip("city"))
            ),
            "matched_lead_id": F.col("hit.matched_lead_id"),
        }
    ).drop("hit", "row_id")


def new_rows(checked: DataFrame) -> DataFrame:
    """Incoming rows without a known key, as they came."""
    return unpack(checked.where(F.col("reason").isNull()).drop("reason", "matched_lead_id"))


def rejections(checked: DataFrame) -> DataFrame:
    """Rejected rows with reason and action; written even if nothing is new.

    Additional columns stay in the log, as one text in JSON form: what was rejected
    can then be read in full.
    """
    additional = [F.to_json(name).alias("additional") for name in packed_name(checked)]
    return (
        checked.where(F.col("reason").isNotNull())
        .withColumns(
            {
                "handle": clean_handle("handle"),
                "store_name": F.coalesce(strip("store_name"), F.lit("")),
                "action": F.lit(rules.DUPLICATE_ACTION),
            }
        )
        .select(*REJECTION_COLUMNS, *additional)
    )


def clean_new_leads(
    fresh: DataFrame, as_of: date, within_batch: bool = False, brand: rules.Brand = rules.Brand()
) -> DataFrame:
    """New rows through the full cleaning, with ``personalisation_signals`` and any additional columns.

    ``within_batch`` also removes duplicates inside the batch.
    """
    leads = repair_geography(normalise_leads(fresh, as_of))
    if within_batch:
        # Read several times below; the batch check must not run again for each.
        leads = drop_duplicates(cut_lineage(with_row_id(leads)))
    signals = note_hints("notes", brand).alias("personalisation_signals")
    other = unpacked(leads, without=["personalisation_signals"])
    return classify_leads(leads, as_of).select(*CLEAN_COLUMNS, signals, *other)


def append_columns(base: DataFrame, new: DataFrame) -> DataFrame:
    """Base and new rows together; the columns are those of both."""
    return base.unionByName(new, allowMissingColumns=True)


def append_to_clean(clean: DataFrame, new: DataFrame) -> DataFrame:
    """Clean leads and new rows together; the columns stay those of ``clean``."""
    missing = [F.lit(None).cast(clean.schema[c].dataType).alias(c) for c in clean.columns if c not in new.columns]
    return clean.unionByName(new.select("*", *missing).select(*clean.columns))


def load_summary(existing: DataFrame, incoming: DataFrame, new: DataFrame) -> DataFrame:
    """One row: leads before, incoming, added, rejected, after, and what was added."""
    before = existing.agg(F.count(F.lit(1)).alias("leads_before"))
    arrived = incoming.agg(F.count(F.lit(1)).alias("incoming"))
    added = new.agg(
        F.count(F.lit(1)).alias("added"),
        *[
            F.count_if(F.col("lead_type") == kind).alias(kind)
            for kind in LEAD_TYPES
        ],
        F.count_if(F.col("personalisation_signals") != "").alias("with_signals"),
    )
    return (
        before.crossJoin(arrived)
        .crossJoin(added)
        .withColumns(
            {
                "rejected": F.col("incoming") - F.col("added"),
                "leads_after": F.col("leads_before") + F.col("added"),
            }
        )
    )
