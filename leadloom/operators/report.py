"""Counts and audits over clean leads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions import text
from leadloom.functions.logic import first_match
from leadloom.operators.queue import SHOP_TYPES
from leadloom.operators.shops import money_sum
from leadloom.schema import LEAD_TYPES


def value_counts(leads: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        leads.groupBy(column)
        .agg(F.count(F.lit(1)).alias("leads"))
        .orderBy(F.col("leads").desc(), F.col(column).asc_nulls_last())
    )


#: What ``all_counts`` counts: its name, and the columns it groups by.
COUNTED = {
    "stage": ["stage"],
    "lead_type": ["lead_type"],
    "reply_type": ["reply_type"],
    "reseller_reply": ["is_reseller", "reply_type"],
}


def all_counts(leads: DataFrame) -> DataFrame:
    """``counted``, ``value`` and ``leads``: every count of ``value_counts`` the report needs, in one scan."""
    columns = ["stage", "lead_type", "reply_type", "is_reseller"]
    rows = leads.select(*columns[:-1], (F.col("lead_type") != "physical_shop").alias("is_reseller"))
    counts = rows.groupingSets([[F.col(c) for c in own] for own in COUNTED.values()], *columns).agg(
        F.grouping_id().alias("which"), F.count(F.lit(1)).alias("leads")
    )
    # Bit i, from the left, says that a column is not grouped by.
    masks = {name: sum((c not in own) << (len(columns) - 1 - i) for i, c in enumerate(columns)) for name, own in COUNTED.items()}
    counted = first_match((F.col("which") == mask, F.lit(name)) for name, mask in masks.items())
    value = first_match((F.col("which") == masks[name], F.col(COUNTED[name][-1])) for name in COUNTED)
    wanted = (F.col("which") != masks["reseller_reply"]) | F.col("is_reseller")
    return counts.where(wanted).select(counted.alias("counted"), value.alias("value"), "leads")


def reseller_reply_counts(leads: DataFrame) -> DataFrame:
    """Reply types of all leads that are not pure shops."""
    return value_counts(leads.where(F.col("lead_type") != "physical_shop"), "reply_type")


def override_totals(leads: DataFrame) -> DataFrame:
    """Stage corrections in one row: how many, where to, and their spend."""
    changed = F.col("stage_overridden")
    return leads.where(changed).agg(
        F.count(F.lit(1)).alias("overridden"),
        F.count_if(F.col("stage") == "Replied").alias("moved_to_replied"),
        F.count_if(F.col("stage") == "Hold").alias("moved_to_hold"),
        F.coalesce(money_sum("est_monthly_spend_gbp").cast("double"), F.lit(0.0)).alias("spend_recovered"),
    )


def override_details(leads: DataFrame) -> DataFrame:
    """One line per corrected lead with what it said last."""
    return leads.where("stage_overridden").select(
        "lead_id",
        text.first_present("handle", "store_name", "lead_id").alias("identifier"),
        "stage_raw",
        F.col("stage").alias("stage_now"),
        F.coalesce("last_inbound_text", F.lit("")).alias("last_said"),
    )


def headline_counts(leads: DataFrame) -> DataFrame:
    """All filter counts of the daily report in one pass."""
    reseller = F.col("lead_type").isin("reseller", "reseller_with_email")
    shop = F.col("lead_type").isin(*SHOP_TYPES)

    def replied(kind: str) -> Column:
        return F.count_if(reseller & (F.coalesce("reply_type", F.lit("amber")) == kind))

    return leads.agg(
        F.count(F.lit(1)).alias("leads"),
        *[
            F.count_if(F.col("lead_type") == kind).alias(kind)
            for kind in LEAD_TYPES
        ],
        F.count_if(reseller).alias("resellers"),
        F.count_if(shop).alias("shops"),
        *[replied(kind).alias(f"resellers_{kind}") for kind in ("hot", "warm", "amber", "new")],
        F.count_if("overdue").alias("overdue"),
        F.count_if(~F.col("email_valid") & F.col("email").isNotNull()).alias("invalid_emails"),
    )
