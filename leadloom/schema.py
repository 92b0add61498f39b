"""Column names and types of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = (
    "lead_id", "handle", "contact_name", "store_name", "email", "phone", "city", "country",
    "followers", "active_listings", "sales_velocity_30d", "avg_listing_price_gbp",
    "est_monthly_spend_gbp", "stage", "first_seen_date", "last_touch_date", "num_touches",
    "last_inbound_text", "notes", "assigned_bdr",
)

# Leads arrive as text; typing happens in the cleaning step, never by inference.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

COUNT_COLUMNS = ("followers", "active_listings", "sales_velocity_30d", "num_touches")
MONEY_COLUMNS = ("avg_listing_price_gbp", "est_monthly_spend_gbp")

CLEAN_COLUMNS = RAW_COLUMNS + (
    "email_valid", "lead_type", "stage_raw", "stage_overridden", "reply_type", "obj_type", "overdue",
    "has_metrics",
)

LEAD_TYPES = ("reseller", "reseller_with_email", "physical_shop", "hybrid")

# Struct of the columns that are not known, on the way through the cleaning.
ADDITIONAL = "_additional"

# The columns that identity keys are made of.
CLEAN_KEYS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("lead_id", "handle", "email", "phone", "store_name", "city")]
)

CONFIRMATION_SCHEMA = T.StructType(
    [T.StructField("lead_id", T.StringType()), T.StructField("confirmed_for", T.DateType())]
)

RESELLER_COLUMNS = (
    "lead_id", "handle", "contact_name", "stage", "followers", "sales_velocity_30d",
    "est_monthly_spend_gbp", "last_touch_date", "last_inbound_text", "priority_score",
    "step_b_score", "priority_rank", "slot_type", "why_today", "reply_type", "follow_up_timing",
    "obj_type", "recommended_response", "lead_type", "email", "phone", "store_name", "notes",
)

SHOP_COLUMNS = (
    "lead_id", "store_name", "contact_name", "email", "phone", "city", "country", "stage",
    "reply_type", "obj_type", "est_monthly_spend_gbp", "last_touch_date", "last_inbound_text",
    "recommended_action", "assigned_bdr", "notes",
)

REJECTION_COLUMNS = ("lead_id", "handle", "store_name", "reason", "action", "matched_lead_id")
