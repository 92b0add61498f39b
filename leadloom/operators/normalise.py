"""Column clean-up of raw leads in one projection, without a shuffle."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions import text
from leadloom.functions.logic import ColumnLike, as_column
from leadloom.functions.text import INVALID
from leadloom.operators.additional import pack, packed_name
from leadloom.schema import COUNT_COLUMNS, MONEY_COLUMNS, RAW_COLUMNS


NUMBER_COLUMNS = (*COUNT_COLUMNS, "avg_listing_price_gbp")


def has_metric(value: ColumnLike) -> Column:
    """A reseller metric counts if something other than ``0`` was entered."""
    return F.coalesce(as_column(value) != "0", F.lit(False))


def _carried(raw: DataFrame) -> list[str]:
    """What an earlier cleaning found in the text that was typed; null for leads that had none."""
    kinds = {"has_metrics": "BOOLEAN", "stage_raw": "STRING", "stage_overridden": "BOOLEAN"}
    return [
        f"TRY_CAST({name if name in raw.columns else 'NULL'} AS {kind}) AS _{name}" for name, kind in kinds.items()
    ]


def normalise_leads(raw: DataFrame, as_of: date, strict_map: bool = False) -> DataFrame:
    """Typed, trimmed leads.

    Adds ``email_valid``, ``stage_raw`` (the stage as it was typed) and
    ``has_metrics`` (followers or sales velocity present), which the lead type
    needs and which must be taken from the text before typing.  Leads that were
    cleaned before bring both along, and ``_stage_overridden``, so that cleaning them
    again changes nothing.  Additional columns stay, packed in one struct.

    Three stacked projections: trim, blank to null, convert.  Each value is
    computed once and stays inside one code generation stage.
    """
    raw = pack(raw)
    carried, additional = _carried(raw), packed_name(raw)
    trimmed = raw.selectExpr(
        *[f"{text.strip_sql(f'CAST({name} AS STRING)')} AS {name}" for name in RAW_COLUMNS], *carried, *additional
    )
    present = trimmed.selectExpr(
        *[f"{text.present_sql(name)} AS {name}" for name in RAW_COLUMNS],
        "_has_metrics", "_stage_raw", "_stage_overridden", *additional,
    )
    parsed = present.withColumns(
        {name: text.number_of(name) for name in NUMBER_COLUMNS}
        | {
            "est_monthly_spend_gbp": text.spend_of("est_monthly_spend_gbp"),
            "email": text.unflagged("email"),
            "stage_raw": F.when(F.col("_stage_overridden").isNotNull(), F.col("_stage_raw")).otherwise(F.col("stage")),
            "has_metrics": F.coalesce(
                F.col("_has_metrics"), has_metric("followers") | has_metric("sales_velocity_30d")
            ),
        }
    ).withColumn("email_valid", F.coalesce(F.col("email").rlike(text.EMAIL_SHAPE), F.lit(False)))
    handle = text.handle_of("handle")
    return parsed.withColumns(
        {name: text.finite(name).try_cast("bigint") for name in COUNT_COLUMNS}
        | {
            "avg_listing_price_gbp": text.finite("avg_listing_price_gbp"),
            "est_monthly_spend_gbp": F.coalesce(text.finite("est_monthly_spend_gbp"), F.lit(0.0)),
            "handle": F.nullif(handle, F.lit("")),
            "email": text.flagged_email_of("email", "email_valid"),
            "stage": text.stage_of("stage", strict_map),
            "first_seen_date": text.date_of("first_seen_date", as_of),
            "last_touch_date": text.date_of("last_touch_date", as_of),
        }
    ).select(*RAW_COLUMNS, "email_valid", "stage_raw", "has_metrics", "_stage_overridden", *additional)


def invalid_emails(leads: DataFrame) -> DataFrame:
    """Leads whose e-mail needs a human, with the flagged text."""
    return leads.where(F.col("email").startswith(INVALID)).select("lead_id", "email")


def numbers_or_zero(leads: DataFrame) -> DataFrame:
    """Missing or unreadable amounts and counts become 0."""
    columns = {}
    for name in COUNT_COLUMNS + MONEY_COLUMNS:
        kind = "bigint" if name in COUNT_COLUMNS else "double"
        columns[name] = F.coalesce(text.clean_number(F.col(name).cast("string")).try_cast(kind), F.lit(0).cast(kind)) \
            if dict(leads.dtypes)[name] == "string" else F.coalesce(F.col(name), F.lit(0).cast(kind))
    return leads.withColumns(columns)
