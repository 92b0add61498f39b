"""The daily contact list: tiers, score for silent leads, capacity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.functions import text
from leadloom.functions.logic import fill, first_match, lookup
from leadloom.operators.normalise import numbers_or_zero
from leadloom.schema import RESELLER_COLUMNS

RESELLER_TYPES = ("reseller", "reseller_with_email")
SHOP_TYPES = ("physical_shop", "hybrid")

MEETING_TIER, HOT_TIER, WARM_TIER, FILLER_TIER = 0, 1, 2, 3


def resellers(leads: DataFrame) -> DataFrame:
    return leads.where(F.col("lead_type").isin(*RESELLER_TYPES))


def shops(leads: DataFrame) -> DataFrame:
    return leads.where(F.col("lead_type").isin(*SHOP_TYPES))


def with_reply_defaults(leads: DataFrame) -> DataFrame:
    return leads.fillna({"reply_type": "amber", "obj_type": "none"})


def with_follow_up(leads: DataFrame) -> DataFrame:
    """Follow-up timing and recommended response of each reply type."""
    return leads.withColumns(
        {
            "follow_up_timing": lookup(rules.FOLLOW_UP_TIMING, "reply_type", rules.FOLLOW_UP_TIMING_DEFAULT),
            "recommended_response": lookup(
                rules.RECOMMENDED_RESPONSE, "reply_type", rules.RECOMMENDED_RESPONSE_DEFAULT
            ),
        }
    )


def active(leads: DataFrame) -> DataFrame:
    """Leads in play: not Won, not Lost, not a hard no.  A missing stage is in play."""
    closed = F.coalesce(F.col("stage").isin("Won", "Lost"), F.lit(False))
    return leads.where(~closed & (F.coalesce("reply_type", F.lit("amber")) != "cold"))


def tier() -> Column:
    """0 meeting to confirm, 1 hot, 2 warm, 3 silent; null for anything else.

    One row has one tier, so a lead can not take two slots.
    """
    no_email_meeting = (F.col("stage") == "Meeting Booked") & (F.col("lead_type") == "reseller")
    return first_match(
        [
            (no_email_meeting, MEETING_TIER),
            (F.col("reply_type") == "hot", HOT_TIER),
            (F.col("reply_type") == "warm", WARM_TIER),
            (F.col("reply_type").isin("amber", "new"), FILLER_TIER),
        ],
        F.lit(None).cast("int"),
    )


def with_tier(leads: DataFrame) -> DataFrame:
    """Add ``tier``; meetings to confirm get a reply type of their own."""
    return leads.withColumn("tier", tier()).withColumn(
        "reply_type",
        F.when(F.col("tier") == MEETING_TIER, "meeting_confirmation").otherwise(F.col("reply_type")),
    )


def with_metrics(leads: DataFrame) -> DataFrame:
    return leads.withColumns(
        {
            "combined_revenue": F.col("avg_listing_price_gbp") * F.col("sales_velocity_30d"),
            "turnover_ratio": F.col("sales_velocity_30d") / F.greatest("active_listings", F.lit(1)),
        }
    )


def _points(value: str, maximum: str, weight: float) -> Column:
    return F.least(F.greatest(F.col(value) / F.col(maximum) * weight, F.lit(0.0)), F.lit(float(weight)))


def _maximum(column: Column | str, name: str) -> Column:
    top = F.max(column)
    return F.coalesce(F.nullif(top.cast("double"), F.lit(0.0)), F.lit(1.0)).alias(name)


def score_maxima(candidates: DataFrame) -> DataFrame:
    """One row with the maximum of each signal, 1 where it would be 0."""
    silent = F.col("reply_type").isin("amber", "new")
    return candidates.agg(
        _maximum("sales_velocity_30d", "max_velocity"),
        _maximum("combined_revenue", "max_revenue"),
        _maximum("est_monthly_spend_gbp", "max_spend"),
        _maximum("followers", "max_followers"),
        _maximum("active_listings", "max_listings"),
        _maximum(F.when(silent, F.col("turnover_ratio")), "max_turnover"),
    )


def filler_score() -> Column:
    """Commercial score of a silent lead; needs metrics and maxima."""
    w = rules.FILLER_WEIGHTS
    ignored = F.col("num_touches") >= rules.FILLER_TOUCH_LIMIT
    return F.bround(
        _points("sales_velocity_30d", "max_velocity", w["velocity"])
        + _points("combined_revenue", "max_revenue", w["revenue"])
        + _points("est_monthly_spend_gbp", "max_spend", w["spend"])
        + _points("followers", "max_followers", w["followers"])
        + _points("turnover_ratio", "max_turnover", w["turnover"])
        + F.when(ignored, float(rules.FILLER_TOUCH_PENALTY)).otherwise(0.0),
        2,
    )


def priority_score() -> Column:
    """The documented 130-point score; informative, it does not order the list."""
    w = rules.PRIORITY_WEIGHTS
    return F.bround(
        lookup({k: float(v) for k, v in rules.PRIORITY_REPLY_POINTS.items()}, "reply_type", 0.0)
        + _points("est_monthly_spend_gbp", "max_spend", w["spend"])
        + _points("sales_velocity_30d", "max_velocity", w["velocity"])
        + _points("combined_revenue", "max_revenue", w["revenue"])
        + _points("followers", "max_followers", w["followers"])
        + _points("active_listings", "max_listings", w["listings"]),
        2,
    )


def with_scores(candidates: DataFrame) -> DataFrame:
    """Add ``step_b_score`` (silent leads only) and ``priority_score``.

    The maxima are one row, so the broadcast has a fixed size.
    """
    measured = with_metrics(candidates)
    maxima = score_maxima(measured)
    silent = F.col("reply_type").isin("amber", "new")
    return (
        measured.crossJoin(F.broadcast(maxima))
        .withColumns({"step_b_score": F.when(silent, filler_score()), "priority_score": priority_score()})
        .drop(*maxima.columns)
    )


def why_today(brand: rules.Brand = rules.Brand()) -> Column:
    """One line that says why a lead is on the list."""
    note = text.blank_to_null("notes")
    reasons = {kind: brand.apply(reason) for kind, reason in rules.WARM_REASONS.items()}
    parts = {
        "spend": text.format_gbp("est_monthly_spend_gbp"),
        "last_said": F.left(F.coalesce("last_inbound_text", F.lit("")), F.lit(50)),
        "warm_reason": lookup(reasons, "obj_type", rules.WARM_REASON_DEFAULT),
        "note": F.coalesce(F.concat(F.lit(" | Note: "), note), F.lit("")),
    }
    texts = {kind: fill(template, **parts) for kind, template in rules.WHY_TODAY.items()}
    named = [(F.col("reply_type") == kind, value) for kind, value in texts.items() if kind != "new"]
    return first_match(named, texts["new"])


def queue_candidates(leads: DataFrame) -> DataFrame:
    """Active resellers with numbers, scores and tier."""
    pool = active(with_reply_defaults(numbers_or_zero(resellers(leads))))
    return with_tier(with_scores(pool)).where(F.col("tier").isNotNull())


def daily_queue(
    leads: DataFrame,
    capacity: int = rules.DAILY_CAPACITY,
    brand: rules.Brand = rules.Brand(),
    overdue_first: bool = False,
) -> DataFrame:
    """Today's resellers: at most ``capacity`` rows with ``priority_rank`` 1 to n.

    The limit is taken from the ordered candidates before anything else, so only
    the best ``capacity`` rows of each task travel.
    """
    value = F.when(F.col("tier") == FILLER_TIER, F.col("step_b_score")).otherwise(F.col("est_monthly_spend_gbp"))
    order = [F.col("tier").asc(), value.desc(), F.col("lead_id").asc()]
    if overdue_first:
        late = F.col("overdue") & (F.col("tier") != MEETING_TIER)
        order = [(F.col("tier") != MEETING_TIER).asc(), late.desc(), *order]
    best = queue_candidates(leads).orderBy(*order).limit(capacity)
    ranked = best.withColumn("priority_rank", F.row_number().over(Window.orderBy(*order)))
    explained = with_follow_up(ranked).withColumns(
        {
            "slot_type": lookup(rules.SLOT_TYPE, "reply_type", rules.SLOT_TYPE_DEFAULT),
            "why_today": why_today(brand),
        }
    )
    return explained.select(*[c for c in RESELLER_COLUMNS if c in explained.columns])


def queue_summary(leads: DataFrame, capacity: int = rules.DAILY_CAPACITY) -> DataFrame:
    """Counts per tier, penalised leads and free slots in one pass."""
    ignored = (F.col("tier") == FILLER_TIER) & (F.col("num_touches") >= rules.FILLER_TOUCH_LIMIT)
    answered = F.count_if(F.col("tier") < FILLER_TIER)
    return with_tier(active(with_reply_defaults(numbers_or_zero(resellers(leads))))).agg(
        F.count_if(F.col("tier") == MEETING_TIER).alias("meeting_confirmations"),
        F.count_if(F.col("tier") == HOT_TIER).alias("hot"),
        F.count_if(F.col("tier") == WARM_TIER).alias("warm"),
        F.count_if(F.col("tier") == FILLER_TIER).alias("filler_pool"),
        F.count_if(ignored).alias("deprioritised"),
        F.greatest(F.lit(capacity) - answered, F.lit(0)).alias("slots_remaining"),
    )
