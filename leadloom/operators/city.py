"""Which city to visit, and the visiting order inside each city."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.functions import text
from leadloom.functions.logic import fill, first_match, lookup
from leadloom.operators.geo import UK_NAMES
from leadloom.operators.normalise import numbers_or_zero
from leadloom.operators.ranking import with_position
from leadloom.operators.shops import money_sum


def visitable_shops(leads: DataFrame, include_hybrid: bool = False) -> DataFrame:
    """UK shops in play; a missing country counts as UK."""
    kinds = ("physical_shop", "hybrid") if include_hybrid else ("physical_shop",)
    closed = F.coalesce(F.col("stage").isin("Hold", "Lost", "Won"), F.lit(False))
    return (
        numbers_or_zero(
            leads.where(
                F.col("lead_type").isin(*kinds)
                & ~closed
                & text.is_uk("country", names=UK_NAMES, blank_is_uk=True)
            )
        )
        .withColumn("city", text.city_title("city"))
    )


def visit_weight() -> Column:
    """Commercial probability of a visit by stage, reply and spend."""
    stage, spend = F.col("stage"), F.col("est_monthly_spend_gbp")
    cases = [(stage == name, weight) for name, weight in rules.VISIT_STAGE_WEIGHT.items()]
    cases += [
        (
            stage == "Replied",
            lookup(
                rules.VISIT_REPLIED_WEIGHT, F.lower(text.strip("reply_type")), rules.VISIT_REPLIED_WEIGHT_DEFAULT
            ),
        ),
        ((stage == "New") & (spend >= rules.HIGH_VALUE_SPEND), rules.VISIT_NEW_HIGH_WEIGHT),
        ((stage == "New") & (spend >= rules.MID_VALUE_SPEND), rules.VISIT_NEW_MID_WEIGHT),
    ]
    return first_match(cases, 0.0)


def scored_shops(leads: DataFrame, include_hybrid: bool = False, hybrid_boost: float = 1.0) -> DataFrame:
    """Shops worth a visit with ``visit_score`` above 0."""
    boost = F.when(F.col("lead_type") == "hybrid", hybrid_boost).otherwise(1.0)
    score = F.col("est_monthly_spend_gbp") * visit_weight()
    return (
        visitable_shops(leads, include_hybrid)
        .withColumn("visit_score", score * boost if hybrid_boost != 1.0 else score)
        .where(F.col("visit_score") > 0)
    )


def city_totals(scored: DataFrame) -> DataFrame:
    """Score, pipeline and shop counts of each city, in no order."""
    stage, reply = F.col("stage"), F.col("reply_type")

    def count_of(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    return (
        scored.where(text.blank_to_null("city").isNotNull())
        .groupBy("city")
        .agg(
            F.bround(money_sum("visit_score"), 0).cast("double").alias("total_score"),
            F.bround(money_sum("est_monthly_spend_gbp"), 0).cast("double").alias("total_pipeline_gbp"),
            F.count(F.lit(1)).alias("total_shops"),
            count_of(stage == "Meeting Booked", "meeting_booked"),
            count_of(stage == "Negotiating", "negotiating"),
            count_of((stage == "Replied") & (reply == "hot"), "replied_hot"),
            count_of((stage == "Replied") & (reply == "warm"), "replied_warm"),
            count_of(stage == "Contacted", "contacted"),
            count_of(stage == "New", "new_shops"),
        )
    )


def ranking_order() -> list[Column]:
    return [F.col("total_score").desc(), F.col("city").asc()]


def city_rankings(scored: DataFrame) -> DataFrame:
    """Cities by score, best first."""
    return city_totals(scored).orderBy(*ranking_order())


def numbered_cities(scored: DataFrame) -> DataFrame:
    """Cities with their ``rank``."""
    return with_position(city_totals(scored), ranking_order(), "rank")


def top_city(scored: DataFrame) -> DataFrame:
    """The one best city; empty if no shop scores."""
    return city_totals(scored).orderBy(*ranking_order()).limit(1)


def recommendation(scored: DataFrame, as_of: date) -> DataFrame:
    """Best city, visiting day and a sentence for the team."""
    day = text.next_tuesday(as_of)
    sentence = fill(
        "Visit {city} on {day}. {value} in pipeline value across {count} shops.",
        city="city",
        day=text.long_date(day),
        value=text.format_gbp("total_pipeline_gbp"),
        count=F.col("total_shops").cast("string"),
    )
    return top_city(scored).select(
        "city", day.alias("visit_date"), "total_pipeline_gbp", "total_shops", sentence.alias("recommendation")
    )


def visit_action() -> Column:
    stage, reply, spend = F.col("stage"), F.col("reply_type"), F.col("est_monthly_spend_gbp")
    high, mid = spend >= rules.HIGH_VALUE_SPEND, spend >= rules.MID_VALUE_SPEND
    amount = text.format_gbp(spend)
    say = {name: fill(template, spend=amount) for name, template in rules.VISIT_ACTIONS.items()}
    return first_match(
        [
            (stage == "Meeting Booked", say["meeting"]),
            (stage == "Negotiating", say["negotiating"]),
            ((stage == "Replied") & (reply == "hot"), say["replied_hot"]),
            ((stage == "Replied") & (reply == "warm"), say["replied_warm"]),
            (stage == "Replied", say["replied"]),
            ((stage == "Contacted") & high, say["contacted_high"]),
            ((stage == "New") & high, say["new_high"]),
            ((stage == "New") & mid, say["new_mid"]),
        ],
        say["other"],
    )


def visit_order() -> list[Column]:
    """Stage, reply, spend; the lead id settles ties."""
    return [
        lookup(rules.VISIT_STAGE_ORDER, "stage", rules.VISIT_ORDER_DEFAULT).asc(),
        lookup(rules.VISIT_REPLY_ORDER, "reply_type", rules.VISIT_ORDER_DEFAULT).asc(),
        F.col("est_monthly_spend_gbp").desc(),
        F.col("lead_id").asc_nulls_last(),
    ]


def _itinerary(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "visit_order",
        text.first_present("store_name", "handle", default="Unknown").alias("store_name"),
        F.left(text.first_present("store_name", "handle", default="Unknown"), F.lit(27)).alias("short_name"),
        "city",
        "stage",
        "reply_type",
        "est_monthly_spend_gbp",
        F.coalesce("email", F.lit("")).alias("email"),
        F.coalesce("phone", F.lit("")).alias("phone"),
        visit_action().alias("action"),
        "visit_score",
        "notes",
        "last_inbound_text",
    )


def itineraries(scored: DataFrame) -> DataFrame:
    """Visiting order of every city, numbered from 1 in each."""
    located = scored.where(text.blank_to_null("city").isNotNull())
    return _itinerary(with_position(located, visit_order(), "visit_order", within=["city"]))


def visit_plan(scored: DataFrame) -> DataFrame:
    """Visiting order of the best city only; the semi join's right side is one row."""
    best = F.broadcast(top_city(scored).select("city"))
    return _itinerary(
        with_position(scored.join(best, "city", "left_semi"), visit_order(), "visit_order")
    )
