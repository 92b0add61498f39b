"""Shop order, recommended action, confirmed visits and regional hubs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.functions import text
from leadloom.functions.logic import fill, first_match, lookup
from leadloom.operators.normalise import numbers_or_zero
from leadloom.operators.queue import shops
from leadloom.operators.ranking import with_position
from leadloom.schema import SHOP_COLUMNS


def stage_priority() -> Column:
    return lookup(rules.SHOP_STAGE_ORDER, "stage", rules.SHOP_STAGE_ORDER_DEFAULT)


def region_order() -> Column:
    """0 for UK shops, which are listed first, 1 for all others and unknown countries."""
    return F.when(text.is_uk("country", fold_case=False), 0).otherwise(1)


def recommended_action(brand: rules.Brand = rules.Brand()) -> Column:
    """Next step for a shop from stage, country, reply, objection and spend."""
    stage, reply = F.col("stage"), F.coalesce("reply_type", F.lit(""))
    objection = F.coalesce("obj_type", F.lit(""))
    spend = F.coalesce("est_monthly_spend_gbp", F.lit(0.0))
    said = F.lower(F.coalesce("last_inbound_text", F.lit("")))
    uk = text.is_uk("country")
    high = spend >= rules.HIGH_VALUE_SPEND
    amount = text.format_gbp(spend)
    say = {name: fill(brand.apply(template), spend=amount) for name, template in rules.SHOP_ACTIONS.items()}
    replied_uk = (stage == "Replied") & uk
    return first_match(
        [
            (stage == "Lost", say["lost"]),
            (stage == "Hold", say["hold"]),
            ((stage == "Won") & uk, say["won_uk"]),
            (stage == "Won", say["won_abroad"]),
            ((stage == "Meeting Booked") & uk, say["meeting_uk"]),
            (stage == "Meeting Booked", say["meeting_abroad"]),
            ((stage == "Negotiating") & uk, say["negotiating_uk"]),
            (stage == "Negotiating", say["negotiating_abroad"]),
            (replied_uk & (reply == "hot"), say["replied_uk_hot"]),
            (
                replied_uk & (said.contains("vinted") | (objection == "misunderstanding")),
                say["replied_uk_misunderstanding"],
            ),
            (
                replied_uk & (said.contains("another platform") | (objection == "platform")),
                say["replied_uk_platform"],
            ),
            (replied_uk, say["replied_uk"]),
            (stage == "Replied", say["replied_abroad"]),
            ((stage == "Contacted") & uk & high, say["contacted_uk_high"]),
            ((stage == "Contacted") & uk, say["contacted_uk"]),
            (stage == "Contacted", say["contacted_abroad"]),
            ((stage == "New") & uk & high, say["new_uk_high"]),
            (stage == "New", say["new"]),
        ],
        say["other"],
    )


def plan_shops(leads: DataFrame, brand: rules.Brand = rules.Brand()) -> DataFrame:
    """Shops with region, stage priority and recommended action, in no order."""
    return numbers_or_zero(shops(leads)).withColumns(
        {
            "region_order": region_order(),
            "stage_priority": stage_priority(),
            "recommended_action": recommended_action(brand),
        }
    )


def shop_order() -> list[Column]:
    """UK first by city; others by country and city; then stage, spend and lead id."""
    abroad = F.when(F.col("region_order") == 1, F.col("country"))
    return [
        F.col("region_order").asc(),
        abroad.asc_nulls_last(),
        F.col("city").asc_nulls_last(),
        F.col("stage_priority").asc(),
        F.col("est_monthly_spend_gbp").desc(),
        F.col("lead_id").asc_nulls_last(),
    ]


def sequenced_shops(leads: DataFrame, brand: rules.Brand = rules.Brand()) -> DataFrame:
    """All shops sorted across tasks in calling order."""
    planned = plan_shops(leads, brand)
    return planned.orderBy(*shop_order()).select(*[c for c in SHOP_COLUMNS if c in planned.columns])


def numbered_shops(leads: DataFrame, brand: rules.Brand = rules.Brand()) -> DataFrame:
    """All shops with ``shop_rank``, their place in calling order."""
    numbered = with_position(plan_shops(leads, brand), shop_order(), "shop_rank")
    return numbered.select("shop_rank", *[c for c in SHOP_COLUMNS if c in numbered.columns])


def confirmed_visits(planned_shops: DataFrame, confirmations: DataFrame) -> DataFrame:
    """Shops whose owner agreed to a time; empty, with all columns, if nobody did."""
    columns = [c for c in SHOP_COLUMNS if c in planned_shops.columns]
    return (
        planned_shops.select(*columns)
        .join(confirmations.select("lead_id"), "lead_id", "left_semi")
        .withColumn("appointment_confirmed", F.lit(True))
    )


def uk_city_counts(leads: DataFrame) -> DataFrame:
    """Shops, negotiating and replied shops of each UK city."""
    uk = shops(leads).where(text.is_uk("country", fold_case=False) & F.col("city").isNotNull())
    return uk.groupBy("city").agg(
        F.count(F.lit(1)).alias("shops"),
        F.count_if(F.col("stage") == "Negotiating").alias("negotiating"),
        F.count_if(F.col("stage") == "Replied").alias("replied"),
    )


def money_sum(column: str) -> Column:
    """Sum of pound amounts, as a double, that does not depend on the order of the rows.

    Where an amount or the sum is too large for a decimal, the plain sum of doubles
    stands in, so nothing is left out.
    """
    amount = F.coalesce(F.col(column), F.lit(0.0))
    exact = amount.try_cast("decimal(24,6)")
    return F.when(F.count_if(exact.isNull()) == 0, F.try_sum(exact).try_cast("double")).otherwise(F.sum(amount))


def regional_hubs(leads: DataFrame) -> DataFrame:
    """Accounts and pipeline value of each city, largest pipeline first."""
    return (
        shops(leads)
        .where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(
            F.count("lead_id").alias("total_accounts"),
            money_sum("est_monthly_spend_gbp").cast("double").alias("total_pipeline"),
            F.count_if(F.col("stage") == "Meeting Booked").alias("meeting_booked"),
            F.count_if(F.col("stage") == "Replied").alias("replied"),
            F.count_if(F.col("stage") == "Contacted").alias("contacted"),
        )
        .withColumn("sequence_strategy", F.lit(rules.HUB_STRATEGY))
        .orderBy(F.col("total_pipeline").desc(), F.col("city"))
    )
