"""Repair of country and city from e-mail domain and store name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.functions import text
from leadloom.functions.logic import first_match

UK_NAMES = ("UK", "UNITED KINGDOM")


def repair_geography(leads: DataFrame) -> DataFrame:
    """Set country and city where the e-mail or the store name proves a UK shop.

    A place word in the store name beats the e-mail rule and any city already
    entered.  ``forced_uk`` marks rows whose country was really changed;
    ``geo_flag`` marks those that still carry a US phone code, which are also
    warned about in ``notes``.
    """
    store = F.lower("store_name")
    place = first_match((store.contains(word), city) for word, city in rules.STORE_NAME_PLACES.items())
    not_uk = ~text.is_uk("country", names=UK_NAMES)
    uk_mail = F.coalesce(F.lower("email").endswith(".co.uk"), F.lit(False)) & not_uk
    known_city = F.coalesce(
        text.city_title("city").isin(*sorted(set(rules.STORE_NAME_PLACES.values()))), F.lit(False)
    )
    signals = leads.withColumns({"_place": place, "_uk_mail": uk_mail, "_not_uk": not_uk, "_known": known_city})

    forced = F.col("_not_uk") & (F.col("_uk_mail") | F.col("_place").isNotNull())
    us_phone = F.coalesce(F.translate("phone", " -()", "").rlike(r"^(\+1|001)"), F.lit(False))
    flagged = forced & us_phone
    warning = F.concat_ws(" ", F.lit(rules.PHONE_COUNTRY_WARNING), F.col("notes"))
    return signals.withColumns(
        {
            "city": F.coalesce("_place", F.when(F.col("_uk_mail") & ~F.col("_known"), "London"), "city"),
            "country": F.when(F.col("_place").isNotNull() | F.col("_uk_mail"), "UK").otherwise(F.col("country")),
            "notes": F.when(flagged, warning).otherwise(F.col("notes")),
            "forced_uk": forced,
            "geo_flag": flagged,
        }
    ).drop("_place", "_uk_mail", "_not_uk", "_known")


def geography_summary(repaired: DataFrame) -> DataFrame:
    """How many rows were moved to the UK, and how many of them need a phone check."""
    return repaired.agg(
        F.count_if("forced_uk").alias("forced_uk"), F.count_if("geo_flag").alias("phone_conflicts")
    )
