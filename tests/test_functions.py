from datetime import date

import pytest
from pyspark.sql import functions as F

from leadloom.functions import keys, text
from leadloom.functions.logic import contains_any, fill, fill_picked, shortest
from leadloom.operators.shops import money_sum

AS_OF = date(2026, 1, 20)


def results(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


def check(spark, function, cases):
    got = results(spark, function, list(cases))
    assert dict(zip(cases, got, strict=True)) == cases


def test_blank_words_are_missing(spark):
    check(spark, text.blank_to_null, {
        "  ": None, "nan": None, "NaN": None, " None ": None, "\t\n": None, None: None, "nano": "nano", " a b ": "a b",
        "none of it": "none of it", " x ": "x",
    })


def test_handles_in_all_spellings_are_equal(spark):
    check(spark, text.clean_handle, {
        "@SepiaCollective": "sepiacollective",
        "instagram.com/sepiacollective": "sepiacollective",
        "https://www.instagram.com/SepiaCollective": "sepiacollective",
        "http://instagram.com/@sepiacollective": "sepiacollective",
        " sepiacollective ": "sepiacollective",
        "sepiacollective_": "sepiacollective_",
        "nan": "", "": "", None: "",
    })


def test_one_letter_handles_are_no_key(spark):
    check(spark, keys.handle_key, {"@a": None, "@ab": "ab", None: None})


def test_stages(spark):
    check(spark, text.clean_stage, {
        "Contacted ": "Contacted", "contaced": "Contacted", "WARM": "Replied", "call-booked": "Meeting Booked",
        "in negotiation": "Negotiating", "closed_won": "Won", "ghosted": "Lost", "Meeting Booked": "Meeting Booked",
        "Hold": "Hold", "something else": "New", "": "New", None: "New", "wон": "Won",
    })


def test_strict_stage_map(spark):
    check(spark, lambda c: text.clean_stage(c, strict_map=True), {
        "Meeting Booked": "New", "hold": "New", "contaced": "New", "won": "Won",
    })


def test_cleaning_a_clean_stage_changes_nothing(spark):
    from leadloom.rules import STAGES

    check(spark, text.clean_stage, {s: s for s in STAGES})


def test_dates(spark):
    check(spark, lambda c: text.clean_date(c, AS_OF), {
        "2026-01-04": date(2026, 1, 4), "2026-01-04 00:00:00": date(2026, 1, 4), "2025-12-29": date(2025, 12, 29),
        "2026-01-04T10:11:12": date(2026, 1, 4), "04/12/2025": date(2025, 12, 4), "4/1/2026": date(2026, 1, 4),
        "12/13/2025": date(2025, 12, 13), "13/12/2025": date(2025, 12, 13), "Dec 29": date(2025, 12, 29),
        "Jan 5": date(2026, 1, 5), "Jan 20": date(2026, 1, 20), "Jan 21": date(2025, 1, 21), "29 Dec": date(2025, 12, 29),
        "Feb 29": date(2024, 2, 29), "July 5": date(2025, 7, 5), "5 July 2025": date(2025, 7, 5),
        "Jan 5, 2026": date(2026, 1, 5), "31/02/2025": None, "2026-02-30": None, "soon": None, "": None, None: None,
    })


def test_a_leap_day_may_lie_eight_years_back(spark):
    check(spark, lambda c: text.clean_date(c, date(1904, 2, 1)), {"Feb 29": date(1896, 2, 29)})


def test_spend(spark):
    check(spark, text.clean_spend, {
        "£9,000": 9000.0, "9000": 9000.0, "£9000": 9000.0, "140.5": 140.5, "tbc": 0.0, "5d": 0.0, "nan": 0.0,
        "inf": 0.0, "1e999": 0.0, "": 0.0, None: 0.0,
    })


def test_emails(spark):
    check(spark, text.flag_email, {
        "ines@@hotmail.com": "INVALID: ines@@hotmail.com", "no-at": "INVALID: no-at", "a@b": "INVALID: a@b",
        " ok@mail.com ": "ok@mail.com", "INVALID: ines@@hotmail.com": "INVALID: ines@@hotmail.com", "": "", None: "",
    })
    check(spark, keys.email_key, {
        "ines@@hotmail.com": "ines@hotmail.com", "Ines@Hotmail.com ": "ines@hotmail.com",
        "INVALID: ines@@hotmail.com": "ines@hotmail.com", "a@b@c.de": None, "@": None, None: None,
    })
    check(spark, text.email_in_text, {
        "mail shop@vintage.co.uk or b@c.de": "shop@vintage.co.uk", "none": None, None: None,
    })


def test_phones(spark):
    check(spark, keys.phone_key, {
        "+44 7737 683411": "07737683411", "0044 7737683411": "07737683411", "07737683411": "07737683411",
        "+33 489 6004150": "334896004150", "0033 489 6004150": "334896004150", "+1 878 3983612": "18783983612",
        "123456": None, "": None, None: None,
    })


def test_store_and_city_need_both(spark):
    rows = spark.createDataFrame([(" Rusty Wardrobe", "manchester "), ("x", None), (None, "y")], "s string, c string")
    got = [r[0] for r in rows.select(keys.store_city_key("s", "c")).collect()]
    assert got == ["rusty wardrobe|manchester", None, None]


def test_messages_lose_quotes(spark):
    check(spark, text.message_text, {
        "'ok sounds good when can we talk": "ok sounds good when can we talk", "  \"Hi\" ": "hi", "'nan'": None,
        "`": None, "None": None, None: None,
    })


def test_formats(spark):
    row = spark.range(1).select(
        text.format_gbp(F.lit(9000.7)), text.format_gbp(F.lit(-0.5)), text.long_date(text.next_tuesday(date(2026, 12, 1)))
    ).first()
    assert tuple(row) == ("£9,000", "£0", "Tuesday 08 December 2026")


@pytest.mark.parametrize(("country", "plain", "blank"), [
    ("UK", True, True), (" uk ", True, True), ("France", False, False), (None, False, True), ("", False, True),
])
def test_uk(spark, country, plain, blank):
    row = spark.createDataFrame([(country,)], "c string").select(
        text.is_uk("c"), text.is_uk("c", blank_is_uk=True)
    ).first()
    assert tuple(row) == (plain, blank)


def test_shortest_phrases_are_enough():
    assert shortest(["do a call", "can you do a call", "call", "pop in"]) == ["call", "pop in"]
    assert shortest(["maybe next month", "owner back"], covered_by=["maybe"]) == ["owner back"]


def test_contains_any_quotes_and_words(spark):
    rows = spark.createDataFrame([("let's meet",), ("next month",), ("come mon",)], "m string")
    assert [r[0] for r in rows.select(contains_any("m", ["let's meet"])).collect()] == [True, False, False]
    assert [r[0] for r in rows.select(contains_any("m", ["mon"])).collect()] == [False, True, True]
    assert [r[0] for r in rows.select(contains_any("m", ["mon"], whole_words=True)).collect()] == [False, False, True]


def test_filled_values_are_not_read_as_placeholders(spark):
    rows = spark.createDataFrame([(0, "{b}"), (1, "z")], "n int, a string")
    got = rows.select(fill_picked(["x {a} {b}", "y {a}"], "n", a="a", b=F.lit("B"))).collect()
    assert [r[0] for r in got] == ["x {b} B", "y z"]
    assert rows.select(fill("{a}!", a="a")).first()[0] == "{b}!"


@pytest.mark.parametrize(
    "typed, day",
    [
        ("23/07/26", date(2026, 7, 23)),
        ("1/2/2026 10:30", date(2026, 2, 1)),
        ("July 2025", date(2025, 7, 1)),
        ("23 Jul 99", date(1999, 7, 23)),
        ("2026-01-05 10:22:07", date(2026, 1, 5)),
        ("2026-01-05T10:22:07Z", date(2026, 1, 5)),
        ("2026-01-051", None),
    ],
)
def test_dates_of_exports(spark, typed, day):
    frame = spark.createDataFrame([(typed,)], "typed string")
    assert frame.select(text.clean_date("typed", date(2026, 12, 1)).alias("day")).first().day == day


def test_one_huge_amount_is_summed(spark):
    frame = spark.createDataFrame([(1e30,), (5.0,), (None,)], "amount double")
    assert frame.agg(money_sum("amount").alias("total")).first().total == 1e30
    assert frame.where("amount < 10").agg(money_sum("amount").alias("total")).first().total == 5.0
