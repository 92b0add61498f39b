from datetime import date

import pytest
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.operators import classify, queue
from leadloom.plans.clean import classified_leads, clean_leads
from leadloom.schema import CLEAN_COLUMNS

AS_OF = date(2026, 6, 30)


def classified(leads, cases, **common):
    """Classified row of each case's fields (its first element), in one job."""
    rows = [{**common, **fields, "lead_id": f"L{i:03d}"} for i, (fields, *_) in enumerate(cases)]
    found = {r.lead_id: r for r in classified_leads(leads(*rows), AS_OF).collect()}
    return [(found[f"L{i:03d}"], *case) for i, case in enumerate(cases)]


def one(leads, **fields):
    return classified(leads, [(fields,)])[0][0]


KNOWN = (
    [(m, "Meeting Booked", "hot") for m in rules.EXACT_MEETING]
    + [(m, "Replied", "hot") for m in rules.EXACT_HOT]
    + [(m, "Replied", "warm") for m in rules.EXACT_WARM]
    + [(m, "Hold", "warm") for m in rules.EXACT_HOLD]
)


def test_every_known_message_has_its_meaning(spark):
    assert len(KNOWN) == 25
    rows = spark.createDataFrame([(m.upper(), s, r) for m, s, r in KNOWN], "last_inbound_text string, s string, r string")
    for row in classify.classify_messages(rows).collect():
        assert (row.meaning.stage, row.meaning.reply_type, row.meaning.layer) == (row.s, row.r, 1)


def test_phrases_in_order(spark):
    cases = [
        ("please stop messaging me on monday", "Lost", "cold", 2),
        ("maybe thursday", "Meeting Booked", "hot", 2),
        ("too busy, maybe", "Hold", "warm", 2),
        ("perhaps", "Replied", "warm", 2),
        ("any brochure?", "Replied", "hot", 2),
        ("no idea what this is about", "Replied", "hot", 3),
        (None, None, "amber", 0),
    ]
    rows = spark.createDataFrame([(m,) for m, *_ in cases], "last_inbound_text string")
    got = {r.last_inbound_text: tuple(r.meaning) for r in classify.classify_messages(rows).collect()}
    assert got == {message: tuple(meaning) for message, *meaning in cases}


def test_stage_reconciliation(leads):
    cases = [
        ({"stage": "won", "num_touches": "6", "est_monthly_spend_gbp": "£160"}, "Hold", True),
        ({"stage": "won", "num_touches": "2", "est_monthly_spend_gbp": "1000"}, "Won", False),
        ({"stage": "won", "last_inbound_text": "can you call back"}, "Replied", True),
        ({"stage": "won", "last_inbound_text": "thanks a lot"}, "Won", False),
        ({"stage": "lost", "last_inbound_text": "do you ship to EU"}, "Replied", True),
        ({"stage": "call-booked", "last_inbound_text": "Too busy this season, try later."}, "Hold", True),
        ({"stage": "new", "last_inbound_text": "maybe thursday"}, "Hold", True),
        ({"stage": "new", "last_inbound_text": "Owner is back next week, call then."}, "Hold", True),
        ({"stage": "hold", "last_inbound_text": "maybe"}, "Hold", False),
        ({"stage": "lost", "last_inbound_text": "unsubscribe"}, "Lost", False),
        ({"stage": "replied", "num_touches": "0"}, "New", True),
        ({"stage": "replied", "num_touches": "3"}, "Contacted", True),
        ({"stage": "negotiating"}, "New", True),
        ({"stage": "negotiating", "last_inbound_text": "hmm"}, "Replied", True),
        ({"stage": "new", "num_touches": "1"}, "Contacted", True),
        ({"stage": "new"}, "New", False),
        ({"stage": "lost", "num_touches": "1", "est_monthly_spend_gbp": "3000"}, "Hold", True),
        ({"stage": "lost", "num_touches": "5", "est_monthly_spend_gbp": "9000"}, "Lost", False),
        ({"stage": "lost", "num_touches": "4", "est_monthly_spend_gbp": "5000"}, "Hold", True),
        ({"stage": "lost", "num_touches": "4", "est_monthly_spend_gbp": "4999"}, "Lost", False),
        ({"stage": "lost", "last_inbound_text": "okay"}, "Hold", True),
        ({"stage": "lost", "last_inbound_text": "ok"}, "Lost", False),
        ({"stage": "contacted", "last_inbound_text": "who is this"}, "Replied", True),
        ({"stage": "contacted", "last_inbound_text": "ok"}, "Contacted", False),
        ({"stage": "call booked"}, "Meeting Booked", False),
    ]
    for row, fields, stage, overridden in classified(leads, cases):
        assert (row.stage, row.stage_overridden) == (stage, overridden), fields


def test_reply_types(leads):
    cases = [
        ({"num_touches": "0"}, "new", False),
        ({"num_touches": "0", "notes": "met"}, "amber", False),
        ({"num_touches": "1"}, "amber", False),
        ({"last_inbound_text": "perhaps", "stage": "won", "last_touch_date": "2026-06-01"}, "warm", False),
        ({"last_inbound_text": "whats your commission?", "last_touch_date": "2026-06-22"}, "hot", True),
        ({"last_inbound_text": "whats your commission?", "last_touch_date": "2026-06-23"}, "hot", False),
        ({"last_inbound_text": "whats your commission?", "last_touch_date": "2024-06-30"}, "hot", False),
        ({"last_inbound_text": "whats your commission?", "last_touch_date": "2026-07-20"}, "hot", False),
        ({"last_inbound_text": "unsubscribe", "last_touch_date": "2026-06-01"}, "cold", False),
    ]
    for row, fields, reply, overdue in classified(leads, cases):
        assert (row.reply_type, row.overdue) == (reply, overdue), fields


def test_lead_types(leads):
    cases = [
        ({"followers": "10", "city": "Leeds", "handle": "@ab"}, "hybrid"),
        ({"followers": "10", "handle": "@ab"}, "reseller"),
        ({"sales_velocity_30d": "3", "email": "a@b.com"}, "reseller_with_email"),
        ({"sales_velocity_30d": "3", "email": "a@@b.com"}, "reseller"),
        ({"followers": "0", "sales_velocity_30d": "nan", "handle": "@ab"}, "physical_shop"),
        ({"followers": "5", "handle": "@ab", "email": "x@shop.co.uk"}, "hybrid"),  # the mail moves it to London
    ]
    for row, fields, kind in classified(leads, cases):
        assert row.lead_type == kind, fields


def test_geography(leads):
    cases = [
        ({"email": "a@b.co.uk", "country": "US", "phone": "+1 (878) 1"}, "London", "UK", True),
        ({"email": "a@b.co.uk", "city": "leeds", "phone": "001-878"}, "leeds", "UK", True),
        ({"email": "a@b.co.uk", "country": "United Kingdom", "city": "York"}, "York", "United Kingdom", False),
        ({"store_name": "Camden Rail", "city": "Austin", "country": "US"}, "London", "UK", False),
        ({"store_name": "Leeds Brick Lane", "country": "UK", "phone": "+1 878"}, "London", "UK", False),
        ({"store_name": "Shop", "country": "uk"}, None, "uk", False),
    ]
    for row, fields, city, country, warned in classified(leads, cases, notes="seen"):
        assert (row.city, row.country) == (city, country), fields
        assert row.notes == (f"{rules.PHONE_COUNTRY_WARNING} seen" if warned else "seen"), fields


def test_warning_without_notes(leads):
    assert one(leads, email="a@b.co.uk", phone="+1 878").notes == rules.PHONE_COUNTRY_WARNING


def test_objections(leads):
    cases = [
        ("we already sell on vinted.", "misunderstanding"), ("already on another platform tbh", "platform"),
        ("too busy", "timing"), ("not interested right now", "soft_no"), ("maybe", "undecided"),
        ("not taking on new channels currently.", "channel_objection"), ("hello", "none"), (None, "none"),
    ]
    for row, fields, kind in classified(leads, [({"last_inbound_text": m}, k) for m, k in cases]):
        assert row.obj_type == kind, fields


def test_coarse_replies(spark):
    rows = spark.createDataFrame(
        [("STOP MESSAGING me",), ("yeah keen",), ("too busy",), ("hm",), (None,), ("nan",)], "last_inbound_text string"
    )
    got = [r.coarse.reply_type for r in classify.with_coarse_reply(rows).collect()]
    assert got == ["cold", "hot", "warm", "hot", "none", "none"]


def test_note_hints(spark):
    rows = spark.createDataFrame([("Big Menswear, met at market",), ("plain",), (None,)], "notes string")
    brand = rules.Brand(name="Acme")
    assert [r[0] for r in rows.select(classify.note_hints("notes", brand)).collect()] == [
        "Focus on menswear — Ralph Lauren, Carhartt, Levi's | Met at market — reference the meeting", "plain", "",
    ]


def test_priority_score_of_the_worked_example(spark):
    columns = "sales_velocity_30d, avg_listing_price_gbp, est_monthly_spend_gbp, followers, active_listings"
    rows = spark.sql(
        f"SELECT * FROM VALUES ('hot', 189, 30D, 9000D, 46640, 559), ('hot', 213, 33.3D, 1D, 65000, 559) "
        f"AS t(reply_type, {columns})"
    ).withColumn("num_touches", F.lit(0))
    scored = {r.est_monthly_spend_gbp: r.priority_score for r in queue.with_scores(rows).collect()}
    # 50 + 30 + 17.75 + 7.18 + 5 + 11.99
    assert scored[9000.0] == pytest.approx(121.9, abs=0.2)


def test_revenue_beats_volume(spark):
    rows = spark.sql("SELECT * FROM VALUES (200, 8D), (50, 65D) AS t(sales_velocity_30d, avg_listing_price_gbp)")
    got = queue.with_metrics(rows.withColumn("active_listings", F.lit(0))).collect()
    assert [r.combined_revenue for r in got] == [1600.0, 3250.0]


def test_cleaning_twice_changes_nothing(spark, leads):
    from leadloom.sources.fixtures import AS_OF as run_date
    from leadloom.sources.fixtures import raw_leads

    first = classified_leads(raw_leads(spark, "/root/testdata/sf0.001"), run_date)
    again = classified_leads(first.select(*[F.col(c).cast("string") for c in CLEAN_COLUMNS]), run_date)
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()


def test_what_the_typed_text_said_survives_a_second_cleaning(leads):
    rows = leads(
        {"lead_id": "A", "handle": "@a", "followers": "tbc", "stage": "warm"},
        {"lead_id": "B", "handle": "@b", "sales_velocity_30d": "0.0"},
        {"lead_id": "C", "handle": "@c", "followers": "0"},
    )
    once = classified_leads(rows, AS_OF)
    twice = classified_leads(once, AS_OF)
    assert {r.lead_id: r.lead_type for r in twice.collect()} == {"A": "reseller", "B": "reseller", "C": "physical_shop"}
    assert once.exceptAll(twice).isEmpty()


def test_additional_columns_keep_their_names_and_values(leads):
    own = {"_msg": "m", "reason": "r", "row_id": "i", "a.b`c": "odd", "_additional_": "x", "Overdue ": "y"}
    rows = leads({"lead_id": "A", "handle": "@a"}).withColumns({name: F.lit(value) for name, value in own.items()})
    for result in (classified_leads(rows, AS_OF), clean_leads(rows, AS_OF)):
        assert result.columns == [*CLEAN_COLUMNS, *own]
        assert list(result.first())[len(CLEAN_COLUMNS):] == list(own.values())


def test_a_computed_column_of_the_input_is_computed_anew(leads):
    rows = leads({"lead_id": "A", "handle": "@a"}).withColumns({"lead_type": F.lit("x"), "overdue": F.lit("x")})
    first = classified_leads(rows, AS_OF).first()
    assert (first.lead_type, first.overdue) == ("physical_shop", False)
