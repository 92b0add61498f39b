from datetime import date

import pytest

from leadloom import rules
from leadloom.operators import city, drafts, queue, shops
from leadloom.plans.clean import classified_leads
from leadloom.sources.fixtures import AS_OF, raw_leads
from leadloom.sources.tables import no_confirmations

RUN = date(2026, 6, 30)
BRAND = rules.Brand(name="Acme", grading="AcmeGrade", sender="Kim")


@pytest.fixture(scope="module")
def clean(spark):
    return classified_leads(raw_leads(spark, "/root/testdata/sf0.01"), AS_OF).cache()


def test_the_list_respects_capacity_and_tiers(clean):
    for capacity in (0, 7, 40):
        rows = queue.daily_queue(clean, capacity=capacity).orderBy("priority_rank").collect()
        assert [r.priority_rank for r in rows] == list(range(1, capacity + 1))
        tiers = [list(rules.SLOT_TYPE.values()).index(r.slot_type) for r in rows]
        assert tiers == sorted(tiers)
        assert len({r.lead_id for r in rows}) == capacity


def test_the_whole_pool_has_one_row_per_lead(clean):
    rows = queue.daily_queue(clean, capacity=100_000).collect()
    assert len(rows) == len({r.lead_id for r in rows}) == queue.queue_candidates(clean).count()


def test_overdue_leads_may_be_put_first(clean):
    rows = queue.daily_queue(clean, capacity=100_000, overdue_first=True).orderBy("priority_rank").collect()
    late = {r.lead_id for r in clean.where("overdue").collect()}
    flags = [r.lead_id in late for r in rows if r.reply_type != "meeting_confirmation"]
    assert flags == sorted(flags, reverse=True) and any(flags)


def test_queue_plan_takes_the_best_rows_of_each_task(clean):
    plan = queue.daily_queue(clean)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_no_confirmation_no_visit(spark, clean):
    visits = shops.confirmed_visits(shops.plan_shops(clean), no_confirmations(spark))
    assert visits.count() == 0 and visits.columns[-1] == "appointment_confirmed"


def draft(leads, channel="dm", **fields):
    rows = classified_leads(leads({"lead_id": "L1", **fields}), RUN)
    return drafts.with_draft(rows, channel, BRAND).first()


def test_templates(leads):
    cases = [
        ({"last_inbound_text": "how does payout work"}, "payout", "today"),
        ({"last_inbound_text": "do you ship to eu?"}, "shipping", "today"),
        ({"last_inbound_text": "do you take menswear too"}, "brands", "today"),
        ({"last_inbound_text": "send me the bundle list"}, "bundle", "today"),
        ({"last_inbound_text": "yeah keen, drop details"}, "hot", "today"),
        ({"last_inbound_text": "we already sell on vinted."}, "misunderstanding", "today"),
        ({"last_inbound_text": "already on another platform tbh"}, "platform", "today"),
        ({"last_inbound_text": "maybe next month"}, "timing", "30_days"),
        ({"last_inbound_text": "not interested right now"}, "soft_no", "30_days"),
        ({"last_inbound_text": "need to think about it"}, "hold", "14_days"),
        ({"last_inbound_text": "unsubscribe"}, "hard_no", "never"),
        ({"last_inbound_text": "can you do a call fri?"}, "meeting_day", "today"),
        ({"last_inbound_text": "ok sounds good when can we talk"}, "meeting_open", "today"),
        ({"last_inbound_text": "mornings best"}, "meeting_vague", "today"),
        ({"num_touches": "0"}, "cold", "7_days"),
    ]
    rows = [{"handle": "@cinder", **fields, "lead_id": f"L{i:03d}"} for i, (fields, *_) in enumerate(cases)]
    drafted = drafts.with_draft(classified_leads(leads(*rows), RUN), "dm", BRAND).orderBy("lead_id").collect()
    for row, (fields, template, follow_up) in zip(drafted, cases, strict=True):
        assert (row.template, row.follow_up_date) == (template, follow_up), fields
        assert "{" not in row.drafted_message and "\\x02" not in row.drafted_message


def test_known_contact_is_used(leads):
    row = draft(leads, handle="cinder", last_inbound_text="how does payout work", email="a@b.com", phone="1")
    assert row.drafted_message.startswith("Hey @cinder, great question")
    assert row.drafted_message.endswith("BNPL up to 45 days with no interest. I'll get that sent straight over to a@b.com now.")
    row = draft(leads, handle="cinder", last_inbound_text="do you ship to eu?", phone="0712")
    assert row.drafted_message.endswith("I can send the full shipping breakdown to 0712 beforehand.")


def test_a_broken_address_is_not_written_to(leads):
    lead = {"handle": "cinder", "last_inbound_text": "how does payout work", "email": "bad-address"}
    row = draft(leads, **lead)
    assert "INVALID" not in row.drafted_message and row.drafted_message.endswith("send that straight over to?")
    assert "on 0712 now" in draft(leads, **lead, phone="0712").drafted_message
    rows = classified_leads(leads({"lead_id": "L1", **lead}), RUN)
    assert "INVALID: bad-address" in drafts.with_draft(rows, "dm", BRAND, literal_emails=True).first().drafted_message
    assert drafts.with_known_contact(rows).first().known_contact is None


def test_cold_email_has_a_subject(leads):
    row = draft(leads, "email", contact_name="Maya", store_name="Rust", city="Leeds", num_touches="1")
    assert row.drafted_message.startswith("Subject: Wholesale sourcing for Rust\n\nHi Maya,\n\nI came across Rust in Leeds")
    assert row.drafted_message.endswith("\n\nKim") and "AcmeGrade categorised" in row.drafted_message


def test_cold_direct_message_hook(leads):
    assert "love your menswear curation" in draft(leads, handle="x1", notes="Menswear").drafted_message


def test_meeting_greetings(leads):
    assert draft(leads, last_inbound_text="mornings best", contact_name="Bo").drafted_message.startswith("Hey @, looking")
    assert draft(leads, "email", last_inbound_text="mornings best").drafted_message.startswith("Hi, looking")


def test_weekday_as_whole_word(leads):
    rows = classified_leads(leads({"lead_id": "L1", "stage": "call booked", "last_inbound_text": "in a month"}), RUN)
    assert drafts.with_draft(rows, "dm").first().template == "meeting_day"  # "mon" in "month"
    assert drafts.with_draft(rows, "dm", whole_words=True).first().template == "meeting_vague"


def test_hybrids_can_take_part_in_city_scores(clean):
    plain = city.scored_shops(clean).count()
    with_hybrids = city.scored_shops(clean, include_hybrid=True, hybrid_boost=1.3)
    assert with_hybrids.count() > plain
    assert with_hybrids.where("lead_type = 'hybrid' AND stage = 'Contacted'").first().visit_score == pytest.approx(
        1.3 * with_hybrids.where("lead_type = 'hybrid' AND stage = 'Contacted'").first().est_monthly_spend_gbp
    )
