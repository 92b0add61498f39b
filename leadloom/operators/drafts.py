"""Drafted messages: template choice and filling as one projection.

Works on clean leads, where missing texts are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.functions import text
from leadloom.functions.logic import contains_any, fill, fill_picked, first_match, pick

SILENT_REPLIES = ("new", "amber", "none")
DIRECT_MESSAGE, EMAIL = "dm", "email"

RESELLER_MESSAGE_COLUMNS = (
    "lead_id", "handle", "contact_name", "stage", "last_inbound_text", "reply_type", "obj_type",
    "priority_score", "why_today", "drafted_message", "next_action", "follow_up_date", "channel",
    "lead_type", "email", "lead_category",
)
SHOP_MESSAGE_COLUMNS = (
    "lead_id", "store_name", "contact_name", "email", "phone", "city", "country", "stage",
    "reply_type", "last_inbound_text", "recommended_action", "drafted_message", "next_action",
    "follow_up_date", "channel", "est_monthly_spend_gbp", "lead_category",
)


def day_mentioned(message: str, whole_words: bool = False) -> Column:
    """Weekday named in a column of lower-case messages.

    By default a word counts anywhere, so "mon" is found in "month"; with
    ``whole_words`` it must stand alone.
    """
    return first_match(
        (contains_any(message, [word], whole_words), day) for word, day in rules.DAY_WORDS.items()
    )


def usable_email(literal: bool = False) -> Column:
    """The address unless it is flagged as broken; ``literal`` takes the text as it is."""
    return F.col("email") if literal else F.when(~F.col("email").startswith(text.INVALID), F.col("email"))


def with_known_contact(leads: DataFrame, literal_emails: bool = False) -> DataFrame:
    """Add ``known_contact`` (e-mail, phone or e-mail in notes) and ``message_category``."""
    active = F.col("reply_type").isin("hot", "warm")
    return leads.withColumns(
        {
            "known_contact": F.coalesce(usable_email(literal_emails), F.col("phone"), text.email_in_text("notes")),
            "message_category": F.when(active, 2).otherwise(1),
        }
    )


def contact_line(email: str = "email") -> Column:
    """Sentence that sends the details to a known address or asks for one."""
    return first_match(
        [
            (F.col(email).isNotNull(), fill(rules.CONTACT_LINES["email"], email=email)),
            (F.col("phone").isNotNull(), fill(rules.CONTACT_LINES["phone"], phone="phone")),
        ],
        rules.CONTACT_LINES["ask"],
    )


def cold_hook() -> Column:
    notes = F.lower(F.coalesce("notes", F.lit("")))
    return first_match(((notes.contains(word), hook) for word, hook in rules.HOOKS.items()), rules.HOOK_DEFAULT)


def greeting(channel: str) -> Column:
    name = F.coalesce("contact_name", "handle", "store_name", F.lit("there"))
    if channel == DIRECT_MESSAGE:
        return F.concat(F.lit("Hey @"), F.coalesce(F.col("handle"), name))
    return F.concat(F.lit("Hi "), name)


def meeting_greeting(channel: str) -> Column:
    """Meeting texts address the bare handle, or nobody if the name is unknown."""
    if channel == DIRECT_MESSAGE:
        return F.concat(F.lit("Hey @"), F.coalesce("handle", F.lit("")))
    name = F.coalesce("contact_name", "handle", "store_name")
    return F.coalesce(F.concat(F.lit("Hi "), name), F.lit("Hi"))


def _templates(channel: str, whole_words: bool) -> list[tuple[Column, str, tuple[str, str, str]]]:
    """(condition, name, (message, next action, follow-up)) in the order they are tried."""
    stage, reply, message = F.col("stage"), F.col("reply_type"), F.col("_said")
    known = F.col("_contact").isNotNull()
    booked = stage == "Meeting Booked"
    day, opened, vague = (rules.MEETING_DRAFTS[name] for name in ("day", "open", "vague"))
    cases = [
        (reply == "cold", "hard_no", rules.HARD_NO_DRAFT),
        (booked & F.col("_day").isNotNull(), "meeting_day", day),
        (booked & (message.contains("when") | message.contains("sounds good")), "meeting_open", opened),
        (booked, "meeting_vague", vague),
        (F.coalesce(reply.isin(*SILENT_REPLIES), F.lit(True)), "cold", rules.COLD_DRAFTS[channel]),
    ]
    other_tests = {"hot": reply == "hot", "hold": stage == "Hold", "default": F.lit(True)}
    for name, phrases, if_known, if_unknown, action, follow_up in rules.CONVERSATION_DRAFTS:
        test = other_tests[name] if phrases is None else contains_any("_said", phrases, whole_words)
        if if_unknown is not None:
            cases.append((test & known, name, (if_known, action, follow_up)))
        cases.append((test, name, (if_unknown or if_known, action, follow_up)))
    return cases


def with_draft(
    leads: DataFrame,
    channel: str,
    brand: rules.Brand = rules.Brand(),
    whole_words: bool = False,
    literal_emails: bool = False,
) -> DataFrame:
    """Add drafted_message, next_action, follow_up_date and template.

    An address that is flagged as broken is not written to, unless ``literal_emails``.

    Each row first gets the number of its template; the texts are then picked and
    filled.  City, phone and store name are optional columns.
    """
    for name in ("city", "phone", "store_name"):
        if name not in leads.columns:
            leads = leads.withColumn(name, F.lit(None).cast("string"))
    prepared = leads.withColumns(
        {
            "_said": F.lower(F.coalesce("last_inbound_text", F.lit(""))),
            "_email": usable_email(literal_emails),
            "_contact": F.coalesce(usable_email(literal_emails), "phone"),
            "_meeting": F.coalesce(F.col("stage") == "Meeting Booked", F.lit(False)),
        }
    ).withColumn("_day", day_mentioned("_said", whole_words))
    cases = _templates(channel, whole_words)
    numbered = prepared.withColumn(
        "_number", first_match(((test, number) for number, (test, _, _) in enumerate(cases)))
    )
    texts, actions, follow_ups = zip(*[result for _, _, result in cases], strict=True)
    values = {
        "greeting": F.when(F.col("_meeting"), meeting_greeting(channel)).otherwise(greeting(channel)),
        "contact_line": contact_line("_email"),
        "contact": "_contact",
        "day": "_day",
        "hook": cold_hook(),
        "subject": F.coalesce("store_name", "city", F.lit("your store")),
        "store": F.coalesce("store_name", F.lit("your store")),
        "city": F.coalesce("city", F.lit("your area")),
    }
    used = {name: value for name, value in values.items() if any("{" + name + "}" in t for t in texts)}
    return numbered.withColumns(
        {
            "drafted_message": fill_picked([brand.apply(t) for t in texts], "_number", **used),
            "next_action": fill_picked(actions, "_number", day="_day"),
            "follow_up_date": pick(follow_ups, "_number"),
            "template": pick([name for _, name, _ in cases], "_number"),
        }
    ).drop("_said", "_email", "_contact", "_meeting", "_day", "_number")


def reseller_messages(queue: DataFrame, brand: rules.Brand = rules.Brand()) -> DataFrame:
    drafted = with_draft(queue, DIRECT_MESSAGE, brand).withColumns(
        {"channel": F.lit("Instagram DM"), "lead_category": F.lit("Online Reseller")}
    )
    return drafted.select(*[c for c in RESELLER_MESSAGE_COLUMNS if c in drafted.columns])


def shop_messages(planned_shops: DataFrame, brand: rules.Brand = rules.Brand()) -> DataFrame:
    """Drafts for every shop that is not a customer yet."""
    open_shops = planned_shops.where(F.coalesce("stage", F.lit("New")) != "Won")
    drafted = with_draft(open_shops, EMAIL, brand).withColumns(
        {"channel": F.lit("Email"), "lead_category": F.lit("Physical Shop")}
    )
    return drafted.select(*[c for c in SHOP_MESSAGE_COLUMNS if c in drafted.columns])


def todays_messages(
    queue: DataFrame, planned_shops: DataFrame, brand: rules.Brand = rules.Brand()
) -> DataFrame:
    """One action list of reseller and shop drafts."""
    return reseller_messages(queue, brand).unionByName(
        shop_messages(planned_shops, brand), allowMissingColumns=True
    )


def action_summary(messages: DataFrame) -> DataFrame:
    """Actions by category and reply type with subtotals and the grand total (``all``)."""
    return (
        messages.rollup("lead_category", "reply_type")
        .agg(
            F.count(F.lit(1)).alias("actions"),
            F.grouping("lead_category").alias("_all"),
            F.grouping("reply_type").alias("_sub"),
        )
        .select(
            F.when(F.col("_all") == 1, "all").otherwise(F.col("lead_category")).alias("lead_category"),
            F.when(F.col("_sub") == 1, "all").otherwise(F.col("reply_type")).alias("reply_type"),
            "actions",
        )
    )
