"""Lead type, message meaning, stage reconciliation, reply type and objection.

All rules are ordered: the first that applies decides.  Message tests are put in
columns of their own first, because several rules share them.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.functions import text
from leadloom.functions.logic import ColumnLike, as_column, contains_any, first_match, pick, shortest
from leadloom.operators.phrases import rule_table, with_first_rule

OVERDUE_AFTER_DAYS = 7
OVERDUE_UNTIL_DAYS = 730

UNKNOWN_LAYER = 3

# (exact messages, stage, reply type) and (column, phrases, stage, reply type), in
# the order the meanings are tried.
EXACT_MEANINGS = (
    (rules.EXACT_MEETING, "Meeting Booked", "hot"),
    (rules.EXACT_HOT, "Replied", "hot"),
    (rules.EXACT_WARM, "Replied", "warm"),
    (rules.EXACT_HOLD, "Hold", "warm"),
    (rules.EXACT_LOST, "Lost", "cold"),
)
PHRASE_MEANINGS = (
    ("_lost", rules.LOST_PHRASES, "Lost", "cold"),
    ("_meeting", rules.MEETING_PHRASES, "Meeting Booked", "hot"),
    ("_hold", rules.HOLD_PHRASES, "Hold", "warm"),
    ("_warm", rules.WARM_PHRASES, "Replied", "warm"),
    ("_hot", rules.HOT_PHRASES, "Replied", "hot"),
)
# (stage, reply type, deciding layer) by meaning number; 0 is "no message" and the
# last one "no rule knows this message".
MEANINGS = (
    (None, "amber", 0),
    *[(stage, reply, 1) for _, stage, reply in EXACT_MEANINGS],
    *[(stage, reply, 2) for _, _, stage, reply in PHRASE_MEANINGS],
    ("Replied", "hot", UNKNOWN_LAYER),
)


def lead_type(
    has_metrics: ColumnLike,
    has_place: ColumnLike | None,
    has_handle: ColumnLike | None,
    has_email: ColumnLike,
) -> Column:
    """``hybrid``, ``reseller_with_email``, ``reseller`` or ``physical_shop``.

    Without place and handle no lead is a hybrid.
    """
    metrics = as_column(has_metrics)
    cases = [
        (metrics & as_column(has_email), "reseller_with_email"),
        (metrics, "reseller"),
    ]
    if has_place is not None and has_handle is not None:
        cases.insert(0, (metrics & as_column(has_place) & as_column(has_handle), "hybrid"))
    return first_match(cases, "physical_shop")


def classify_lead_type(
    leads: DataFrame, allow_hybrid: bool = True, require_valid_email: bool = True
) -> DataFrame:
    def present(name: str) -> Column:
        return F.col(name).isNotNull()

    email = present("email") & F.col("email_valid") if require_valid_email else present("email")
    place = present("city") | present("store_name")
    return leads.withColumn(
        "lead_type",
        lead_type(
            F.col("has_metrics"),
            place if allow_hybrid else None,
            present("handle") if allow_hybrid else None,
            email,
        ),
    )


def with_message_signals(leads: DataFrame, message: str = "last_inbound_text") -> DataFrame:
    """Add ``_msg`` and one boolean per meaning, null where there is no message."""
    out = leads.withColumn("_msg", text.message_text(message))
    return out.withColumns({name: contains_any("_msg", phrases) for name, phrases, _, _ in PHRASE_MEANINGS})


def meaning_number() -> Column:
    """Position in ``MEANINGS``; needs the message signals."""
    tests = [F.col("_msg").isNull()]
    tests += [F.col("_msg").isin(*texts) if texts else F.lit(False) for texts, _, _ in EXACT_MEANINGS]
    tests += [F.col(name) for name, *_ in PHRASE_MEANINGS]
    return first_match(((test, number) for number, test in enumerate(tests)), len(MEANINGS) - 1)


def message_meaning(number: ColumnLike) -> Column:
    """Struct of stage, reply type and layer (0 none, 1 whole message, 2 phrase, 3 unknown)."""
    stages, replies, layers = zip(*MEANINGS, strict=True)
    return F.struct(
        pick(stages, number).alias("stage"),
        pick(replies, number).alias("reply_type"),
        pick(layers, number).alias("layer"),
    )


def classify_messages(leads: DataFrame, message: str = "last_inbound_text") -> DataFrame:
    """Add ``meaning`` to every row."""
    numbered = with_message_signals(leads, message).withColumn("_number", meaning_number())
    return numbered.withColumn("meaning", message_meaning("_number")).drop("_number")


def meaning_rules(spark: SparkSession) -> DataFrame:
    """The built-in lists as a rule table; rule 0 is position 1 in ``MEANINGS``."""
    cases = [(texts, True) for texts, _, _ in EXACT_MEANINGS]
    return rule_table(spark, cases + [(phrases, False) for _, phrases, _, _ in PHRASE_MEANINGS])


def classify_messages_by(leads: DataFrame, rule_rows: DataFrame, outcomes: DataFrame, message: str = "last_inbound_text") -> DataFrame:
    """Add ``meaning`` by a rule table and the table of what its rules mean.

    ``outcomes`` has one row for each ``rule``: ``stage``, ``reply_type`` and ``layer``;
    messages that no rule knows, and missing ones, get the built-in outcomes.
    """
    known = outcomes.select("rule", F.struct("stage", "reply_type", "layer").alias("_known"))
    numbered = with_first_rule(leads.withColumn("_msg", text.message_text(message)), "_msg", rule_rows, "_rule")
    unknown = F.when(F.col("_msg").isNull(), message_meaning(F.lit(0))).otherwise(message_meaning(F.lit(len(MEANINGS) - 1)))
    out = numbered.join(known, F.col("_rule") == F.col("rule"), "left")
    kept = [F.col(f"`{c}`") for c in leads.columns if c != "meaning"]
    return out.select(*kept, F.coalesce("_known", unknown).alias("meaning"))


def unclassified_messages(leads: DataFrame, message: str = "last_inbound_text") -> DataFrame:
    """Distinct messages no rule knows, with how often they occur."""
    return (
        classify_messages(leads, message)
        .where(F.col("meaning.layer") == UNKNOWN_LAYER)
        .groupBy(F.col("_msg").alias("message"))
        .agg(F.count(F.lit(1)).alias("leads"))
    )


def reconciled_stage() -> Column:
    """The stage the evidence supports.

    The last message beats the entered stage.  Here wait-and-see phrases beat
    meeting phrases, unlike in ``meaning_number``; both orders are intended.  The
    known whole messages take part as phrases.
    """
    msg, stage = F.col("_msg"), F.col("stage")
    touches = F.coalesce(F.col("num_touches"), F.lit(0))
    spend = F.coalesce(F.col("est_monthly_spend_gbp"), F.lit(0.0))
    silent, long_message = msg.isNull(), F.length(msg) > 3
    no_reply = silent & stage.isin("Replied", "Warm", "Negotiating")

    def signal(signals: list[str], whole: list[str], phrases: list[str]) -> Column:
        return reduce(or_, [F.col(s) for s in signals], contains_any("_msg", shortest(whole, covered_by=phrases)))

    return first_match(
        [
            (F.col("_lost"), "Lost"),
            (
                signal(
                    ["_hold", "_warm"],
                    rules.EXACT_HOLD + rules.EXACT_WARM,
                    rules.HOLD_PHRASES + rules.WARM_PHRASES,
                ),
                "Hold",
            ),
            (signal(["_meeting"], rules.EXACT_MEETING, rules.MEETING_PHRASES), "Meeting Booked"),
            (signal(["_hot"], rules.EXACT_HOT, rules.HOT_PHRASES), "Replied"),
            (no_reply & (touches == 0), "New"),
            (no_reply, "Contacted"),
            (silent & (stage == "New") & (touches > 0), "Contacted"),
            (silent & (stage == "Won") & ((spend < 1000) | (touches < 2)), "Hold"),
            ((stage == "Won") & contains_any("_msg", rules.WON_FOLLOW_UP_PHRASES), "Replied"),
            (stage == "Negotiating", "Replied"),
            (silent & (stage == "Lost") & (touches <= 1) & (spend >= 3000), "Hold"),
            (silent & (stage == "Lost") & (touches <= 4) & (spend >= 5000), "Hold"),
            ((stage == "Lost") & long_message, "Hold"),
            ((stage == "Contacted") & long_message, "Replied"),
        ],
        stage,
    )


def reconcile_stages(leads: DataFrame) -> DataFrame:
    """Replace ``stage`` and add ``stage_overridden``; needs the message signals.

    Every rule that keeps a stage returns it unchanged, so a stage was overridden
    exactly if it differs, or if an earlier cleaning overrode it.
    """
    before = F.col("_stage_overridden") if "_stage_overridden" in leads.columns else F.lit(None)
    differs = F.col("_evidence") != F.col("stage")
    return leads.withColumn("_evidence", reconciled_stage()).withColumns(
        {"stage": F.col("_evidence"), "stage_overridden": differs | F.coalesce(before, F.lit(False))}
    ).drop("_evidence", "_stage_overridden")


def waited_too_long(as_of: date) -> Column:
    """Last touch more than a week and less than two years ago, outside Hold."""
    days = text.days_since("last_touch_date", as_of)
    return F.coalesce(
        (F.col("stage") != "Hold") & (days > OVERDUE_AFTER_DAYS) & (days < OVERDUE_UNTIL_DAYS), F.lit(False)
    )


def classify_replies(leads: DataFrame, as_of: date) -> DataFrame:
    """Add ``reply_type`` and ``overdue``; needs the message signals and the final stage.

    An overdue hot or warm lead becomes hot.  ``overdue`` itself orders nothing
    unless the daily list is asked for it.
    """
    touches = F.coalesce(F.col("num_touches"), F.lit(0))
    untouched = (touches == 0) & F.col("notes").isNull()
    replies = [reply for _, reply, _ in MEANINGS]
    overdue = F.col("_reply").isin("hot", "warm") & F.col("_waited")
    return (
        leads.withColumns({"_reply": pick(replies, meaning_number()), "_waited": waited_too_long(as_of)})
        .withColumn("overdue", overdue)
        .withColumn(
            "reply_type",
            first_match(
                [(F.col("_msg").isNull() & untouched, "new"), (F.col("overdue"), "hot")], F.col("_reply")
            ),
        )
        .drop("_reply", "_waited")
    )


def objection_type(message: str) -> Column:
    """Objection behind a column of normalised messages, ``none`` if there is none."""
    return first_match(
        ((contains_any(message, phrases), kind) for kind, phrases in rules.OBJECTION_PHRASES.items()), "none"
    )


def with_coarse_reply(leads: DataFrame, message: str = "last_inbound_text") -> DataFrame:
    """Four-field reading of a message by three short phrase lists."""
    kinds = list(rules.COARSE_OUTCOMES)
    fields = ("reply_type", "follow_up_timing", "objection_type", "recommended_response")
    tests = [
        text.blank_to_null(message).isNull(),
        contains_any("_said", rules.COARSE_HARD_NO),
        contains_any("_said", rules.COARSE_BUYING),
        contains_any("_said", rules.COARSE_OBJECTION),
    ]
    numbered = leads.withColumn("_said", F.lower(message)).withColumn(
        "_number", first_match(((test, i) for i, test in enumerate(tests)), kinds.index("unclear"))
    )
    answers = zip(*rules.COARSE_OUTCOMES.values(), strict=True)
    return numbered.withColumn(
        "coarse", F.struct(*[pick(a, "_number").alias(f) for f, a in zip(fields, answers, strict=True)])
    ).drop("_said", "_number")


def note_hints(notes: ColumnLike, brand: rules.Brand = rules.Brand()) -> Column:
    """Personalisation hints found in the notes, or the notes themselves."""
    lowered = F.lower(as_column(notes))
    hints = F.concat_ws(
        " | ", *[F.when(lowered.contains(word), brand.apply(hint)) for word, hint in rules.NOTE_HINTS.items()]
    )
    return F.coalesce(F.when(hints != "", hints), text.blank_to_null(notes), F.lit(""))


def classify_leads(leads: DataFrame, as_of: date) -> DataFrame:
    """Lead type, reconciled stage, reply type, overdue flag and objection."""
    typed = with_message_signals(classify_lead_type(leads))
    replied = classify_replies(reconcile_stages(typed), as_of)
    signals = [name for name, *_ in PHRASE_MEANINGS]
    return replied.withColumn("obj_type", objection_type("_msg")).drop("_msg", *signals)

