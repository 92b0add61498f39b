"""One query per operator, each with the SQL that must give the same rows.

``ENTRIES`` maps a name to (function of session and table folder, SQL or None).
Every query reads the whole given tables.  The clean table is written once per
session to the shared folder and read back by the later steps, as in daily use.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.functions import keys, text
from leadloom.operators import batch, city, classify, drafts, geo, identity, incremental, normalise, phrases, queue, report, shops
from leadloom.operators.ranking import with_position
from leadloom.plans import clean as clean_plan
from leadloom.schema import RAW_COLUMNS, SHOP_COLUMNS
from leadloom.session import cut_lineage, scratch_path
from leadloom.sources import fixtures, key_index, tables
from leadloom.streaming.confirm import confirmed_stream, write_confirmed
from leadloom.streaming.ingest import ingest_stream, load_batch
from leadloom.streaming.keyed import ingest_keyed
from oracles import tables as sql
from oracles.tables import query

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = fixtures.AS_OF
ENTRIES: dict[str, tuple[Query, str | None]] = {}
_written: dict[tuple[str, str], str] = {}


def entry(name: str, oracle: str | None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        ENTRIES[name] = (function, oracle)
        return function

    return register


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.raw_leads(spark, folder)


def repaired(spark: SparkSession, folder: str) -> DataFrame:
    return geo.repair_geography(normalise.normalise_leads(raw(spark, folder), AS_OF))


def clean(spark: SparkSession, folder: str) -> DataFrame:
    """The clean table, written by the first query that needs it."""
    key = (spark.sparkContext.applicationId, folder)
    if key in _written:
        try:
            return spark.read.parquet(_written[key])
        except AnalysisException:  # the shared folder was cleaned meanwhile
            del _written[key]
    path = scratch_path(spark, "clean")
    tables.write_leads(clean_plan.clean_leads(raw(spark, folder), AS_OF), path)
    _written[key] = path
    return spark.read.parquet(path)


def checked(spark: SparkSession, folder: str) -> DataFrame:
    return batch.check_batch(fixtures.day2_batch(spark, folder), clean(spark, folder))


def fresh(spark: SparkSession, folder: str) -> DataFrame:
    return batch.clean_new_leads(batch.new_rows(checked(spark, folder)), AS_OF)


# --- Sources and sinks -------------------------------------------------------


@entry("read_leads_csv", query(f"SELECT {sql.RAW_COLUMNS} FROM raw_leads", "raw_leads"))
def read_leads_csv(spark, folder):
    path = scratch_path(spark, "csv")
    tables.write_leads(raw(spark, folder), path, "csv")
    return tables.read_leads(spark, path, "csv")


@entry("read_leads_parquet", query(f"SELECT {sql.RAW_COLUMNS} FROM raw_leads", "raw_leads"))
def read_leads_parquet(spark, folder):
    path = scratch_path(spark, "parquet")
    tables.write_leads(raw(spark, folder), path)
    return tables.read_leads(spark, path)


@entry(
    "source_preference",
    query(
        f"SELECT 'first load' AS origin, {sql.RAW_COLUMNS} FROM raw_leads "
        f"UNION ALL SELECT 'base', {sql.RAW_COLUMNS} FROM day2_batch",
        "raw_leads", "day2_batch",
    ),
)
def source_preference(spark, folder):
    base, first = scratch_path(spark, "base"), scratch_path(spark, "first")
    tables.write_leads(raw(spark, folder), first, "csv")
    without_base = tables.read_source(spark, base, first)
    tables.append_to_base(fixtures.day2_batch(spark, folder), base, tables.FIRST_LOAD)
    with_base = tables.read_source(spark, base, first)
    return without_base.select(F.lit("first load").alias("origin"), *RAW_COLUMNS).unionByName(
        with_base.select(F.lit("base").alias("origin"), *RAW_COLUMNS)
    )


@entry("overwrite_output", query(f"SELECT {sql.RAW_COLUMNS} FROM day2_batch", "day2_batch"))
def overwrite_output(spark, folder):
    path = scratch_path(spark, "output")
    tables.write_leads(raw(spark, folder), path)
    tables.write_leads(fixtures.day2_batch(spark, folder), path)
    return spark.read.parquet(path)


DIVIDED_LINES = query(
    "SELECT 'lead' AS read_as, lead_id, handle, contact_name, city, NULL::VARCHAR AS line FROM raw_leads "
    "WHERE lead_id IS NULL OR right(lead_id, 1) <> '7' "
    "UNION ALL SELECT 'line', NULL, NULL, NULL, NULL, lead_id || ',h,c,Rome,' || lead_id FROM raw_leads WHERE right(lead_id, 1) = '7'",
    "raw_leads",
)


@entry("quarantined_lines", DIVIDED_LINES)
def quarantined_lines(spark, folder):
    """Every lead whose id ends in 7 is written with a field too many: it is kept aside as it was typed."""
    path = scratch_path(spark, "lines")
    leads = raw(spark, folder).select("lead_id", "handle", "contact_name", "city")
    odd = F.coalesce(F.col("lead_id").endswith("7"), F.lit(False))
    tables.write_leads(leads.where(~odd).coalesce(4), f"{path}/in/whole", "csv")
    lines = leads.where(odd).select(F.concat("lead_id", F.lit(",h,c,Rome,"), "lead_id").alias("value"))
    header = spark.createDataFrame([("lead_id,handle,contact_name,city",)], "value string")
    header.unionByName(lines).coalesce(1).write.text(f"{path}/in/odd")
    found = tables.read_leads_csv(spark, f"{path}/in/*", quarantine_path=f"{path}/aside")
    return found.select(F.lit("lead").alias("read_as"), "lead_id", "handle", "contact_name", "city", F.lit(None).cast("string").alias("line")).unionByName(
        spark.read.parquet(f"{path}/aside").select(F.lit("line").alias("read_as"), "line"), allowMissingColumns=True
    )


@entry(
    "dated_outputs",
    query(
        f"SELECT DATE '2026-06-29' AS run_date, lead_id, handle FROM raw_leads "
        "UNION ALL SELECT DATE '2026-06-30', lead_id, handle FROM day2_batch",
        "raw_leads", "day2_batch",
    ),
)
def dated_outputs(spark, folder):
    """Two days of one output; the second is written twice, with other rows first."""
    path = scratch_path(spark, "dated")
    days = (("2026-06-29", raw), ("2026-06-30", raw), ("2026-06-30", fixtures.day2_batch))
    for day, rows in days:
        tables.write_dated(rows(spark, folder).select("lead_id", "handle"), path, date.fromisoformat(day))
    schema = raw(spark, folder).select("lead_id", "handle").schema
    return tables.read_dated(spark, path, schema).where(F.col("run_date") >= "2026-06-01")


APPENDED = query(
    f"SELECT 'first_load' AS batch_id, {sql.CLEAN_COLUMNS}, NULL::VARCHAR AS personalisation_signals FROM clean "
    f"UNION ALL SELECT 'day2', {sql.CLEAN_COLUMNS}, personalisation_signals FROM fresh_clean",
    "clean", "fresh_clean",
)


@entry("append_to_base", APPENDED)
def append_to_base(spark, folder):
    base = scratch_path(spark, "base")
    tables.append_to_base(clean(spark, folder), base, tables.FIRST_LOAD)
    new = fresh(spark, folder)
    tables.append_to_base(new, base, "day2")
    tables.append_to_base(new, base, "day2")  # a repeat must add nothing
    return tables.read_base(spark, base)


@entry("compacted_base", APPENDED)
def compacted_base(spark, folder):
    """Small batches are gathered; one is loaded again with other rows first, and gathered again."""
    base = scratch_path(spark, "base")
    tables.append_to_base(clean(spark, folder), base, tables.FIRST_LOAD)
    new = fresh(spark, folder)
    tables.append_to_base(new.limit(0), base, "day2")
    tables.compact_base(spark, base)
    tables.append_to_base(new.limit(7), base, "day2")
    tables.compact_base(spark, base)
    tables.append_to_base(new, base, "day2")
    return tables.read_base(spark, base)


# --- Scalar normalisation ----------------------------------------------------

ENTRIES["blank_to_null"] = (
    lambda spark, folder: raw(spark, folder).select(*[text.blank_to_null(c).alias(c) for c in RAW_COLUMNS]),
    query(f"SELECT {', '.join(f'{sql.blank(c)} AS {c}' for c in RAW_COLUMNS)} FROM raw_leads", "raw_leads"),
)
ENTRIES["clean_handle"] = (
    lambda spark, folder: raw(spark, folder).select(
        "lead_id", text.clean_handle("handle").alias("handle"), keys.handle_key("handle").alias("handle_key")
    ),
    query(
        f"SELECT lead_id, coalesce({sql.handle('handle')}, '') AS handle, "
        f"CASE WHEN length({sql.handle('handle')}) > 1 THEN {sql.handle('handle')} END AS handle_key FROM raw_leads",
        "raw_leads",
    ),
)
ENTRIES["clean_stage"] = (
    lambda spark, folder: raw(spark, folder).select(
        "lead_id",
        text.clean_stage("stage").alias("stage"),
        text.clean_stage("stage", strict_map=True).alias("stage_strict"),
    ),
    query(
        f"SELECT lead_id, {sql.stage('stage')} AS stage, {sql.stage('stage', extra=False)} AS stage_strict "
        "FROM raw_leads",
        "raw_leads",
    ),
)
ENTRIES["clean_date"] = (
    lambda spark, folder: raw(spark, folder).select(
        "lead_id",
        text.clean_date("first_seen_date", AS_OF).alias("first_seen_date"),
        text.clean_date("last_touch_date", AS_OF).alias("last_touch_date"),
    ),
    query(
        f"SELECT lead_id, {sql.day('first_seen_date')} AS first_seen_date, "
        f"{sql.day('last_touch_date')} AS last_touch_date FROM raw_leads",
        "raw_leads",
    ),
)
ENTRIES["clean_spend"] = (
    lambda spark, folder: raw(spark, folder).select(
        "lead_id", text.clean_spend("est_monthly_spend_gbp").alias("spend")
    ),
    query(f"SELECT lead_id, {sql.spend('est_monthly_spend_gbp')} AS spend FROM raw_leads", "raw_leads"),
)
ENTRIES["flag_email"] = (
    lambda spark, folder: raw(spark, folder).select(
        "lead_id", text.flag_email("email").alias("email"), text.email_is_valid("email").alias("email_valid")
    ),
    query("SELECT lead_id, coalesce(email, '') AS email, email_valid FROM norm", "norm"),
)
ENTRIES["invalid_emails"] = (
    lambda spark, folder: normalise.invalid_emails(repaired(spark, folder)),
    query("SELECT lead_id, email FROM norm WHERE NOT email_valid AND email IS NOT NULL", "norm"),
)
ENTRIES["numbers_or_zero"] = (
    lambda spark, folder: normalise.numbers_or_zero(raw(spark, folder)).select(
        "lead_id", "followers", "active_listings", "sales_velocity_30d", "num_touches", "avg_listing_price_gbp"
    ),
    query(
        "SELECT lead_id, coalesce(followers, 0) AS followers, coalesce(active_listings, 0) AS active_listings, "
        "coalesce(sales_velocity_30d, 0) AS sales_velocity_30d, coalesce(num_touches, 0) AS num_touches, "
        "coalesce(avg_listing_price_gbp, 0) AS avg_listing_price_gbp FROM norm",
        "norm",
    ),
)
ENTRIES["contact_keys"] = (
    lambda spark, folder: raw(spark, folder).select(
        "lead_id",
        keys.email_key("email").alias("email_key"),
        keys.phone_key("phone").alias("phone_key"),
        keys.store_city_key("store_name", "city").alias("store_city_key"),
    ),
    query(
        f"SELECT lead_id, {sql.email_key('email')} AS email_key, {sql.phone_key('phone')} AS phone_key, "
        f"{sql.store_key('store_name', 'city')} AS store_city_key FROM raw_leads",
        "raw_leads",
    ),
)
PHONE_IN_TEXT = r"\+1 \([0-9]{3}\) [0-9-]+"
FOUND_EMAIL = f"nullif(regexp_extract(text, '{text.EMAIL_IN_TEXT}', 0), '')"
FOUND_PHONE = f"nullif(regexp_extract(text, '{PHONE_IN_TEXT}', 0), '')"


@entry(
    "contacts_in_documents",
    f"SELECT doc_id, email, {sql.email_key('email')} AS email_key, {sql.phone_key('phone')} AS phone_key FROM "
    f"(SELECT doc_id, {FOUND_EMAIL} AS email, {FOUND_PHONE} AS phone FROM documents) d",
)
def contacts_in_documents(spark, folder):
    documents = fixtures.read_table(spark, folder, "documents")
    return documents.select(
        "doc_id",
        text.email_in_text("text").alias("email"),
        F.nullif(F.regexp_extract("text", PHONE_IN_TEXT, 0), F.lit("")).alias("phone"),
    ).select("doc_id", "email", keys.email_key("email").alias("email_key"), keys.phone_key("phone").alias("phone_key"))


ENTRIES["message_text"] = (
    lambda spark, folder: raw(spark, folder).select("lead_id", text.message_text("last_inbound_text").alias("message")),
    query(f"SELECT lead_id, {sql.message('last_inbound_text')} AS message FROM raw_leads", "raw_leads"),
)
ENTRIES["city_title"] = (
    lambda spark, folder: raw(spark, folder).select("lead_id", text.city_title("city").alias("city")),
    query(
        "SELECT lead_id, upper(left(trim(city), 1)) || lower(substr(trim(city), 2)) AS city FROM raw_leads",
        "raw_leads",
    ),
)
ENTRIES["email_in_notes"] = (
    lambda spark, folder: raw(spark, folder).select("lead_id", text.email_in_text("notes").alias("notes_email")),
    query(
        f"SELECT lead_id, nullif(regexp_extract(notes, '{text.EMAIL_IN_TEXT}', 0), '') AS notes_email FROM raw_leads",
        "raw_leads",
    ),
)
ENTRIES["display_name"] = (
    lambda spark, folder: raw(spark, folder).select(
        "lead_id",
        text.first_present("handle", "store_name", default="there").alias("display_name"),
        F.left(text.first_present("store_name", "handle", default="Unknown"), F.lit(27)).alias("short_name"),
    ),
    query(
        f"SELECT lead_id, coalesce({sql.blank('handle')}, {sql.blank('store_name')}, 'there') AS display_name, "
        f"left(coalesce({sql.blank('store_name')}, {sql.blank('handle')}, 'Unknown'), 27) AS short_name "
        "FROM raw_leads",
        "raw_leads",
    ),
)
ENTRIES["text_formats"] = (
    lambda spark, folder: normalise.numbers_or_zero(repaired(spark, folder)).select(
        "lead_id",
        text.format_gbp("est_monthly_spend_gbp").alias("spend"),
        text.format_thousands("followers").alias("followers"),
        F.left("last_inbound_text", F.lit(50)).alias("last_said"),
    ),
    query(
        f"SELECT lead_id, {sql.pounds('est_monthly_spend_gbp')} AS spend, "
        "format('{:,}', coalesce(followers, 0)) AS followers, left(last_inbound_text, 50) AS last_said FROM norm",
        "norm",
    ),
)
ENTRIES["touch_days"] = (
    lambda spark, folder: repaired(spark, folder).select(
        "lead_id",
        text.days_since("last_touch_date", AS_OF).alias("days_since_touch"),
        text.next_tuesday(F.col("last_touch_date")).alias("next_tuesday"),
        text.long_date(text.next_tuesday(F.col("last_touch_date"))).alias("next_tuesday_text"),
    ),
    query(
        f"SELECT lead_id, date_diff('day', last_touch_date, {sql.AS_OF})::INTEGER AS days_since_touch, t::DATE AS next_tuesday, "
        "strftime(t, '%A %d %B %Y') AS next_tuesday_text FROM (SELECT *, last_touch_date + "
        "(CASE WHEN isodow(last_touch_date) < 2 THEN 2 - isodow(last_touch_date) "
        "ELSE 9 - isodow(last_touch_date) END)::INTEGER AS t FROM norm) x",
        "norm",
    ),
)

# --- Geography ---------------------------------------------------------------

ENTRIES["repair_geography"] = (
    lambda spark, folder: repaired(spark, folder).select(
        "lead_id", "city", "country", "notes", "forced_uk", "geo_flag"
    ),
    query("SELECT lead_id, city, country, notes, forced_uk, geo_flag FROM geo", "geo"),
)
ENTRIES["geography_summary"] = (
    lambda spark, folder: geo.geography_summary(repaired(spark, folder)),
    query(
        "SELECT count(*) FILTER (forced_uk) AS forced_uk, count(*) FILTER (geo_flag) AS phone_conflicts FROM geo",
        "geo",
    ),
)

# --- Duplicates --------------------------------------------------------------


@entry(
    "newest_first_rank",
    query(
        "SELECT lead_id, last_touch_date, row_number() OVER (ORDER BY last_touch_date DESC NULLS LAST, lead_id) "
        "AS place FROM geo",
        "geo",
    ),
)
def newest_first_rank(spark, folder):
    leads = repaired(spark, folder).select("lead_id", "last_touch_date")
    order = [F.col("last_touch_date").desc_nulls_last(), F.col("lead_id").asc()]
    return with_position(leads, order, "place")


@entry("drop_duplicates", query("SELECT lead_id, handle, email, phone, store_name, city, last_touch_date FROM kept", "kept"))
def drop_duplicates(spark, folder):
    leads = clean_plan.prepared_leads(raw(spark, folder), AS_OF)
    return identity.drop_duplicates(leads).select(
        "lead_id", "handle", "email", "phone", "store_name", "city", "last_touch_date"
    )


AUDIT = f"""SELECT lead_id, handle, store_name,
    ['lead_id', 'handle', 'email', 'phone', 'store_city'][left(hit, 1)::INTEGER + 1] AS matched_on,
    {sql.DUPLICATE_REASON} AS reason, {sql.quoted(rules.DUPLICATE_ACTION)} AS action,
    owner AS matched_lead_id, 1::BIGINT AS copies
  FROM (SELECT d.n, any_value(d.lead_id) AS lead_id, any_value(d.handle) AS handle,
      any_value(d.store_name) AS store_name, any_value(d.city) AS city, min(d.key) AS hit,
      arg_min(k.lead_id, d.key) AS owner
    FROM (SELECT o.*, unnest(o.keys) AS key FROM ordered o JOIN walk w ON o.n = w.n WHERE NOT w.kept) d
    JOIN (SELECT n, lead_id, unnest(keys) AS key FROM kept) k ON k.key = d.key AND k.n < d.n
    GROUP BY d.n) x"""


@entry("duplicate_audit", query(AUDIT, "kept"))
def duplicate_audit(spark, folder):
    leads = clean_plan.prepared_leads(raw(spark, folder), AS_OF)
    return identity.duplicate_audit(leads, identity.resolve_duplicates(leads))


# --- Classification ----------------------------------------------------------

ENTRIES["lead_type"] = (
    lambda spark, folder: classify.classify_lead_type(repaired(spark, folder)).select("lead_id", "lead_type"),
    query("SELECT lead_id, lead_type FROM single", "single"),
)
ENTRIES["lead_type_batch"] = (
    lambda spark, folder: classify.classify_lead_type(
        repaired(spark, folder), allow_hybrid=False, require_valid_email=False
    ).select("lead_id", "lead_type"),
    query(
        "SELECT lead_id, CASE WHEN NOT has_metrics THEN 'physical_shop' WHEN email IS NOT NULL "
        "THEN 'reseller_with_email' ELSE 'reseller' END AS lead_type FROM norm",
        "norm",
    ),
)
MEANING = f"""SELECT lead_id,
    CASE WHEN msg IS NULL THEN NULL
      WHEN msg IN {sql.in_list(rules.EXACT_MEETING)} THEN 'Meeting Booked'
      WHEN msg IN {sql.in_list(rules.EXACT_HOT + rules.EXACT_WARM)} THEN 'Replied'
      WHEN msg IN {sql.in_list(rules.EXACT_HOLD)} THEN 'Hold'
      WHEN {sql.has('msg', rules.LOST_PHRASES)} THEN 'Lost'
      WHEN {sql.has('msg', rules.MEETING_PHRASES)} THEN 'Meeting Booked'
      WHEN {sql.has('msg', rules.HOLD_PHRASES)} THEN 'Hold' ELSE 'Replied' END AS stage,
    {sql.reply_words('msg')} AS reply_type,
    CASE WHEN msg IS NULL THEN 0
      WHEN msg IN {sql.in_list(rules.EXACT_MEETING + rules.EXACT_HOT + rules.EXACT_WARM + rules.EXACT_HOLD)} THEN 1
      WHEN {sql.has('msg', rules.LOST_PHRASES + rules.MEETING_PHRASES + rules.HOLD_PHRASES + rules.WARM_PHRASES
                    + rules.HOT_PHRASES)} THEN 2 ELSE 3 END AS layer
  FROM (SELECT lead_id, {sql.message('last_inbound_text')} AS msg FROM raw_leads) m"""
ENTRIES["message_meaning"] = (
    lambda spark, folder: classify.classify_messages(raw(spark, folder)).select("lead_id", "meaning.*"),
    query(MEANING, "raw_leads"),
)
ENTRIES["unclassified_messages"] = (
    lambda spark, folder: classify.unclassified_messages(raw(spark, folder)),
    query(
        f"SELECT message, count(*) AS leads FROM (SELECT {sql.message('last_inbound_text')} AS message "
        "FROM raw_leads) m WHERE message IS NOT NULL AND message NOT IN "
        f"{sql.in_list(rules.EXACT_MEETING + rules.EXACT_HOT + rules.EXACT_WARM + rules.EXACT_HOLD)} AND NOT "
        + sql.has("message", rules.LOST_PHRASES + rules.MEETING_PHRASES + rules.HOLD_PHRASES + rules.WARM_PHRASES
                  + rules.HOT_PHRASES)
        + " GROUP BY message",
        "raw_leads",
    ),
)
ENTRIES["reconcile_stage"] = (
    lambda spark, folder: clean_plan.classified_leads(raw(spark, folder), AS_OF).select(
        "lead_id", "stage_raw", "stage", "stage_overridden"
    ),
    query("SELECT lead_id, stage_raw, stage, stage_overridden FROM single", "single"),
)
ENTRIES["reply_type"] = (
    lambda spark, folder: clean_plan.classified_leads(raw(spark, folder), AS_OF).select(
        "lead_id", "reply_type", "overdue"
    ),
    query("SELECT lead_id, reply_type, overdue FROM single", "single"),
)
ENTRIES["objection_type"] = (
    lambda spark, folder: clean_plan.classified_leads(raw(spark, folder), AS_OF).select("lead_id", "obj_type"),
    query("SELECT lead_id, obj_type FROM single", "single"),
)
COARSE = f"""SELECT lead_id, r.reply_type, r.follow_up_timing, r.objection_type, r.recommended_response
  FROM (SELECT lead_id, CASE WHEN {sql.blank('last_inbound_text')} IS NULL THEN 'blank'
      WHEN {sql.has('lower(last_inbound_text)', rules.COARSE_HARD_NO)} THEN 'hard_no'
      WHEN {sql.has('lower(last_inbound_text)', rules.COARSE_BUYING)} THEN 'buying'
      WHEN {sql.has('lower(last_inbound_text)', rules.COARSE_OBJECTION)} THEN 'objection'
      ELSE 'unclear' END AS kind FROM raw_leads) c
  JOIN (VALUES {', '.join('(' + ', '.join('NULL' if v is None else sql.quoted(v) for v in (k, *o)) + ')'
                          for k, o in rules.COARSE_OUTCOMES.items())})
    AS r(kind, reply_type, follow_up_timing, objection_type, recommended_response) USING (kind)"""
ENTRIES["coarse_reply"] = (
    lambda spark, folder: classify.with_coarse_reply(raw(spark, folder)).select("lead_id", "coarse.*"),
    query(COARSE, "raw_leads"),
)
ENTRIES["note_hints"] = (
    lambda spark, folder: repaired(spark, folder).select("lead_id", classify.note_hints("notes").alias("hints")),
    query(f"SELECT lead_id, {sql.hints('notes')} AS hints FROM geo", "geo"),
)


@entry("message_meaning_by_table", query(MEANING, "raw_leads"))
def message_meaning_by_table(spark, folder):
    outcomes = [(number, *outcome) for number, outcome in enumerate(classify.MEANINGS[1:-1])]
    outcomes = spark.createDataFrame(outcomes, "rule int, stage string, reply_type string, layer int")
    found = classify.classify_messages_by(raw(spark, folder), classify.meaning_rules(spark), outcomes)
    return found.select("lead_id", "meaning.*")


@entry("objection_type_by_table", query("SELECT lead_id, obj_type FROM single", "single"))
def objection_type_by_table(spark, folder):
    listed = phrases.rule_table(spark, [(texts, False) for texts in rules.OBJECTION_PHRASES.values()])
    kinds = spark.createDataFrame(list(enumerate(rules.OBJECTION_PHRASES)), "rule int, kind string")
    said = raw(spark, folder).select("lead_id", text.message_text("last_inbound_text").alias("message"))
    found = phrases.with_first_rule(said, "message", listed).join(kinds, "rule", "left")
    return found.select("lead_id", F.coalesce("kind", F.lit("none")).alias("obj_type"))


@entry("note_hint_rules", query(
    "SELECT lead_id, '[' || concat_ws(', ', " + ", ".join(
        f"CASE WHEN contains(lower(notes), {sql.quoted(word)}) THEN '{number}' END" for number, word in enumerate(rules.NOTE_HINTS)
    ) + ") || ']' AS hint_rules FROM geo", "geo"))
def note_hint_rules(spark, folder):
    listed = phrases.rule_table(spark, [([word], False) for word in rules.NOTE_HINTS])
    noted = repaired(spark, folder).select("lead_id", F.lower("notes").alias("notes"))
    found = F.coalesce("hint_rules", F.array().cast("array<int>"))
    return phrases.with_all_rules(noted, "notes", listed, "hint_rules").select("lead_id", found.cast("string").alias("hint_rules"))


@entry("store_places_by_table", query(
    "SELECT lead_id, CASE " + " ".join(
        f"WHEN contains(lower(store_name), {sql.quoted(word)}) THEN {sql.quoted(place)}" for word, place in rules.STORE_NAME_PLACES.items()
    ) + " END AS place FROM raw_leads", "raw_leads"))
def store_places_by_table(spark, folder):
    listed = phrases.rule_table(spark, [([word], False) for word in rules.STORE_NAME_PLACES])
    places = spark.createDataFrame(list(enumerate(rules.STORE_NAME_PLACES.values())), "rule int, place string")
    shops_named = raw(spark, folder).select("lead_id", F.lower("store_name").alias("store"))
    return phrases.with_first_rule(shops_named, "store", listed).join(places, "rule", "left").select("lead_id", "place")


@entry("clean_leads", query(f"SELECT {sql.CLEAN_COLUMNS} FROM clean", "clean"))
def clean_leads(spark, folder):
    return clean_plan.clean_leads(raw(spark, folder), AS_OF)


# --- Daily contact list ------------------------------------------------------

FLAT = """SELECT * REPLACE (coalesce(followers, 0) AS followers, coalesce(active_listings, 0) AS active_listings,
    coalesce(sales_velocity_30d, 0) AS sales_velocity_30d, coalesce(num_touches, 0) AS num_touches,
    coalesce(avg_listing_price_gbp, 0) AS avg_listing_price_gbp) FROM clean"""
ACTIVE = """SELECT *, avg_listing_price_gbp * sales_velocity_30d AS revenue,
    sales_velocity_30d / greatest(active_listings, 1) AS turnover, reply_type IN ('amber', 'new') AS silent
  FROM flat WHERE lead_type LIKE 'reseller%' AND stage NOT IN ('Won', 'Lost') AND reply_type <> 'cold'"""


def share(column: str, points: int, within: str = "true") -> str:
    top = f"coalesce(nullif((SELECT max({column}) FROM active WHERE {within}), 0), 1)"
    return f"least(greatest({column} / {top} * {points}, 0), {points})"


SCORED = f"""SELECT *, CASE WHEN silent THEN round_even({share('sales_velocity_30d', 40)} + {share('revenue', 30)}
      + {share('est_monthly_spend_gbp', 20)} + {share('followers', 15)} + {share('turnover', 10, 'silent')}
      + CASE WHEN num_touches >= 5 THEN -50 ELSE 0 END, 2) END AS step_b_score,
    round_even(CASE reply_type WHEN 'hot' THEN 50 WHEN 'warm' THEN 25 ELSE 0 END
      + {share('est_monthly_spend_gbp', 30)} + {share('sales_velocity_30d', 20)} + {share('revenue', 15)}
      + {share('followers', 10)} + {share('active_listings', 5)}, 2) AS priority_score,
    CASE WHEN stage = 'Meeting Booked' AND lead_type = 'reseller' THEN 0 WHEN reply_type = 'hot' THEN 1
      WHEN reply_type = 'warm' THEN 2 ELSE 3 END AS tier
  FROM active"""
WHY = """CASE CASE WHEN tier = 0 THEN 'meeting' ELSE reply_type END
    WHEN 'meeting' THEN 'Step Zero — MEETING CONFIRMATION NEEDED | No email on file, handle only | ' || pounds ||
      '/mo | Lock in the exact time before anything else today'
    WHEN 'hot' THEN 'Step A — HOT REPLY | Last said: ' || left(coalesce(last_inbound_text, ''), 50) || ' | ' || pounds || '/mo'
    WHEN 'warm' THEN 'Step A — WARM REPLY | ' || CASE obj_type
        WHEN 'platform' THEN 'Platform objection — handle differentiation'
        WHEN 'misunderstanding' THEN 'Misunderstanding — clarify Marketplace is for sourcing'
        WHEN 'timing' THEN 'Timing issue — send content, set reminder'
        WHEN 'soft_no' THEN 'Soft no — send content, follow up in 30 days'
        ELSE 'Warm reply — handle it' END || ' | ' || pounds || '/mo'
    WHEN 'amber' THEN 'Step B — WHALE FILLER (Amber) | Contacted, no reply | ' || pounds || '/mo'
      || coalesce(' | Note: ' || notes, '')
    ELSE 'Step B — WHALE FILLER (New) | First touch | ' || pounds || '/mo' END"""
QUEUED = f"""SELECT lead_id, handle, contact_name, stage, followers, sales_velocity_30d, est_monthly_spend_gbp,
    last_touch_date, last_inbound_text, priority_score, step_b_score, priority_rank,
    CASE WHEN tier = 0 THEN 'Step Zero — MEETING CONFIRMATION (handle only, top priority)'
      WHEN tier = 1 THEN 'Step A — Active conversation (Hot)' WHEN tier = 2 THEN 'Step A — Active conversation (Warm)'
      WHEN reply_type = 'amber' THEN 'Step B — Whale filler (Amber)' ELSE 'Step B — Whale filler (New)' END AS slot_type,
    {WHY} AS why_today,
    CASE WHEN tier = 0 THEN 'meeting_confirmation' ELSE reply_type END AS reply_type,
    CASE WHEN tier IN (1, 2) THEN 'today' ELSE '7_days' END AS follow_up_timing, obj_type,
    CASE WHEN tier = 0 THEN 'Follow up' WHEN tier = 1 THEN 'Respond today — buying signal'
      WHEN tier = 2 THEN 'Handle objection or set reminder'
      WHEN reply_type = 'amber' THEN 'Re-engage — no reply received'
      ELSE 'First touch — high value hook' END AS recommended_response,
    lead_type, email, phone, store_name, notes
  FROM (SELECT *, {sql.pounds('est_monthly_spend_gbp')} AS pounds, row_number() OVER (
      ORDER BY tier, CASE WHEN tier = 3 THEN step_b_score ELSE est_monthly_spend_gbp END DESC, lead_id)
      AS priority_rank FROM scored) q
  WHERE priority_rank <= 40"""
DAILY = {"flat": FLAT, "active": ACTIVE, "scored": SCORED, "queued": QUEUED}

ENTRIES["channel_split"] = (
    lambda spark, folder: queue.resellers(clean(spark, folder))
    .select("lead_id", F.lit("resellers").alias("channel"))
    .unionByName(queue.shops(clean(spark, folder)).select("lead_id", F.lit("shops").alias("channel"))),
    query(
        "SELECT lead_id, CASE WHEN lead_type IN ('physical_shop', 'hybrid') THEN 'shops' ELSE 'resellers' END "
        "AS channel FROM clean",
        "clean",
    ),
)
ENTRIES["follow_up"] = (
    lambda spark, folder: queue.with_follow_up(queue.with_reply_defaults(clean(spark, folder))).select(
        "lead_id", "reply_type", "obj_type", "follow_up_timing", "recommended_response"
    ),
    query(
        "SELECT lead_id, reply_type, obj_type, CASE reply_type WHEN 'hot' THEN 'today' WHEN 'warm' THEN 'today' "
        "WHEN 'cold' THEN 'never' ELSE '7_days' END AS follow_up_timing, CASE reply_type "
        "WHEN 'hot' THEN 'Respond today — buying signal' WHEN 'warm' THEN 'Handle objection or set reminder' "
        "WHEN 'amber' THEN 'Re-engage — no reply received' WHEN 'new' THEN 'First touch — high value hook' "
        "WHEN 'cold' THEN 'SKIP — mark as Lost' ELSE 'Follow up' END AS recommended_response FROM clean",
        "clean",
    ),
)
ENTRIES["queue_candidates"] = (
    lambda spark, folder: queue.queue_candidates(clean(spark, folder)).select(
        "lead_id", "tier", "step_b_score", "priority_score"
    ),
    query("SELECT lead_id, tier, step_b_score, priority_score FROM scored", "clean",
          extra={k: DAILY[k] for k in ("flat", "active", "scored")}),
)
ENTRIES["daily_queue"] = (
    lambda spark, folder: queue.daily_queue(clean(spark, folder)),
    query("SELECT * FROM queued", "clean", extra=DAILY),
)
ENTRIES["queue_summary"] = (
    lambda spark, folder: queue.queue_summary(clean(spark, folder)),
    query(
        "SELECT count(*) FILTER (tier = 0) AS meeting_confirmations, count(*) FILTER (tier = 1) AS hot, "
        "count(*) FILTER (tier = 2) AS warm, count(*) FILTER (tier = 3) AS filler_pool, "
        "count(*) FILTER (tier = 3 AND num_touches >= 5) AS deprioritised, "
        "greatest(40 - count(*) FILTER (tier < 3), 0) AS slots_remaining FROM scored",
        "clean",
        extra={k: DAILY[k] for k in ("flat", "active", "scored")},
    ),
)

# --- Shops -------------------------------------------------------------------

UK = "coalesce(upper(trim(country)) = 'UK', false)"
SAYS = {k: sql.quoted(rules.Brand().apply(v)) for k, v in rules.SHOP_ACTIONS.items()}
SHOP_ACTION = f"""CASE stage WHEN 'Lost' THEN {SAYS['lost']} WHEN 'Hold' THEN {SAYS['hold']}
    WHEN 'Won' THEN CASE WHEN {UK} THEN {SAYS['won_uk']} ELSE {SAYS['won_abroad']} END
    WHEN 'Meeting Booked' THEN CASE WHEN {UK} THEN {SAYS['meeting_uk']} ELSE {SAYS['meeting_abroad']} END
    WHEN 'Negotiating' THEN CASE WHEN {UK} THEN {SAYS['negotiating_uk']} ELSE {SAYS['negotiating_abroad']} END
    WHEN 'Replied' THEN CASE WHEN NOT {UK} THEN {SAYS['replied_abroad']}
      WHEN reply_type = 'hot' THEN {SAYS['replied_uk_hot']}
      WHEN contains(lower(coalesce(last_inbound_text, '')), 'vinted') OR obj_type = 'misunderstanding'
        THEN {SAYS['replied_uk_misunderstanding']}
      WHEN contains(lower(coalesce(last_inbound_text, '')), 'another platform') OR obj_type = 'platform'
        THEN {SAYS['replied_uk_platform']}
      ELSE {SAYS['replied_uk']} END
    WHEN 'Contacted' THEN CASE WHEN NOT {UK} THEN {SAYS['contacted_abroad']}
      WHEN est_monthly_spend_gbp >= 5000
        THEN replace({SAYS['contacted_uk_high']}, '{{spend}}', {sql.pounds('est_monthly_spend_gbp')})
      ELSE {SAYS['contacted_uk']} END
    WHEN 'New' THEN CASE WHEN {UK} AND est_monthly_spend_gbp >= 5000 THEN {SAYS['new_uk_high']} ELSE {SAYS['new']} END
    ELSE {SAYS['other']} END"""
SHOP_PLAN = f"""SELECT *, CASE WHEN country = 'UK' THEN 0 ELSE 1 END AS region_order,
    CASE stage WHEN 'Negotiating' THEN 1 WHEN 'Meeting Booked' THEN 2 WHEN 'Replied' THEN 3 WHEN 'Contacted' THEN 4
      WHEN 'New' THEN 5 WHEN 'Hold' THEN 6 WHEN 'Lost' THEN 7 WHEN 'Won' THEN 8 ELSE 5 END AS stage_priority,
    {SHOP_ACTION} AS recommended_action
  FROM clean WHERE lead_type IN ('physical_shop', 'hybrid')"""
SHOPS = {"shop_plan": SHOP_PLAN}
SHOP_LIST = ", ".join(SHOP_COLUMNS)

ENTRIES["recommended_action"] = (
    lambda spark, folder: shops.plan_shops(clean(spark, folder)).select(
        "lead_id", "region_order", "stage_priority", "recommended_action"
    ),
    query("SELECT lead_id, region_order, stage_priority, recommended_action FROM shop_plan", "clean", extra=SHOPS),
)
ENTRIES["sequenced_shops"] = (
    lambda spark, folder: shops.sequenced_shops(clean(spark, folder)),
    query(f"SELECT {SHOP_LIST} FROM shop_plan", "clean", extra=SHOPS),
)
ENTRIES["numbered_shops"] = (
    lambda spark, folder: shops.numbered_shops(clean(spark, folder)),
    query(
        "SELECT row_number() OVER (ORDER BY region_order, CASE WHEN region_order = 1 THEN country END NULLS LAST, "
        "city NULLS LAST, stage_priority, est_monthly_spend_gbp DESC, lead_id) AS shop_rank, "
        f"{SHOP_LIST} FROM shop_plan",
        "clean",
        extra=SHOPS,
    ),
)
ENTRIES["confirmed_visits"] = (
    lambda spark, folder: shops.confirmed_visits(
        shops.plan_shops(clean(spark, folder)), fixtures.confirmations(spark, folder)
    ),
    query(
        f"SELECT {SHOP_LIST}, true AS appointment_confirmed FROM shop_plan "
        "WHERE lead_id IN (SELECT lead_id FROM confirmations)",
        "clean", "confirmations",
        extra=SHOPS,
    ),
)


@entry(
    "confirmed_visits_stream",
    query(
        f"SELECT {SHOP_LIST}, true AS appointment_confirmed FROM shop_plan "
        "WHERE lead_id IN (SELECT lead_id FROM confirmations)",
        "clean", "confirmations",
        extra=SHOPS,
    ),
)
def confirmed_visits_stream(spark, folder):
    """The plan and the ticks of the day arrive file by file, some ticks twice and some before their shop."""
    root = scratch_path(spark, "ticks")
    planned = shops.plan_shops(clean(spark, folder)).withColumn("planned_at", F.lit("2026-06-30 08:00:00").cast("timestamp"))
    minutes = F.pmod(F.xxhash64("lead_id"), F.lit(600))
    ticked = fixtures.confirmations(spark, folder).select(
        "lead_id", (F.lit("2026-06-30 08:30:00").cast("timestamp") + F.make_dt_interval(mins=minutes.cast("int"))).alias("ticked_at")
    )
    planned.repartition(2).write.parquet(f"{root}/plans")
    ticked.unionAll(ticked.where(minutes < 100)).repartition(2).write.parquet(f"{root}/in")
    streams = [
        spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")
        for name, table in (("plans", planned), ("in", ticked))
    ]
    write_confirmed(confirmed_stream(*streams, lateness="1 day"), f"{root}/confirmed", f"{root}/progress").awaitTermination()
    columns = [c for c in SHOP_COLUMNS if c in planned.columns]
    schema = planned.select(*columns).withColumn("appointment_confirmed", F.lit(True)).schema
    return spark.read.schema(schema).parquet(f"{root}/confirmed")


ENTRIES["visits_without_confirmations"] = (
    lambda spark, folder: shops.confirmed_visits(
        shops.plan_shops(clean(spark, folder)), tables.no_confirmations(spark)
    ),
    query(f"SELECT {SHOP_LIST}, true AS appointment_confirmed FROM shop_plan WHERE false", "clean", extra=SHOPS),
)
ENTRIES["visits_with_strange_confirmations"] = (
    lambda spark, folder: shops.confirmed_visits(
        shops.plan_shops(clean(spark, folder)), fixtures.strange_confirmations(spark, folder)
    ),
    query(
        f"SELECT {SHOP_LIST}, true AS appointment_confirmed FROM shop_plan "
        "WHERE CAST(SUBSTR(lead_id, 2) AS BIGINT) % 4 = 0",
        "clean",
        extra=SHOPS,
    ),
)
ENTRIES["uk_city_counts"] = (
    lambda spark, folder: shops.uk_city_counts(clean(spark, folder)),
    query(
        "SELECT city, count(*) AS shops, count(*) FILTER (stage = 'Negotiating') AS negotiating, "
        "count(*) FILTER (stage = 'Replied') AS replied FROM shop_plan "
        "WHERE country = 'UK' AND city IS NOT NULL GROUP BY city",
        "clean",
        extra=SHOPS,
    ),
)
ENTRIES["regional_hubs"] = (
    lambda spark, folder: shops.regional_hubs(clean(spark, folder)),
    query(
        "SELECT city, count(lead_id) AS total_accounts, sum(est_monthly_spend_gbp) AS total_pipeline, "
        "count(*) FILTER (stage = 'Meeting Booked') AS meeting_booked, count(*) FILTER (stage = 'Replied') AS replied, "
        "count(*) FILTER (stage = 'Contacted') AS contacted, "
        f"{sql.quoted(rules.HUB_STRATEGY)} AS sequence_strategy FROM shop_plan WHERE city IS NOT NULL GROUP BY city",
        "clean",
        extra=SHOPS,
    ),
)

# --- City visits -------------------------------------------------------------

VISITABLE = """SELECT * FROM (SELECT * REPLACE (upper(left(city, 1)) || lower(substr(city, 2)) AS city),
    est_monthly_spend_gbp * CASE stage WHEN 'Meeting Booked' THEN 3.0::DOUBLE WHEN 'Negotiating' THEN 2.5
      WHEN 'Replied' THEN CASE reply_type WHEN 'hot' THEN 2.0 WHEN 'warm' THEN 1.5 ELSE 1.0 END
      WHEN 'Contacted' THEN 1.0
      WHEN 'New' THEN CASE WHEN est_monthly_spend_gbp >= 5000 THEN 0.8 WHEN est_monthly_spend_gbp >= 2000 THEN 0.4
        ELSE 0 END ELSE 0 END AS visit_score
    FROM clean WHERE lead_type = 'physical_shop' AND stage NOT IN ('Hold', 'Lost', 'Won')
      AND upper(coalesce(country, '')) IN ('UK', 'UNITED KINGDOM', '')) v WHERE visit_score > 0"""
TOTALS = """SELECT city, round_even(sum(visit_score), 0) AS total_score,
    round_even(sum(est_monthly_spend_gbp), 0) AS total_pipeline_gbp, count(*) AS total_shops,
    count(*) FILTER (stage = 'Meeting Booked') AS meeting_booked, count(*) FILTER (stage = 'Negotiating') AS negotiating,
    count(*) FILTER (stage = 'Replied' AND reply_type = 'hot') AS replied_hot,
    count(*) FILTER (stage = 'Replied' AND reply_type = 'warm') AS replied_warm,
    count(*) FILTER (stage = 'Contacted') AS contacted, count(*) FILTER (stage = 'New') AS new_shops
  FROM visitable WHERE city IS NOT NULL GROUP BY city"""
PLAN = f"""SELECT row_number() OVER (PARTITION BY city ORDER BY
      CASE stage WHEN 'Meeting Booked' THEN 1 WHEN 'Negotiating' THEN 2 WHEN 'Replied' THEN 3 WHEN 'Contacted' THEN 4
        WHEN 'New' THEN 5 ELSE 99 END,
      CASE reply_type WHEN 'hot' THEN 1 WHEN 'warm' THEN 2 WHEN 'amber' THEN 3 WHEN 'new' THEN 4 WHEN 'none' THEN 5
        ELSE 99 END, est_monthly_spend_gbp DESC, lead_id) AS visit_order,
    coalesce(store_name, handle, 'Unknown') AS store_name,
    left(coalesce(store_name, handle, 'Unknown'), 27) AS short_name, city, stage, reply_type, est_monthly_spend_gbp,
    coalesce(email, '') AS email, coalesce(phone, '') AS phone,
    CASE WHEN stage = 'Meeting Booked' THEN 'Confirmed visit — add to route'
      WHEN stage = 'Negotiating' THEN 'Book visit — email first, visit to close'
      WHEN stage = 'Replied' THEN CASE reply_type WHEN 'hot' THEN 'Book visit — hot reply, high intent'
        WHEN 'warm' THEN 'Book visit — handle objection face to face'
        ELSE 'Book visit — warm lead, email to arrange' END
      WHEN stage = 'Contacted' AND est_monthly_spend_gbp >= 5000
        THEN 'Cold visit justified — ' || {sql.pounds('est_monthly_spend_gbp')} || '/mo'
      WHEN stage = 'New' AND est_monthly_spend_gbp >= 5000 THEN 'Email first — high value, visit after reply'
      WHEN stage = 'New' AND est_monthly_spend_gbp >= 2000 THEN 'Drop-in if nearby — mid value new lead'
      ELSE 'Email only' END AS action, visit_score, notes, last_inbound_text
  FROM visitable WHERE city IS NOT NULL"""
CITY = {"visitable": VISITABLE, "totals": TOTALS, "plan": PLAN}


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return city.scored_shops(clean(spark, folder))


ENTRIES["visit_scores"] = (
    lambda spark, folder: scored(spark, folder).select("lead_id", "city", "visit_score"),
    query("SELECT lead_id, city, visit_score FROM visitable", "clean", extra=CITY),
)
ENTRIES["city_rankings"] = (
    lambda spark, folder: city.city_rankings(scored(spark, folder)),
    query("SELECT * FROM totals", "clean", extra=CITY),
)
ENTRIES["numbered_cities"] = (
    lambda spark, folder: city.numbered_cities(scored(spark, folder)),
    query("SELECT *, row_number() OVER (ORDER BY total_score DESC, city) AS rank FROM totals", "clean", extra=CITY),
)
ENTRIES["city_recommendation"] = (
    lambda spark, folder: city.recommendation(scored(spark, folder), AS_OF),
    query(
        "SELECT city, DATE '2001-08-07' AS visit_date, total_pipeline_gbp, total_shops, 'Visit ' || city || "
        f"' on Tuesday 07 August 2001. ' || {sql.pounds('total_pipeline_gbp')} || ' in pipeline value across ' || "
        "total_shops || ' shops.' AS recommendation FROM totals ORDER BY total_score DESC, city LIMIT 1",
        "clean",
        extra=CITY,
    ),
)
ENTRIES["itineraries"] = (
    lambda spark, folder: city.itineraries(scored(spark, folder)),
    query("SELECT * FROM plan", "clean", extra=CITY),
)
ENTRIES["visit_plan"] = (
    lambda spark, folder: city.visit_plan(scored(spark, folder)),
    query(
        "SELECT * FROM plan WHERE city = (SELECT city FROM totals ORDER BY total_score DESC, city LIMIT 1)",
        "clean",
        extra=CITY,
    ),
)

# --- Drafts ------------------------------------------------------------------


def _draft_sql(channel: str, source: str) -> str:
    """Message, action and follow-up chosen by nested cases over the source rows."""
    say = rules.Brand().apply

    def text_of(template: str) -> str:
        out = sql.quoted(say(template))
        for name in ("greeting", "contact_line", "contact", "day", "hook", "subject", "store", "city"):
            out = f"replace({out}, '{{{name}}}', d_{name})" if "{" + name + "}" in template else out
        return out

    day = " ".join(f"WHEN contains(d_said, {sql.quoted(w)}) THEN {sql.quoted(d)}" for w, d in rules.DAY_WORDS.items())
    hook = " ".join(
        f"WHEN contains(lower(notes), {sql.quoted(w)}) THEN {sql.quoted(h)}" for w, h in rules.HOOKS.items()
    )
    chosen = {"message": [], "next_action": [], "follow_up_date": []}

    def case(condition: str, message: str, action: str, follow_up: str) -> None:
        chosen["message"].append(f"WHEN {condition} THEN {text_of(message)}")
        chosen["next_action"].append(f"WHEN {condition} THEN {text_of(action)}")
        chosen["follow_up_date"].append(f"WHEN {condition} THEN {sql.quoted(follow_up)}")

    booked = "stage = 'Meeting Booked'"
    case("reply_type = 'cold'", *rules.HARD_NO_DRAFT)
    case(f"{booked} AND d_day IS NOT NULL", *rules.MEETING_DRAFTS["day"])
    case(f"{booked} AND ({sql.has('d_said', ['when', 'sounds good'])})", *rules.MEETING_DRAFTS["open"])
    case(booked, *rules.MEETING_DRAFTS["vague"])
    case("reply_type IN ('new', 'amber', 'none')", *rules.COLD_DRAFTS[channel])
    other = {"hot": "reply_type = 'hot'", "hold": "stage = 'Hold'", "default": "true"}
    for name, words, known, unknown, action, follow_up in rules.CONVERSATION_DRAFTS:
        test = other[name] if words is None else sql.has("d_said", words)
        if unknown:
            case(f"{test} AND d_contact IS NULL", unknown, action, follow_up)
        case(test, known, action, follow_up)
    if channel == "dm":
        greeting = (
            f"'Hey @' || CASE WHEN {booked} THEN coalesce(handle, '') "
            "ELSE coalesce(handle, contact_name, store_name, 'there') END"
        )
    else:
        greeting = (
            f"CASE WHEN {booked} AND coalesce(contact_name, handle, store_name) IS NULL THEN 'Hi' "
            "ELSE 'Hi ' || coalesce(contact_name, handle, store_name, 'there') END"
        )
    place = "'your area'" if channel == "dm" else "coalesce(city, 'your area')"
    town = "NULL" if channel == "dm" else "city"
    return f"""SELECT *, CASE {' '.join(chosen['message'])} END AS drafted_message,
        CASE {' '.join(chosen['next_action'])} END AS next_action,
        CASE {' '.join(chosen['follow_up_date'])} END AS follow_up_date
      FROM (SELECT *, {greeting} AS d_greeting, coalesce(d_email, phone) AS d_contact,
          CASE WHEN d_email IS NOT NULL THEN 'I''ll get that sent straight over to ' || d_email || ' now.'
            WHEN phone IS NOT NULL THEN 'I''ll drop that straight into WhatsApp on ' || phone || ' now.'
            ELSE 'What''s the best email or WhatsApp to send that straight over to?' END AS d_contact_line,
          CASE {day} END AS d_day, CASE {hook} ELSE {sql.quoted(rules.HOOK_DEFAULT)} END AS d_hook,
          coalesce(store_name, {town}, 'your store') AS d_subject, coalesce(store_name, 'your store') AS d_store,
          {place} AS d_city
        FROM (SELECT *, lower(coalesce(last_inbound_text, '')) AS d_said,
            CASE WHEN email LIKE '%@%.%' AND email NOT LIKE '% %' THEN email END AS d_email FROM {source}) a) b"""


RESELLER_DRAFTS = f"""SELECT lead_id, handle, contact_name, stage, last_inbound_text, reply_type, obj_type, priority_score,
    why_today, drafted_message, next_action, follow_up_date, 'Instagram DM' AS channel, lead_type, email,
    'Online Reseller' AS lead_category FROM ({_draft_sql('dm', 'queued')}) r"""
SHOP_DRAFTS = f"""SELECT lead_id, store_name, contact_name, email, phone, city, country, stage, reply_type,
    last_inbound_text, recommended_action, drafted_message, next_action, follow_up_date, 'Email' AS channel,
    est_monthly_spend_gbp, 'Physical Shop' AS lead_category
  FROM ({_draft_sql('email', "shop_plan WHERE stage <> 'Won'")}) s"""
ALL_DRAFTS = "SELECT * FROM reseller_drafts UNION ALL BY NAME SELECT * FROM shop_drafts"
DRAFTS = DAILY | SHOPS | {"reseller_drafts": RESELLER_DRAFTS, "shop_drafts": SHOP_DRAFTS, "all_drafts": ALL_DRAFTS}


def messages(spark: SparkSession, folder: str) -> DataFrame:
    leads = clean(spark, folder)
    return drafts.todays_messages(queue.daily_queue(leads), shops.plan_shops(leads))


ENTRIES["known_contact"] = (
    lambda spark, folder: drafts.with_known_contact(clean(spark, folder)).select(
        "lead_id", "known_contact", "message_category"
    ),
    query(
        f"SELECT lead_id, coalesce(CASE WHEN email_valid THEN email END, phone, nullif(regexp_extract(notes, '{text.EMAIL_IN_TEXT}', 0), '')) "
        "AS known_contact, CASE WHEN reply_type IN ('hot', 'warm') THEN 2 ELSE 1 END AS message_category FROM clean",
        "clean",
    ),
)
ENTRIES["reseller_messages"] = (
    lambda spark, folder: drafts.reseller_messages(queue.daily_queue(clean(spark, folder))),
    query("SELECT * FROM reseller_drafts", "clean", extra=DRAFTS),
)
ENTRIES["shop_messages"] = (
    lambda spark, folder: drafts.shop_messages(shops.plan_shops(clean(spark, folder))),
    query("SELECT * FROM shop_drafts", "clean", extra=DRAFTS),
)
ENTRIES["todays_messages"] = (messages, query("SELECT * FROM all_drafts", "clean", extra=DRAFTS))
ENTRIES["action_summary"] = (
    lambda spark, folder: drafts.action_summary(messages(spark, folder)),
    query(
        "SELECT CASE WHEN grouping(lead_category) = 1 THEN 'all' ELSE lead_category END AS lead_category, "
        "CASE WHEN grouping(reply_type) = 1 THEN 'all' ELSE reply_type END AS reply_type, count(*) AS actions "
        "FROM all_drafts GROUP BY ROLLUP (lead_category, reply_type)",
        "clean",
        extra=DRAFTS,
    ),
)

# --- Incremental load --------------------------------------------------------

ENTRIES["known_keys"] = (
    lambda spark, folder: batch.known_keys(clean(spark, folder)),
    query("SELECT key, matched_lead_id FROM known", "known"),
)
ENTRIES["new_rows"] = (
    lambda spark, folder: batch.new_rows(checked(spark, folder)),
    query(f"SELECT {sql.RAW_COLUMNS} FROM fresh", "fresh"),
)
REJECTED = (
    f"SELECT lead_id, coalesce({sql.handle('handle')}, '') AS handle, coalesce(trim(store_name), '') AS store_name, "
    f"reason, {sql.quoted(rules.DUPLICATE_ACTION)} AS action, matched_lead_id FROM checked WHERE reason IS NOT NULL"
)
ENTRIES["rejections"] = (
    lambda spark, folder: batch.rejections(checked(spark, folder)),
    query(REJECTED, "checked"),
)
ENTRIES["clean_new_leads"] = (
    fresh,
    query(f"SELECT {sql.CLEAN_COLUMNS}, personalisation_signals FROM fresh_clean", "fresh_clean"),
)
ENTRIES["append_to_clean"] = (
    lambda spark, folder: batch.append_to_clean(clean(spark, folder), fresh(spark, folder)),
    query(
        f"SELECT {sql.CLEAN_COLUMNS} FROM clean UNION ALL SELECT {sql.CLEAN_COLUMNS} FROM fresh_clean",
        "clean", "fresh_clean",
    ),
)
ENTRIES["load_summary"] = (
    lambda spark, folder: batch.load_summary(
        clean(spark, folder), fixtures.day2_batch(spark, folder), fresh(spark, folder)
    ),
    query(
        "SELECT (SELECT count(*) FROM clean) AS leads_before, (SELECT count(*) FROM day2_batch) AS incoming, "
        "count(*) AS added, count(*) FILTER (lead_type = 'reseller') AS reseller, "
        "count(*) FILTER (lead_type = 'reseller_with_email') AS reseller_with_email, "
        "count(*) FILTER (lead_type = 'physical_shop') AS physical_shop, "
        "count(*) FILTER (lead_type = 'hybrid') AS hybrid, "
        "count(*) FILTER (personalisation_signals <> '') AS with_signals, "
        "(SELECT count(*) FROM day2_batch) - count(*) AS rejected, "
        "(SELECT count(*) FROM clean) + count(*) AS leads_after FROM fresh_clean",
        "clean", "fresh_clean", "day2_batch",
    ),
)

RAW_WALK = {
    "b_ordered": "SELECT *, row_number() OVER (ORDER BY last_touch_date DESC NULLS LAST, lead_id) AS n FROM "
                 f"({sql.keyed('campaign_geo')}) k",
    "b_walk": sql.TABLES["walk"].replace("walk w", "b_walk w").replace("ordered o", "b_ordered o"),
}
ENTRIES["within_batch"] = (
    lambda spark, folder: batch.clean_new_leads(
        batch.new_rows(batch.check_batch(fixtures.campaign_batch(spark, folder), clean(spark, folder))),
        AS_OF,
        within_batch=True,
    ).select("lead_id", "handle", "store_name", "campaign", "reason"),
    query(
        "SELECT o.lead_id, o.handle, o.store_name, b.campaign, b.reason FROM b_ordered o JOIN b_walk w ON o.n = w.n "
        "JOIN campaign_batch b ON b.lead_id = o.lead_id WHERE w.kept",
        "campaign_geo", "campaign_batch",
        extra=RAW_WALK,
    ),
)


@entry("ingest_stream", query(
    f"SELECT 'first_load' AS batch_id, lead_id, lead_type, stage, NULL::VARCHAR AS personalisation_signals FROM clean "
    "UNION ALL SELECT 'stream-0', lead_id, lead_type, stage, personalisation_signals FROM fresh_clean",
    "clean", "fresh_clean",
))
def streamed_load(spark, folder):
    root = scratch_path(spark, "stream")
    base = f"{root}/base"
    tables.append_to_base(clean(spark, folder), base, tables.FIRST_LOAD)
    tables.write_leads(fixtures.day2_batch(spark, folder), f"{root}/incoming")
    stream = ingest_stream(spark, f"{root}/incoming", base, f"{root}/rejected", f"{root}/progress", AS_OF)
    stream.awaitTermination()
    return tables.read_base(spark, base).select(
        # the stream's id differs in every run
        F.regexp_replace("batch_id", "-[0-9a-f-]{36}-", "-").alias("batch_id"),
        "lead_id", "lead_type", "stage", "personalisation_signals",
    )


@entry("keyed_stream", query(
    f"SELECT 'first_load' AS batch_id, lead_id, lead_type, stage, NULL::VARCHAR AS personalisation_signals FROM clean "
    "UNION ALL SELECT 'stream-0', lead_id, lead_type, stage, personalisation_signals FROM fresh_clean",
    "clean", "fresh_clean",
))
def keyed_load(spark, folder):
    """Keys in the stream's state; the second run finds all its leads known."""
    root = scratch_path(spark, "keyed")
    base = f"{root}/base"
    tables.append_to_base(clean(spark, folder), base, tables.FIRST_LOAD)
    incoming = fixtures.day2_batch(spark, folder)
    for leads in (incoming, incoming.where(F.col("lead_id").isNotNull())):
        leads.write.mode("append").parquet(f"{root}/incoming")
        ingest_keyed(spark, f"{root}/incoming", base, f"{root}/rejected", f"{root}/progress", AS_OF)
    return tables.read_base(spark, base).select(
        F.regexp_replace("batch_id", "-[0-9a-f-]{36}-", "-").alias("batch_id"),
        "lead_id", "lead_type", "stage", "personalisation_signals",
    )


WITH_CAMPAIGN = (
    "SELECT 'first_load' AS batch_id, lead_id, lead_type, stage, NULL::VARCHAR AS personalisation_signals, "
    "NULL::VARCHAR AS campaign, NULL::VARCHAR AS reason FROM clean "
    "UNION ALL SELECT '{}', f.lead_id, f.lead_type, f.stage, f.personalisation_signals, b.campaign, b.reason "
    "FROM campaign_clean f JOIN campaign_batch b ON b.lead_id = f.lead_id"
)
CAMPAIGN_COLUMNS = ("lead_id", "lead_type", "stage", "personalisation_signals", "campaign", "reason")


@entry("additional_columns", query(WITH_CAMPAIGN.format("fair"), "clean", "campaign_clean", "campaign_batch"))
def additional_columns(spark, folder):
    """Columns of the batch's own reach the base, one of them named like a column of the check."""
    root = scratch_path(spark, "additional")
    tables.append_to_base(clean(spark, folder), f"{root}/base", tables.FIRST_LOAD)
    load_batch(fixtures.campaign_batch(spark, folder), f"{root}/base", f"{root}/rejected", "fair", AS_OF)
    return tables.read_base(spark, f"{root}/base").select("batch_id", *CAMPAIGN_COLUMNS)


@entry("stream_additional_columns", query(WITH_CAMPAIGN.format("stream-0"), "clean", "campaign_clean", "campaign_batch"))
def stream_additional_columns(spark, folder):
    root = scratch_path(spark, "additional")
    tables.append_to_base(clean(spark, folder), f"{root}/base", tables.FIRST_LOAD)
    tables.write_leads(fixtures.campaign_batch(spark, folder), f"{root}/incoming")
    ingest_stream(
        spark, f"{root}/incoming", f"{root}/base", f"{root}/rejected", f"{root}/progress", AS_OF
    ).awaitTermination()
    return tables.read_base(spark, f"{root}/base").select(
        F.regexp_replace("batch_id", "-[0-9a-f-]{36}-", "-").alias("batch_id"), *CAMPAIGN_COLUMNS
    )


@entry(
    "clean_twice",
    query(
        f"SELECT {sql.CLEAN_COLUMNS}, 'list ' || assigned_bdr AS source_list FROM typed_clean", "typed_clean"
    ),
)
def clean_twice(spark, folder):
    """A cleaned table, read as text and cleaned again: nothing changes."""
    path = scratch_path(spark, "once")
    tables.write_leads(clean_plan.clean_leads(fixtures.typed_leads(spark, folder), AS_OF), path)
    return clean_plan.clean_leads(tables.read_leads(spark, path), AS_OF)


BASE_AND_FRESH = (
    "SELECT 'first_load' AS batch_id, lead_id, lead_type, stage FROM clean "
    "UNION ALL SELECT '{}', lead_id, lead_type, stage FROM fresh_clean"
)


@entry("repeat_batch", query(BASE_AND_FRESH.format("001"), "clean", "fresh_clean"))
def repeat_batch(spark, folder):
    root = scratch_path(spark, "repeat")
    tables.append_to_base(clean(spark, folder), f"{root}/base", tables.FIRST_LOAD)
    for _ in range(2):
        load_batch(fixtures.day2_batch(spark, folder), f"{root}/base", f"{root}/rejected", "001", AS_OF)
    return tables.read_base(spark, f"{root}/base").select("batch_id", "lead_id", "lead_type", "stage")


@entry("two_streams", query(BASE_AND_FRESH.format("one-0"), "clean", "fresh_clean"))
def two_streams(spark, folder):
    root = scratch_path(spark, "streams")
    tables.append_to_base(clean(spark, folder), f"{root}/base", tables.FIRST_LOAD)
    incoming = fixtures.day2_batch(spark, folder)
    tables.write_leads(incoming, f"{root}/one")
    tables.write_leads(incoming.where(F.col("lead_id").isNotNull()), f"{root}/two")  # all known by then
    for name in ("one", "two"):
        ingest_stream(
            spark, f"{root}/{name}", f"{root}/base", f"{root}/rejected", f"{root}/progress-{name}", AS_OF, stream_name=name
        ).awaitTermination()
    return tables.read_base(spark, f"{root}/base").select(
        F.regexp_replace("batch_id", "-[0-9a-f-]{36}-", "-").alias("batch_id"), "lead_id", "lead_type", "stage"
    )


@entry(
    "drop_duplicates_chain",
    "SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS lead_id FROM customer WHERE c_custkey % 2 = 0",
)
def drop_duplicates_chain(spark, folder):
    """Customer i shares a handle with i - 1 and an address with i + 1: every second one stays."""
    key = F.col("c_custkey")
    chain = fixtures.read_table(spark, folder, "customer").select(
        F.lpad(key.cast("string"), 12, "0").alias("lead_id"),
        F.concat(F.lit("seller"), F.expr("c_custkey div 2")).alias("handle"),
        F.concat(F.lit("u"), F.expr("(c_custkey + 1) div 2"), F.lit("@mail.com")).alias("email"),
    )
    leads = clean_plan.prepared_leads(tables.align_raw(chain), AS_OF)
    return identity.drop_duplicates(leads, identity.resolve_duplicates(leads, block_rows=500)).select("lead_id")


@entry("key_index_batch", query(REJECTED, "checked"))
def key_index_batch(spark, folder):
    """The batch check of a load that reads stored keys only, after an earlier attempt of the same batch."""
    root = scratch_path(spark, "indexed")
    tables.append_to_base(clean(spark, folder), f"{root}/base", tables.FIRST_LOAD)
    for _ in range(2):
        load_batch(
            fixtures.day2_batch(spark, folder), f"{root}/base", f"{root}/rejected", "day2", AS_OF, index_path=f"{root}/index"
        )
    return spark.read.parquet(tables.batch_path(f"{root}/rejected", "day2"))


@entry("key_index", query(
    f"SELECT '0:' || lead_id AS key, min(lead_id) AS lead_id, 'first_load' AS batch_id FROM clean GROUP BY ALL HAVING key IS NOT NULL "
    f"UNION ALL SELECT '0:' || lead_id, min(lead_id), 'day2' FROM fresh_clean GROUP BY ALL HAVING '0:' || lead_id IS NOT NULL",
    "clean", "fresh_clean",
))
def stored_keys(spark, folder):
    """Lead ids in the index after a load, which adds the keys of its new leads."""
    root = scratch_path(spark, "indexed")
    tables.append_to_base(clean(spark, folder), f"{root}/base", tables.FIRST_LOAD)
    load_batch(fixtures.day2_batch(spark, folder), f"{root}/base", f"{root}/rejected", "day2", AS_OF, index_path=f"{root}/index")
    return key_index.read_index(spark, f"{root}/index").where(F.col("key").startswith("0:"))


@entry("load_counts", query(
    "SELECT (SELECT count(*) FROM day2_batch) AS incoming, (SELECT count(*) FROM day2_batch) - count(*) AS rejected, "
    "count(*) AS added, count(*) FILTER (lead_type = 'reseller') AS reseller, "
    "count(*) FILTER (lead_type = 'reseller_with_email') AS reseller_with_email, "
    "count(*) FILTER (lead_type = 'physical_shop') AS physical_shop, count(*) FILTER (lead_type = 'hybrid') AS hybrid, "
    "count(*) FILTER (personalisation_signals <> '') AS with_signals FROM fresh_clean",
    "fresh_clean", "day2_batch",
))
def load_counts(spark, folder):
    """What a load says it did: counted while its tables were written, without reading them again."""
    root = scratch_path(spark, "counted")
    tables.append_to_base(clean(spark, folder), f"{root}/base", tables.FIRST_LOAD)
    done = load_batch(fixtures.day2_batch(spark, folder), f"{root}/base", f"{root}/rejected", "day2", AS_OF)
    row = {"incoming": done.incoming, "rejected": done.rejected, "added": done.added, **done.added_by_type, "with_signals": done.with_signals}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{name} bigint" for name in row))


KEPT = query("SELECT lead_id, handle, email, phone, store_name, city, last_touch_date FROM kept", "kept")


@entry("incremental_duplicates", KEPT)
def incremental_duplicates(spark, folder):
    """Three loads that each hold leads of every age end where one run over all of them does."""
    leads = cut_lineage(clean_plan.prepared_leads(raw(spark, folder), AS_OF))
    state = scratch_path(spark, "state")
    share = F.pmod(F.xxhash64("row_id"), F.lit(20))
    for number, own in enumerate((share < 15, (share >= 15) & (share < 18), share >= 18)):
        incremental.absorb(spark, state, leads.where(own), number, parts=16)
        if number == 1:
            incremental.compact(spark, state)
    return identity.drop_duplicates(leads, incremental.resolution(spark, state)).select(
        "lead_id", "handle", "email", "phone", "store_name", "city", "last_touch_date"
    )


@entry("load_batch_rejections", query(REJECTED, "checked"))
def load_batch_rejections(spark, folder):
    root = scratch_path(spark, "load")
    tables.append_to_base(clean(spark, folder), f"{root}/base", tables.FIRST_LOAD)
    load_batch(fixtures.day2_batch(spark, folder), f"{root}/base", f"{root}/rejected", "day2", AS_OF)
    return spark.read.parquet(tables.batch_path(f"{root}/rejected", "day2"))


# --- Reports -----------------------------------------------------------------

for _column in ("stage", "lead_type", "reply_type"):
    ENTRIES[f"{_column}_counts"] = (
        lambda spark, folder, c=_column: report.value_counts(clean(spark, folder), c),
        query(f"SELECT {_column}, count(*) AS leads FROM clean GROUP BY {_column}", "clean"),
    )
ENTRIES["all_counts"] = (
    lambda spark, folder: report.all_counts(clean(spark, folder)),
    query(
        " UNION ALL ".join(
            f"SELECT '{name}' AS counted, {column} AS value, count(*) AS leads FROM clean {where} GROUP BY {column}"
            for name, column, where in (
                ("stage", "stage", ""), ("lead_type", "lead_type", ""), ("reply_type", "reply_type", ""),
                ("reseller_reply", "reply_type", "WHERE lead_type <> 'physical_shop'"),
            )
        ),
        "clean",
    ),
)
ENTRIES["reseller_reply_counts"] = (
    lambda spark, folder: report.reseller_reply_counts(clean(spark, folder)),
    query(
        "SELECT reply_type, count(*) AS leads FROM clean WHERE lead_type <> 'physical_shop' GROUP BY reply_type",
        "clean",
    ),
)
ENTRIES["override_totals"] = (
    lambda spark, folder: report.override_totals(clean(spark, folder)),
    query(
        "SELECT count(*) AS overridden, count(*) FILTER (stage = 'Replied') AS moved_to_replied, "
        "count(*) FILTER (stage = 'Hold') AS moved_to_hold, sum(est_monthly_spend_gbp) AS spend_recovered "
        "FROM clean WHERE stage_overridden",
        "clean",
    ),
)
ENTRIES["override_details"] = (
    lambda spark, folder: report.override_details(clean(spark, folder)),
    query(
        "SELECT lead_id, coalesce(handle, store_name, lead_id) AS identifier, stage_raw, stage AS stage_now, "
        "coalesce(last_inbound_text, '') AS last_said FROM clean WHERE stage_overridden",
        "clean",
    ),
)
ENTRIES["headline_counts"] = (
    lambda spark, folder: report.headline_counts(clean(spark, folder)),
    query(
        "SELECT count(*) AS leads, "
        + ", ".join(
            f"count(*) FILTER (lead_type = '{k}') AS {k}"
            for k in ("reseller", "reseller_with_email", "physical_shop", "hybrid")
        )
        + ", count(*) FILTER (lead_type LIKE 'reseller%') AS resellers, "
        "count(*) FILTER (lead_type IN ('physical_shop', 'hybrid')) AS shops, "
        + ", ".join(
            f"count(*) FILTER (lead_type LIKE 'reseller%' AND reply_type = '{k}') AS resellers_{k}"
            for k in ("hot", "warm", "amber", "new")
        )
        + ", count(*) FILTER (overdue) AS overdue, "
        "count(*) FILTER (NOT email_valid AND email IS NOT NULL) AS invalid_emails FROM clean",
        "clean",
    ),
)
