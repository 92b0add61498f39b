"""Common table expressions, each built on the ones before it.

Only the fixed word lists are shared with the library; the logic is written anew.
"""

from __future__ import annotations

import re

from leadloom import rules
from leadloom.sources.fixtures import CAMPAIGN_BATCH_SQL, CONFIRMATIONS_SQL, DAY2_BATCH_SQL, RAW_LEADS_SQL, TYPED_LEADS_SQL

AS_OF = "DATE '2001-08-02'"

RAW_COLUMNS = (
    "lead_id, handle, contact_name, store_name, email, phone, city, country, followers, active_listings, "
    "sales_velocity_30d, avg_listing_price_gbp, est_monthly_spend_gbp, stage, first_seen_date, "
    "last_touch_date, num_touches, last_inbound_text, notes, assigned_bdr"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(quoted(w) for w in words) + ")"


def has(text: str, words) -> str:
    """Regular expression search for any of the words."""
    pattern = "|".join(re.escape(w) for w in words)
    return f"coalesce(regexp_matches({text}, {quoted(pattern)}), false)"


def blank(column: str) -> str:
    return f"CASE WHEN lower(trim({column})) NOT IN ('', 'nan', 'none') THEN trim({column}) END"


def simple_case(column: str, mapping: dict, default: str) -> str:
    whens = " ".join(
        f"WHEN {column} = {quoted(k)} THEN {quoted(v) if isinstance(v, str) else v}" for k, v in mapping.items()
    )
    return f"CASE {whens} ELSE {default} END"


def handle(column: str) -> str:
    url = r"^(https?://)?(www\.)?instagram\.com/"
    return f"trim(ltrim(regexp_replace(lower(trim({column})), '{url}', ''), '@'))"


def stage(column: str, extra: bool = True) -> str:
    spellings = dict(rules.STAGE_SPELLINGS) | (rules.EXTRA_STAGE_SPELLINGS if extra else {})
    return simple_case(f"lower(trim({column}))", spellings, "'New'")


def day(column: str) -> str:
    return (
        f"CASE WHEN {column} LIKE '____-__-__' THEN try_cast({column} AS DATE) "
        f"WHEN {column} LIKE '__/__/____' THEN try_strptime({column}, '%d/%m/%Y')::DATE "
        f"WHEN try_strptime({column} || ' 2001', '%b %d %Y') <= {AS_OF} "
        f"THEN try_strptime({column} || ' 2001', '%b %d %Y')::DATE "
        f"ELSE try_strptime({column} || ' 2000', '%b %d %Y')::DATE END"
    )


def number(column: str, kind: str = "DOUBLE") -> str:
    return f"try_cast({column} AS {kind})"


def spend(column: str) -> str:
    return f"coalesce(try_cast(replace(replace(trim({column}), '£', ''), ',', '') AS DOUBLE), 0)"


VALID_EMAIL = "regexp_full_match({0}, '[^@]+@[^@]+\\.[^@]+')"


def email_ok(column: str) -> str:
    return f"coalesce({VALID_EMAIL.format(column)}, false)"


def email_key(column: str) -> str:
    merged = f"regexp_replace(regexp_replace(lower(trim({column})), '^invalid: ', ''), '@+', '@', 'g')"
    return f"CASE WHEN length({merged}) - length(replace({merged}, '@', '')) = 1 AND length({merged}) > 3 THEN {merged} END"


def phone_key(column: str) -> str:
    digits = f"regexp_replace({column}, '[^0-9]', '', 'g')"
    bare = f"regexp_replace({digits}, '^00', '')"
    return (
        f"CASE WHEN length({digits}) < 7 THEN NULL "
        f"WHEN {bare} LIKE '44%' AND length({bare}) > 10 THEN '0' || substr({bare}, 3) ELSE {bare} END"
    )


def store_key(store: str, city: str) -> str:
    return f"lower({blank(store)}) || '|' || lower({blank(city)})"


def pounds(value: str) -> str:
    return f"'£' || format('{{:,}}', trunc({value})::BIGINT)"


def message(column: str) -> str:
    core = f"lower(trim(trim(trim({column}), '''\"`')))"
    return f"CASE WHEN {core} NOT IN ('', 'nan', 'none') THEN {core} END"


def hints(column: str) -> str:
    parts = [
        f"CASE WHEN contains(lower({column}), {quoted(word)}) THEN {quoted(rules.Brand().apply(hint))} END"
        for word, hint in rules.NOTE_HINTS.items()
    ]
    joined = f"concat_ws(' | ', {', '.join(parts)})"
    return f"CASE WHEN {column} IS NULL THEN '' WHEN {joined} <> '' THEN {joined} ELSE {column} END"


def reply_words(msg: str) -> str:
    """Reply type by whole message, then by phrases."""
    return f"""CASE WHEN {msg} IS NULL THEN 'amber'
      WHEN {msg} IN {in_list(rules.EXACT_MEETING + rules.EXACT_HOT)} THEN 'hot'
      WHEN {msg} IN {in_list(rules.EXACT_WARM + rules.EXACT_HOLD)} THEN 'warm'
      WHEN {has(msg, rules.LOST_PHRASES)} THEN 'cold'
      WHEN {has(msg, rules.MEETING_PHRASES)} THEN 'hot'
      WHEN {has(msg, rules.HOLD_PHRASES + rules.WARM_PHRASES)} THEN 'warm'
      ELSE 'hot' END"""


def objection(msg: str) -> str:
    whens = " ".join(
        f"WHEN {has(msg, words)} THEN {quoted(kind)}" for kind, words in rules.OBJECTION_PHRASES.items()
    )
    return f"CASE {whens} ELSE 'none' END"


def reconciled(s: str = "stage") -> str:
    hold = rules.EXACT_HOLD + rules.EXACT_WARM + rules.HOLD_PHRASES + rules.WARM_PHRASES
    return f"""CASE
      WHEN {has('msg', rules.LOST_PHRASES)} THEN 'Lost'
      WHEN {has('msg', hold)} THEN 'Hold'
      WHEN {has('msg', rules.EXACT_MEETING + rules.MEETING_PHRASES)} THEN 'Meeting Booked'
      WHEN {has('msg', rules.EXACT_HOT + rules.HOT_PHRASES)} THEN 'Replied'
      WHEN msg IS NULL AND {s} IN ('Replied', 'Negotiating')
        THEN CASE WHEN coalesce(num_touches, 0) = 0 THEN 'New' ELSE 'Contacted' END
      WHEN msg IS NULL AND {s} = 'New' AND num_touches > 0 THEN 'Contacted'
      WHEN {s} = 'Won' AND msg IS NULL
        THEN CASE WHEN est_monthly_spend_gbp >= 1000 AND coalesce(num_touches, 0) >= 2 THEN 'Won' ELSE 'Hold' END
      WHEN {s} = 'Won' AND {has('msg', rules.WON_FOLLOW_UP_PHRASES)} THEN 'Replied'
      WHEN {s} = 'Won' THEN 'Won'
      WHEN {s} = 'Negotiating' THEN 'Replied'
      WHEN {s} = 'Lost' AND msg IS NULL THEN CASE
        WHEN coalesce(num_touches, 0) <= 1 AND est_monthly_spend_gbp >= 3000 THEN 'Hold'
        WHEN num_touches >= 5 THEN 'Lost'
        WHEN est_monthly_spend_gbp >= 5000 THEN 'Hold' ELSE 'Lost' END
      WHEN {s} IN ('Lost', 'Contacted') AND length(msg) > 3
        THEN CASE {s} WHEN 'Lost' THEN 'Hold' ELSE 'Replied' END
      ELSE {s} END"""


def normalised(source: str) -> str:
    passed = ("lead_id", "contact_name", "store_name", "phone", "city", "country", "last_inbound_text", "notes",
              "assigned_bdr")
    return f"""SELECT {', '.join(f'{blank(c)} AS {c}' for c in passed)},
      nullif({handle(f'({blank("handle")})')}, '') AS handle,
      trim(email) AS typed_email,
      {email_ok('trim(email)')} AS email_valid,
      CASE WHEN {email_ok('trim(email)')} THEN trim(email) ELSE 'INVALID: ' || trim(email) END AS email,
      {number('followers', 'BIGINT')} AS followers, {number('active_listings', 'BIGINT')} AS active_listings,
      {number('sales_velocity_30d', 'BIGINT')} AS sales_velocity_30d,
      {number('num_touches', 'BIGINT')} AS num_touches,
      {number('avg_listing_price_gbp')} AS avg_listing_price_gbp,
      {spend('est_monthly_spend_gbp')} AS est_monthly_spend_gbp,
      {stage('stage')} AS stage, trim(stage) AS stage_raw,
      {day('first_seen_date')} AS first_seen_date, {day('last_touch_date')} AS last_touch_date,
      coalesce(trim(followers) NOT IN ('', '0', 'nan'), false)
        OR coalesce(trim(sales_velocity_30d) NOT IN ('', '0', 'nan'), false) AS has_metrics
    FROM {source}"""


def repaired(source: str) -> str:
    """Geography; the place words are joined as a table and the first one wins."""
    places = ", ".join(
        f"({i}, {quoted(w)}, {quoted(c)})" for i, (w, c) in enumerate(rules.STORE_NAME_PLACES.items())
    )
    known = in_list(sorted(set(rules.STORE_NAME_PLACES.values())))
    warning = quoted(rules.PHONE_COUNTRY_WARNING)
    return f"""SELECT * EXCLUDE (place, abroad, uk_mail) REPLACE (
        CASE WHEN place IS NOT NULL THEN place
             WHEN uk_mail AND upper(left(city, 1)) || lower(substr(city, 2)) IN {known} THEN city
             WHEN uk_mail THEN 'London' ELSE city END AS city,
        CASE WHEN place IS NOT NULL OR uk_mail THEN 'UK' ELSE country END AS country,
        CASE WHEN abroad AND (place IS NOT NULL OR uk_mail)
               AND coalesce(regexp_matches(regexp_replace(phone, '[ ()-]', '', 'g'), '^(\\+1|001)'), false)
             THEN {warning} || coalesce(' ' || notes, '') ELSE notes END AS notes),
        abroad AND (place IS NOT NULL OR uk_mail) AS forced_uk,
        abroad AND (place IS NOT NULL OR uk_mail)
          AND coalesce(regexp_matches(regexp_replace(phone, '[ ()-]', '', 'g'), '^(\\+1|001)'), false) AS geo_flag
      FROM (SELECT n.*,
          (SELECT arg_min(p.place, p.i) FROM (VALUES {places}) AS p(i, word, place)
            WHERE contains(lower(n.store_name), p.word)) AS place,
          upper(coalesce(country, '')) NOT IN ('UK', 'UNITED KINGDOM') AS abroad,
          coalesce(lower(typed_email) LIKE '%.co.uk', false)
            AND upper(coalesce(country, '')) NOT IN ('UK', 'UNITED KINGDOM') AS uk_mail
        FROM {source} n) x"""


def keyed(source: str, email: str = "typed_email") -> str:
    return f"""SELECT *, list_filter([
        '0:' || lead_id, '1:' || CASE WHEN length(handle) > 1 THEN handle END, '2:' || {email_key(email)},
        '3:' || {phone_key('phone')}, '4:' || {store_key('store_name', 'city')}], lambda x: x IS NOT NULL) AS keys
      FROM {source}"""


def classified(source: str) -> str:
    return f"""SELECT *,
        CASE WHEN msg IS NULL THEN CASE WHEN coalesce(num_touches, 0) = 0 AND notes IS NULL THEN 'new' ELSE 'amber' END
             WHEN overdue THEN 'hot' ELSE said END AS reply_type,
        {objection('msg')} AS obj_type
      FROM (SELECT *,
          said IN ('hot', 'warm') AND stage <> 'Hold'
            AND coalesce(date_diff('day', last_touch_date, {AS_OF}) BETWEEN 8 AND 729, false) AS overdue
        FROM (SELECT * EXCLUDE (stage), {reconciled()} AS stage, {reconciled()} <> stage AS stage_overridden,
            {reply_words('msg')} AS said,
            CASE WHEN has_metrics AND handle IS NOT NULL AND (city IS NOT NULL OR store_name IS NOT NULL) THEN 'hybrid'
                 WHEN has_metrics AND email_valid THEN 'reseller_with_email'
                 WHEN has_metrics THEN 'reseller' ELSE 'physical_shop' END AS lead_type
          FROM (SELECT *, {message('last_inbound_text')} AS msg FROM {source}) m) c) o"""


CLEAN_COLUMNS = RAW_COLUMNS + ", email_valid, lead_type, stage_raw, stage_overridden, reply_type, obj_type, overdue, has_metrics"

DUPLICATE_REASON = (
    "CASE left(hit, 1) WHEN '0' THEN 'lead_id ' || substr(hit, 3) || ' already in pipeline' "
    "WHEN '1' THEN 'handle @' || substr(hit, 3) || ' already in pipeline' "
    "WHEN '2' THEN 'email ' || substr(hit, 3) || ' already in pipeline' "
    "WHEN '3' THEN 'phone ' || substr(hit, 3) || ' already in pipeline (possible duplicate store)' "
    "ELSE 'store ''' || coalesce(trim(store_name), '') || ''' in ' || coalesce(trim(city), '') "
    "|| ' already in pipeline' END"
)

TABLES: dict[str, str] = {
    "raw_leads": RAW_LEADS_SQL.format(customer="customer", orders="orders"),
    "day2_batch": DAY2_BATCH_SQL.format(raw_leads="raw_leads"),
    "campaign_batch": CAMPAIGN_BATCH_SQL.format(day2_batch="day2_batch"),
    "typed_leads": TYPED_LEADS_SQL.format(raw_leads="raw_leads"),
    "typed_norm": normalised("typed_leads"),
    "typed_geo": repaired("typed_norm"),
    "typed_ordered": "SELECT *, row_number() OVER (ORDER BY last_touch_date DESC NULLS LAST, lead_id) AS n FROM "
                     f"({keyed('typed_geo')}) k",
    "confirmations": CONFIRMATIONS_SQL.format(raw_leads="raw_leads"),
    "norm": normalised("raw_leads"),
    "geo": repaired("norm"),
    "keyed": keyed("geo"),
    "ordered": "SELECT *, row_number() OVER (ORDER BY last_touch_date DESC NULLS LAST, lead_id) AS n FROM keyed",
    # The walk over all rows, one at a time, with the keys of the kept rows.
    "walk": """SELECT 0::BIGINT AS n, false AS kept, []::VARCHAR[] AS seen
      UNION ALL
      SELECT o.n, NOT list_has_any(w.seen, o.keys),
        CASE WHEN list_has_any(w.seen, o.keys) THEN w.seen ELSE list_concat(w.seen, o.keys) END
      FROM walk w JOIN ordered o ON o.n = w.n + 1""",
    "kept": "SELECT o.* FROM ordered o JOIN walk w ON o.n = w.n WHERE w.kept",
    "single": classified("geo"),
    "clean": classified("kept"),
    "known": "SELECT key, min(lead_id) AS matched_lead_id FROM "
             "(SELECT lead_id, unnest(keys) AS key FROM kept) k GROUP BY key",
    "batch_keys": f"""SELECT b.*, row_number() OVER (ORDER BY lead_id) AS i, list_filter([
        '0:' || {blank('lead_id')},
        '1:' || CASE WHEN length({handle('handle')}) > 1 THEN {handle('handle')} END,
        '2:' || {email_key('email')}, '3:' || {phone_key('phone')},
        '4:' || {store_key('store_name', 'city')}], lambda x: x IS NOT NULL) AS keys FROM day2_batch b""",
    "checked": f"""SELECT b.*, {DUPLICATE_REASON} AS reason, m.matched_lead_id FROM batch_keys b LEFT JOIN (
        SELECT i, min(key) AS hit, arg_min(matched_lead_id, key) AS matched_lead_id FROM
          (SELECT i, unnest(keys) AS key FROM batch_keys) x JOIN known USING (key) GROUP BY i) m USING (i)
      """.replace(DUPLICATE_REASON, f"CASE WHEN m.hit IS NOT NULL THEN {DUPLICATE_REASON} END"),
    "fresh": "SELECT * FROM checked WHERE reason IS NULL",
    "fresh_norm": normalised("fresh"),
    "fresh_geo": repaired("fresh_norm"),
    "fresh_clean": f"SELECT *, {hints('notes')} AS personalisation_signals FROM ({classified('fresh_geo')}) f",
}

TABLES["typed_walk"] = TABLES["walk"].replace("walk w", "typed_walk w").replace("ordered o", "typed_ordered o")
TABLES["typed_clean"] = classified("(SELECT o.* FROM typed_ordered o JOIN typed_walk w ON o.n = w.n WHERE w.kept) k")
TABLES["campaign_keys"] = TABLES["batch_keys"].replace("day2_batch", "campaign_batch").replace("b.*", "b.* EXCLUDE (campaign, reason)")
TABLES["campaign_checked"] = TABLES["checked"].replace("batch_keys", "campaign_keys")
TABLES["campaign_fresh"] = TABLES["fresh"].replace("checked", "campaign_checked")
TABLES["campaign_norm"] = normalised("campaign_fresh")
TABLES["campaign_geo"] = repaired("campaign_norm")
TABLES["campaign_clean"] = f"SELECT *, {hints('notes')} AS personalisation_signals FROM ({classified('campaign_geo')}) f"

NEEDS = {
    "day2_batch": ("raw_leads",), "confirmations": ("raw_leads",), "norm": ("raw_leads",), "geo": ("norm",),
    "keyed": ("geo",), "ordered": ("keyed",), "walk": ("ordered",), "kept": ("walk", "ordered"), "single": ("geo",),
    "clean": ("kept",), "known": ("kept",), "batch_keys": ("day2_batch",), "checked": ("batch_keys", "known"),
    "campaign_batch": ("day2_batch",), "typed_leads": ("raw_leads",), "typed_norm": ("typed_leads",),
    "typed_geo": ("typed_norm",), "typed_ordered": ("typed_geo",),
    "typed_walk": ("typed_ordered",), "typed_clean": ("typed_walk", "typed_ordered"),
    "campaign_keys": ("campaign_batch",), "campaign_checked": ("campaign_keys", "known"), "campaign_fresh": ("campaign_checked",),
    "campaign_norm": ("campaign_fresh",), "campaign_geo": ("campaign_norm",), "campaign_clean": ("campaign_geo",),
    "fresh": ("checked",), "fresh_norm": ("fresh",), "fresh_geo": ("fresh_norm",), "fresh_clean": ("fresh_geo",),
}


def query(sql: str, *tables: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause with the tables the query needs, in order, then the query."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for need in NEEDS.get(name, ()):
                add(need)

    for table in tables:
        add(table)
    parts = [f"{name} AS ({body})" for name, body in TABLES.items() if name in wanted]
    parts += [f"{name} AS ({body})" for name, body in (extra or {}).items()]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + sql if parts else sql
