"""Lead tables derived from the ``customer`` and ``orders`` tables.

The texts are plain SQL with table names in braces; they give the same rows in
any engine, which is what the result comparison relies on.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

AS_OF = date(2001, 8, 2)

RAW_LEADS_SQL = """\
WITH o AS (
  SELECT o_custkey, COUNT(*) AS n_orders, MIN(CAST(o_orderdate AS DATE)) AS d0, MAX(CAST(o_orderdate AS DATE)) AS d1
  FROM {orders} GROUP BY o_custkey),
b AS (
  SELECT c_custkey AS k, CAST(FLOOR(ABS(c_acctbal)) AS BIGINT) AS spend, c_custkey % 10 AS ch,
         CASE WHEN c_custkey % 7 = 3 AND c_custkey >= 10 THEN c_custkey - 10 ELSE c_custkey END AS kh,
         CASE WHEN c_custkey % 11 = 5 AND c_custkey >= 30 THEN c_custkey - 30 ELSE c_custkey END AS ke,
         CASE WHEN c_custkey % 13 = 4 AND c_custkey >= 20 THEN c_custkey - 20 ELSE c_custkey END AS kp,
         CASE WHEN c_custkey % 17 = 6 AND c_custkey >= 10 THEN c_custkey - 10 ELSE c_custkey END AS ks,
         COALESCE(n_orders, 0) AS n_orders, d0, d1
  FROM {customer} LEFT JOIN o ON c_custkey = o_custkey),
city AS (SELECT * FROM (VALUES (0,'Manchester','UK'),(1,'leeds ','UK'),(2,'London','uk'),(3,'Paris','France'),
  (4,'Austin','US'),(5,'Bristol','United Kingdom'),(6,'Berlin','Germany'),(7,'Brighton',NULL),(8,NULL,'UK')) AS t(ci, city, country)),
stg AS (SELECT * FROM (VALUES (0,'new'),(1,'Contacted '),(2,'WARM'),(3,'call-booked'),(4,'in negotiation'),(5,'closed won'),
  (6,'ghosted'),(7,NULL),(8,'contaced'),(9,'lost'),(10,'replied'),(11,'won')) AS t(si, stage)),
msg AS (SELECT * FROM (VALUES (0,NULL),(1,'Happy to chat, mornings best.'),(2,'''ok sounds good when can we talk'),(3,'Interested - send pricing.'),
  (4,'do you ship to EU?'),(5,'interested but busy this week'),(6,'Owner is back next week, call then.'),(7,'We already sell on Vinted.'),
  (8,'already on another platform tbh'),(9,'need to think about it'),(10,'Not taking on new channels currently.'),(11,'Too busy this season, try later.'),
  (12,'maybe next month'),(13,'not interested right now'),(14,'please stop messaging me'),(15,'maybe thursday'),(16,'ok'),(17,'yeah keen, drop details'),
  (18,NULL),(19,'nan'),(20,'no idea what this is about'),(21,NULL),(22,'whats your commission?')) AS t(mi, txt)),
nt AS (SELECT * FROM (VALUES (0,NULL),(1,'big menswear focus, high engagement'),(2,'met at market'),(3,'price sensitive; slow to reply'),(4,'free text only'),
  (5,'mail shop@vintage.co.uk'),(6,NULL),(7,'big consignment, follows competitor')) AS t(ni, notes))
SELECT 'L' || LPAD(CAST(k AS VARCHAR(20)), 7, '0') AS lead_id,
  CASE WHEN ch = 5 THEN NULL WHEN k % 4 = 0 THEN '@Seller' || CAST(kh AS VARCHAR(20)) WHEN k % 4 = 1 THEN 'instagram.com/seller' || CAST(kh AS VARCHAR(20))
       WHEN k % 4 = 2 THEN ' seller' || CAST(kh AS VARCHAR(20)) || ' ' ELSE 'SELLER' || CAST(kh AS VARCHAR(20)) END AS handle,
  'Contact ' || CAST(k % 97 AS VARCHAR(20)) AS contact_name,
  CASE WHEN ch >= 5 THEN CASE WHEN k % 19 = 0 THEN 'Camden Rail ' ELSE 'Shop ' END || CAST(ks AS VARCHAR(20)) END AS store_name,
  CASE WHEN ch IN (0,1,2,3) THEN NULL WHEN k % 23 = 1 THEN 'u' || CAST(ke AS VARCHAR(20)) || '@@mail.com' WHEN k % 23 = 2 THEN 'bad-address'
       WHEN k % 6 = 0 THEN 'U' || CAST(ke AS VARCHAR(20)) || '@shop.co.uk' ELSE 'u' || CAST(ke AS VARCHAR(20)) || '@mail.com' END AS email,
  CASE WHEN ch < 5 THEN NULL WHEN k % 4 = 0 THEN '+44 7' || LPAD(CAST(kp AS VARCHAR(20)), 9, '0') WHEN k % 4 = 1 THEN '07' || LPAD(CAST(kp AS VARCHAR(20)), 9, '0')
       ELSE '+1 (878) ' || LPAD(CAST(kp AS VARCHAR(20)), 7, '0') END AS phone,
  CASE WHEN ch >= 5 THEN city END AS city, CASE WHEN ch >= 5 THEN country END AS country,
  CASE WHEN ch < 5 OR ch = 9 THEN CAST((k * 7919) % 65000 AS VARCHAR(20)) END AS followers,
  CASE WHEN ch < 5 THEN CAST((k * 17) % 600 AS VARCHAR(20)) END AS active_listings,
  CASE WHEN ch < 5 THEN CAST((k * 31) % 214 AS VARCHAR(20)) END AS sales_velocity_30d,
  CASE WHEN ch < 5 THEN CAST(5 + (k * 13) % 66 AS VARCHAR(20)) END AS avg_listing_price_gbp,
  CASE WHEN k % 29 = 0 THEN NULL WHEN k % 29 = 1 THEN 'tbc'
       WHEN k % 3 = 0 AND spend >= 1000 THEN '£' || SUBSTR(CAST(spend AS VARCHAR(20)), 1, 1) || ',' || SUBSTR(CAST(spend AS VARCHAR(20)), 2, 3)
       WHEN k % 3 = 1 THEN '£' || CAST(spend AS VARCHAR(20)) ELSE CAST(spend AS VARCHAR(20)) END AS est_monthly_spend_gbp,
  stage, CAST(d0 AS VARCHAR(20)) AS first_seen_date,
  CASE WHEN d1 IS NULL OR k % 31 = 0 THEN NULL WHEN k % 3 = 0 THEN CAST(d1 AS VARCHAR(20))
       WHEN k % 3 = 1 THEN LPAD(CAST(EXTRACT(DAY FROM d1) AS VARCHAR(20)), 2, '0') || '/' || LPAD(CAST(EXTRACT(MONTH FROM d1) AS VARCHAR(20)), 2, '0') || '/' || CAST(EXTRACT(YEAR FROM d1) AS VARCHAR(20))
       ELSE SUBSTR('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(EXTRACT(MONTH FROM d1) AS INT) * 3 - 2, 3) || ' ' || CAST(EXTRACT(DAY FROM d1) AS VARCHAR(20)) END AS last_touch_date,
  CASE WHEN k % 37 = 0 THEN NULL ELSE CAST((k * 5) % 8 AS VARCHAR(20)) END AS num_touches,
  txt AS last_inbound_text, notes,
  'bdr_' || CAST(k % 3 AS VARCHAR(20)) AS assigned_bdr
FROM b JOIN city ON k % 9 = ci JOIN stg ON k % 12 = si JOIN msg ON k % 23 = mi JOIN nt ON k % 8 = ni
"""

DAY2_BATCH_SQL = """\
SELECT CASE WHEN n % 28 = 0 THEN lead_id ELSE 'N' || SUBSTR(lead_id, 2) END AS lead_id,
  CASE WHEN n % 2 = 0 THEN handle WHEN handle IS NOT NULL THEN 'fresh' || CAST(n AS VARCHAR(20)) END AS handle,
  contact_name,
  CASE WHEN n % 2 = 0 THEN store_name WHEN store_name IS NOT NULL THEN 'Fresh ' || CAST(n AS VARCHAR(20)) END AS store_name,
  CASE WHEN n % 2 = 0 THEN email WHEN email IS NOT NULL THEN 'fresh' || CAST(n AS VARCHAR(20)) || '@new.org' END AS email,
  CASE WHEN n % 2 = 0 THEN phone WHEN phone IS NOT NULL THEN '+33 9' || LPAD(CAST(n AS VARCHAR(20)), 8, '0') END AS phone,
  city, country, followers, active_listings, sales_velocity_30d, avg_listing_price_gbp, est_monthly_spend_gbp, stage,
  first_seen_date, last_touch_date, num_touches, last_inbound_text, notes, assigned_bdr
FROM (SELECT r.*, CAST(SUBSTR(lead_id, 2) AS BIGINT) AS n FROM {raw_leads} r) x
WHERE n % 7 = 0
"""

CONFIRMATIONS_SQL = """\
SELECT lead_id, DATE '2001-08-07' AS confirmed_for FROM {raw_leads}
WHERE store_name IS NOT NULL AND CAST(SUBSTR(lead_id, 2) AS BIGINT) % 3 = 0
"""


# Agreed visits for every fourth lead, shop or not, and as many for leads that nobody knows.
STRANGE_CONFIRMATIONS_SQL = """\
SELECT lead_id, DATE '2001-08-07' AS confirmed_for FROM {raw_leads} WHERE CAST(SUBSTR(lead_id, 2) AS BIGINT) % 4 = 0
UNION ALL SELECT 'X' || SUBSTR(lead_id, 2), DATE '2001-08-07' FROM {raw_leads} WHERE CAST(SUBSTR(lead_id, 2) AS BIGINT) % 4 = 1
"""

# The day-2 batch with a column of its own, and every third of its leads a second time under another id.
CAMPAIGN_BATCH_SQL = """\
SELECT d.*, 'fair ' || SUBSTR(lead_id, 8, 1) AS campaign, 'typed' AS reason FROM {day2_batch} d
UNION ALL
SELECT 'R' || SUBSTR(lead_id, 2) AS lead_id, handle, contact_name, store_name, email, phone, city, country, followers,
  active_listings, sales_velocity_30d, avg_listing_price_gbp, est_monthly_spend_gbp, stage, first_seen_date,
  last_touch_date, num_touches, last_inbound_text, notes, assigned_bdr, NULL AS campaign, 'again' AS reason
FROM {day2_batch} WHERE CAST(SUBSTR(lead_id, 2) AS BIGINT) % 3 = 0
"""

# Raw leads whose metrics only the text tells apart: not a number, and zero written with a decimal.
TYPED_LEADS_SQL = """\
SELECT lead_id, handle, contact_name, store_name, email, phone, city, country,
  CASE WHEN CAST(SUBSTR(lead_id, 2) AS BIGINT) % 5 = 0 THEN 'tbc' WHEN CAST(SUBSTR(lead_id, 2) AS BIGINT) % 5 = 1 THEN '0.0'
       ELSE followers END AS followers,
  active_listings, CASE WHEN CAST(SUBSTR(lead_id, 2) AS BIGINT) % 10 < 7 THEN sales_velocity_30d END AS sales_velocity_30d,
  avg_listing_price_gbp, est_monthly_spend_gbp, stage, first_seen_date, last_touch_date, num_touches, last_inbound_text,
  notes, assigned_bdr, 'list ' || assigned_bdr AS source_list
FROM {raw_leads}
"""


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_leads(spark: SparkSession, folder: str) -> DataFrame:
    """One messy lead per customer."""
    return spark.sql(
        RAW_LEADS_SQL, customer=read_table(spark, folder, "customer"), orders=read_table(spark, folder, "orders")
    )


def day2_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh lead again: known ids, known identities and new ones."""
    return spark.sql(DAY2_BATCH_SQL, raw_leads=raw_leads(spark, folder))


def campaign_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The day-2 batch with additional columns and duplicates inside the batch."""
    return spark.sql(CAMPAIGN_BATCH_SQL, day2_batch=day2_batch(spark, folder))


def typed_leads(spark: SparkSession, folder: str) -> DataFrame:
    """Raw leads with metrics such as ``tbc`` and ``0.0``, and a column of their own."""
    return spark.sql(TYPED_LEADS_SQL, raw_leads=raw_leads(spark, folder))


def confirmations(spark: SparkSession, folder: str) -> DataFrame:
    """Agreed visits for a third of the shops."""
    return spark.sql(CONFIRMATIONS_SQL, raw_leads=raw_leads(spark, folder))


def strange_confirmations(spark: SparkSession, folder: str) -> DataFrame:
    """Agreed visits, most of them for leads that are no shop or do not exist."""
    return spark.sql(STRANGE_CONFIRMATIONS_SQL, raw_leads=raw_leads(spark, folder))
