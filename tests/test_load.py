from datetime import date

import pytest

from pyspark.sql import functions as F

from leadloom.operators import batch
from leadloom.plans.clean import clean_leads
from leadloom.session import scratch_path
from leadloom.sources import tables
from leadloom.streaming.ingest import ingest_stream, load_batch

AS_OF = date(2026, 1, 1)

OLD = {"lead_id": "L0130", "handle": "@heritagefinds", "stage": "new"}
SAME = {"lead_id": "L0295", "handle": "instagram.com/HeritageFinds"}
NEW = {"lead_id": "L0300", "handle": "@heritagefinds_", "followers": "10", "notes": "slow to reply"}
NEXT = {"lead_id": "L0301", "handle": "heritagefinds_ "}


def start(spark, leads):
    root = scratch_path(spark, "test")
    tables.append_to_base(clean_leads(leads(OLD), AS_OF), f"{root}/base", tables.FIRST_LOAD)
    return root


def test_a_batch_is_split_into_new_and_rejected(leads):
    checked = batch.check_batch(leads(SAME, NEW), clean_leads(leads(OLD), AS_OF))
    rejected = batch.rejections(checked).collect()
    assert [(r.lead_id, r.handle, r.reason, r.matched_lead_id) for r in rejected] == [
        ("L0295", "heritagefinds", "handle @heritagefinds already in pipeline", "L0130")
    ]
    fresh = batch.clean_new_leads(batch.new_rows(checked), AS_OF).collect()
    assert [(r.lead_id, r.lead_type, r.personalisation_signals) for r in fresh] == [
        ("L0300", "reseller", "Slow to reply — keep message very short and direct")
    ]


def test_duplicates_inside_a_batch_stay_unless_asked(leads):
    checked = batch.check_batch(leads(NEW, NEXT, NEW), clean_leads(leads(OLD), AS_OF))
    assert batch.clean_new_leads(batch.new_rows(checked), AS_OF).count() == 3
    assert batch.clean_new_leads(batch.new_rows(checked), AS_OF, within_batch=True).count() == 1


def test_all_duplicates_are_still_logged(spark, leads):
    root = start(spark, leads)
    load_batch(leads(SAME), f"{root}/base", f"{root}/rejected", 1, AS_OF)
    assert tables.read_base(spark, f"{root}/base").count() == 1
    assert spark.read.parquet(f"{root}/rejected").count() == 1


def test_a_repeated_batch_adds_nothing(spark, leads):
    root = start(spark, leads)
    for _ in range(2):
        load_batch(leads(SAME, NEW), f"{root}/base", f"{root}/rejected", 1, AS_OF)
    assert tables.read_base(spark, f"{root}/base").count() == 2
    load_batch(leads(NEXT), f"{root}/base", f"{root}/rejected", 2, AS_OF)
    assert tables.read_base(spark, f"{root}/base").count() == 2


def test_the_first_batch_starts_the_base(spark, leads):
    root = scratch_path(spark, "test")
    load_batch(leads(OLD), f"{root}/base", f"{root}/rejected", 1, AS_OF)
    assert tables.read_base(spark, f"{root}/base").count() == 1


def test_stream_sees_leads_of_earlier_batches(spark, leads):
    root = start(spark, leads)

    def run():
        ingest_stream(
            spark, f"{root}/incoming", f"{root}/base", f"{root}/rejected", f"{root}/progress", AS_OF,
            max_files_per_batch=1,
        ).awaitTermination()

    leads(SAME, NEW).coalesce(1).write.parquet(f"{root}/incoming")
    run()
    leads(NEXT).coalesce(1).write.mode("append").parquet(f"{root}/incoming")
    run()
    run()
    base = tables.read_base(spark, f"{root}/base")
    assert sorted(r.lead_id for r in base.collect()) == ["L0130", "L0300"]
    rejected = spark.read.parquet(f"{root}/rejected")
    assert sorted(r.lead_id for r in rejected.collect()) == ["L0295", "L0301"]


def test_base_may_gain_columns(spark, leads):
    root = start(spark, leads)
    extra = clean_leads(leads(NEW), AS_OF).withColumn("source", F.lit("fair"))
    tables.append_to_base(extra, f"{root}/base", 2)
    assert sorted((r.lead_id, r.source) for r in tables.read_base(spark, f"{root}/base").collect()) == [
        ("L0130", None), ("L0300", "fair")
    ]


def test_a_batch_brings_columns_of_its_own(spark, leads):
    root = start(spark, leads)
    rows = leads(SAME, NEW).withColumns({"campaign": F.lit("fair"), "reason": F.lit("typed"), "hit": F.lit("h")})
    load_batch(rows, f"{root}/base", f"{root}/rejected", 1, AS_OF)
    load_batch(leads({"lead_id": "L9", "handle": "@other"}).withColumn("campaign", F.lit(7)), f"{root}/base", f"{root}/rejected", 2, AS_OF)
    base = tables.read_base(spark, f"{root}/base").orderBy("lead_id").collect()
    assert [(r.lead_id, r.campaign, r.reason, r.hit) for r in base] == [
        ("L0130", None, None, None), ("L0300", "fair", "typed", "h"), ("L9", "7", None, None)
    ]
    rejected = spark.read.parquet(tables.batch_path(f"{root}/rejected", 1)).first()
    assert rejected.reason.startswith("handle") and rejected.additional == '{"campaign":"fair","reason":"typed","hit":"h"}'


def test_columns_are_found_whatever_their_case(spark):
    found = tables.align_raw(spark.createDataFrame([("L1", "a@b.c", "x")], "Lead_ID string, EMAIL string, Own string")).first()
    assert (found.lead_id, found.email, found.Own) == ("L1", "a@b.c", "x")


def test_csv_round_trip_keeps_text(spark, leads):
    path = scratch_path(spark, "csv")
    raw = leads({"lead_id": "L1", "notes": 'said "hi",\nthen left', "handle": " @x "}, {"lead_id": "L2", "notes": "nan"})
    tables.write_leads(raw, path, "csv")
    assert tables.read_leads(spark, path, "csv").exceptAll(raw).isEmpty()


def test_csv_columns_are_found_by_name(spark, leads):
    path = scratch_path(spark, "csv")
    raw = leads({"lead_id": "L1", "handle": "ab", "notes": "n"})
    tables.write_leads(raw.select("notes", "handle", "lead_id"), path, "csv")
    found = tables.read_leads(spark, path, "csv").first()
    assert (found.lead_id, found.handle, found.notes, found.city) == ("L1", "ab", "n", None)


def test_stream_reads_csv(spark, leads):
    root = start(spark, leads)
    rows = leads(SAME, NEW).select(F.lit("fair").alias("campaign"), "notes", "handle", "lead_id", "followers")
    tables.write_leads(rows.coalesce(1), f"{root}/incoming", "csv")
    ingest_stream(
        spark, f"{root}/incoming", f"{root}/base", f"{root}/rejected", f"{root}/progress", AS_OF, file_format="csv"
    ).awaitTermination()
    base = tables.read_base(spark, f"{root}/base").collect()
    assert sorted((r.lead_id, r.campaign) for r in base) == [("L0130", None), ("L0300", "fair")]


def test_append_to_clean_keeps_the_columns(leads):
    clean = clean_leads(leads(OLD), AS_OF)
    new = batch.clean_new_leads(leads(NEW), AS_OF)
    assert batch.append_to_clean(clean, new).columns == clean.columns
    assert batch.append_columns(clean, new).columns == [*clean.columns, "personalisation_signals"]


def test_repeated_batches_keep_their_rows_whatever_the_id(spark, leads):
    root = scratch_path(spark, "test")
    for batch_id in ("001", "001", "002", "2026-06-30", "1e3", "1e3", "a/b c"):
        own = {"lead_id": f"L{batch_id}", "handle": f"@seller {batch_id}"}
        load_batch(leads(own), f"{root}/base", f"{root}/rejected", batch_id, AS_OF)
    base = tables.read_base(spark, f"{root}/base").collect()
    assert sorted((r.lead_id, r.batch_id) for r in base) == [
        (f"L{i}", i) for i in ("001", "002", "1e3", "2026-06-30", "a/b c")
    ]


def test_two_streams_keep_each_others_leads(spark, leads):
    root = scratch_path(spark, "test")

    def run(source, progress):
        ingest_stream(
            spark, f"{root}/{source}", f"{root}/base", f"{root}/rejected", f"{root}/{progress}", AS_OF, stream_name="crm"
        ).awaitTermination()

    leads({"lead_id": "A", "handle": "@first"}).write.parquet(f"{root}/one")
    leads({"lead_id": "B", "handle": "@second"}).write.parquet(f"{root}/two")
    run("one", "p1")
    run("two", "p2")
    leads({"lead_id": "C", "handle": "@third"}).write.mode("append").parquet(f"{root}/one")
    run("one", "p1")
    run("one", "lost")
    assert sorted(r.lead_id for r in tables.read_base(spark, f"{root}/base").collect()) == ["A", "B", "C"]


def test_a_broken_base_is_not_taken_for_none(spark, leads, tmp_path):
    (tmp_path / "base").mkdir()
    (tmp_path / "base" / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception):
        load_batch(leads(NEW), str(tmp_path / "base"), str(tmp_path / "rejected"), 1, AS_OF)
