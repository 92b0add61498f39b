"""The permanent base over many loads: recorded columns, gathered batches, stored keys, dated outputs, odd lines."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from leadloom.operators import batch, incremental
from leadloom.operators.identity import drop_duplicates, resolve_duplicates
from leadloom.plans.clean import clean_leads, prepared_leads
from leadloom.session import cut_lineage, scratch_path
from leadloom.sources import files, key_index, tables
from leadloom.streaming.ingest import load_batch
from tests.test_identity import random_rows
from tests.test_plans import plan

AS_OF = date(2026, 1, 1)


def base_rows(spark, base):
    return sorted((r.lead_id, r.batch_id, r.note) for r in tables.read_base(spark, base).select("lead_id", "batch_id", "note").collect())


def test_gathered_batches_stay_few_and_replaceable(spark):
    base = f"{scratch_path(spark, 'test')}/base"
    want = {}
    for number in range(13):
        name = str(number % 9)  # some are loaded again, before or after they were gathered
        rows = [(f"L{number}-{i}", f"n{number}") for i in range(number % 3)]
        want[name] = [(lead, name, note) for lead, note in rows]
        tables.append_to_base(spark.createDataFrame(rows, "lead_id string, note string").coalesce(1), base, name)
        if number % 4 == 3:
            assert tables.compact_base(spark, base) > 1
            assert len([n for n in files.names(spark, base) if n.startswith("batch_id=")]) == 1
        assert base_rows(spark, base) == sorted(r for own in want.values() for r in own)


def test_a_gathering_that_ended_half_way_changes_nothing(spark, monkeypatch):
    base = f"{scratch_path(spark, 'test')}/base"
    for name in "ab":
        tables.append_to_base(spark.createDataFrame([(f"L{name}", name)], "lead_id string, note string"), base, name)
    want = base_rows(spark, base)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_note_gathering", lambda *_: 1 / 0)  # written, not recorded
        with pytest.raises(ZeroDivisionError):
            tables.compact_base(spark, base)
    assert base_rows(spark, base) == want
    with monkeypatch.context() as patch:
        patch.setattr(files, "modified", lambda *_: None)  # recorded, nothing deleted
        tables.compact_base(spark, base)
    assert base_rows(spark, base) == want
    tables.append_to_base(spark.createDataFrame([("L2", "again")], "lead_id string, note string"), base, "a")
    want = [("L2", "a", "again"), ("Lb", "b", "b")]
    assert base_rows(spark, base) == want
    tables.compact_base(spark, base)
    assert base_rows(spark, base) == want


def test_columns_come_from_the_record(spark, monkeypatch):
    base = f"{scratch_path(spark, 'test')}/base"
    tables.append_to_base(spark.createDataFrame([("L1", "x")], "lead_id string, note string"), base, 1)
    tables.append_to_base(spark.createDataFrame([("L2", "y")], "lead_id string, Campaign string"), base, 2)
    monkeypatch.setattr(tables, "_discovered", None)
    found = tables.read_base(spark, base)
    assert found.columns == ["lead_id", "Campaign", "note", "batch_id"] or found.columns == ["lead_id", "note", "Campaign", "batch_id"]
    assert sorted((r.lead_id, r.note, r.Campaign) for r in found.collect()) == [("L1", "x", None), ("L2", None, "y")]
    with pytest.raises(ValueError):
        tables.append_to_base(spark.createDataFrame([("L3", 1)], "lead_id string, note int"), base, 3)


def test_a_base_from_before_columns_were_recorded(spark):
    base = f"{scratch_path(spark, 'test')}/base"
    spark.createDataFrame([("L1", "x")], "lead_id string, note string").write.parquet(tables.batch_path(base, "old"))
    tables.append_to_base(spark.createDataFrame([("L2",)], "lead_id string"), base, "new")
    assert base_rows(spark, base) == [("L1", "old", "x"), ("L2", "new", None)]


# ---------------------------------------------------------------- stored keys


def indexed_loads(spark, leads, root, batches, **options):
    return [
        load_batch(leads(*rows), f"{root}/base", f"{root}/rejected", name, AS_OF, index_path=f"{root}/index", **options)
        for name, rows in batches
    ]


def test_loads_by_stored_keys_equal_loads_that_read_the_base(spark, leads):
    rows = random_rows(21, 60, 40)
    batches = [("it's 1", rows[:20]), ("2", rows[20:40]), ("it's 1", rows[5:25]), ("3", rows[30:60])]
    one, two = scratch_path(spark, "test"), scratch_path(spark, "test")
    counts = indexed_loads(spark, leads, one, batches, compact_at=3)
    for (name, own), done in zip(batches, counts, strict=True):
        assert load_batch(leads(*own), f"{two}/base", f"{two}/rejected", name, AS_OF) == done
        assert done.incoming == len(own) == done.rejected + done.added
    for part in ("base", "rejected"):
        found, want = (sorted(map(str, tables.read_base(spark, f"{root}/{part}").drop("batch_id").collect())) for root in (one, two))
        assert found == want
    held = key_index.read_index(spark, f"{one}/index").select("key", "lead_id", "batch_id")
    base = tables.read_base(spark, f"{one}/base")
    want = batch.held_keys(base.select("*")).join(base.select("lead_id", "batch_id"), "lead_id").select("key", "lead_id", "batch_id")
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, want.groupBy("key", "batch_id").agg(F.min("lead_id").alias("lead_id")).select("key", "lead_id", "batch_id").collect()))


def test_the_index_is_not_shuffled_and_the_base_not_opened(spark, leads):
    root = scratch_path(spark, "test")
    rows = random_rows(22, 30, 30)
    indexed_loads(spark, leads, root, [("1", rows[:15]), ("2", rows[15:])])
    held = key_index.held_keys(spark, f"{root}/base", f"{root}/index").where("batch_id <> '3'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(batch.check_keys(leads(*rows[:9]), held))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert f"{root}/base" not in text
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "leadloom_keys" in line)
    assert "Bucketed: true" in lines[scan] or "SelectedBucketsCount" in lines[scan]
    # From the scan up to the join nothing but a filter and a sort.
    depth = lines[scan].index("FileScan")
    above = [line.lstrip(" :+-*(0123456789)") for line in lines[:scan] if len(line) - len(line.lstrip(" :+-")) < depth][::-1]
    until = next(i for i, name in enumerate(above) if name.startswith("SortMergeJoin"))
    assert not any(name.startswith("Exchange") for name in above[:until])


def test_an_index_that_was_not_finished_is_built_again(spark, leads):
    root = scratch_path(spark, "test")
    rows = random_rows(23, 12, 30)
    indexed_loads(spark, leads, root, [("1", rows)])
    want = sorted(map(tuple, key_index.read_index(spark, f"{root}/index").collect()))
    files.delete(spark, f"{root}/index/keys-{key_index.BUCKETS}/_complete")
    files.delete(spark, f"{root}/index/keys-{key_index.BUCKETS}/batch_id=1")
    assert sorted(map(tuple, key_index.held_keys(spark, f"{root}/base", f"{root}/index").collect())) == want


# ---------------------------------------------------------------- growing duplicates


def test_loads_one_after_the_other_equal_one_run(spark, leads):
    state = scratch_path(spark, "test")
    rows = random_rows(31, 90, 35)
    everything = cut_lineage(prepared_leads(leads(*rows, *rows[:4]), AS_OF))
    share = F.pmod(F.xxhash64("row_id"), F.lit(3))
    for number in range(3):
        own = everything.where(share == number)
        incremental.absorb(spark, state, own, number, block_rows=20, parts=4)
        if number == 1:
            incremental.absorb(spark, state, own, number, parts=4)  # a repeat
            incremental.compact(spark, state)
        so_far = everything.where(share <= number)
        want = resolve_duplicates(so_far).decided
        found = incremental.current(spark, state)
        columns = ["row_id", "copies", "kept"]
        assert sorted(map(tuple, found.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    kept = drop_duplicates(everything, incremental.resolution(spark, state))
    assert sorted(map(str, kept.collect())) == sorted(map(str, drop_duplicates(everything).collect()))
    with pytest.raises(ValueError):
        incremental.absorb(spark, state, everything, 1)


def test_a_load_reads_what_it_touches(spark, leads):
    state = scratch_path(spark, "test")
    first = [{"lead_id": f"L{i:04d}", "handle": f"seller{i}"} for i in range(400)]
    incremental.absorb(spark, state, prepared_leads(leads(*first), AS_OF), 0, parts=4)
    new = [{"lead_id": "A", "handle": "seller7", "last_touch_date": "2025-12-01"}, {"lead_id": "B", "handle": "nobody"}]
    done = incremental.absorb(spark, state, prepared_leads(leads(*new), AS_OF), 1, parts=4)
    assert sorted((r.lead_id, r.kept) for r in done.rows.collect()) == [("A", True), ("B", True), ("L0007", False)]
    assert done.lines_read < 10


# ---------------------------------------------------------------- lines and days


def test_lines_with_surplus_fields_are_kept_aside(spark, tmp_path):
    lines = ["lead_id,handle,email", 'L1,"a,b",x@y.com', "L2,a,b@c.d,LOST,VALUES", "L3,short", 'L4,"said ""a,b""",,', "L5,c,d@e.f"]
    (tmp_path / "leads.csv").write_text("\n".join(lines) + "\n")
    aside = str(tmp_path / "aside")
    found = tables.read_leads(spark, str(tmp_path / "leads.csv"), "csv", quarantine_path=aside)
    assert found.count() == 3
    assert sorted((r.lead_id, r.handle, r.email) for r in found.collect()) == [("L1", "a,b", "x@y.com"), ("L3", "short", None), ("L5", "c", "d@e.f")]
    assert sorted(r.line for r in spark.read.parquet(aside).collect()) == ["L2,a,b@c.d,LOST,VALUES", 'L4,"said ""a,b""",,']
    with pytest.raises(Exception, match="more fields than the header"):
        tables.read_leads(spark, str(tmp_path / "leads.csv"), "csv").select("lead_id").collect()


def test_days_are_replaced_one_by_one(spark):
    path = scratch_path(spark, "test")
    rows = spark.createDataFrame([("L1",), ("L2",)], "lead_id string")
    for day, own in (("2026-01-01", rows), ("2026-01-02", rows), ("2026-01-01", rows.where("lead_id = 'L2'")), ("2026-01-02", rows.limit(0))):
        tables.write_dated(own, path, date.fromisoformat(day))
    found = tables.read_dated(spark, path, rows.schema)
    assert [(r.lead_id, r.run_date) for r in found.collect()] == [("L2", date(2026, 1, 1))]
    assert "PartitionFilters: [isnotnull(run_date" in plan(found.where(F.col("run_date") == date(2026, 1, 1)))
