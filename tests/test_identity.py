import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadloom.operators import identity
from leadloom.operators.components import components
from leadloom.plans.clean import prepared_leads

AS_OF = date(2026, 1, 1)


def walk(rows):
    """The rule row by row: newest first, kept rows own their keys."""
    def order(row):
        day = row.get("last_touch_date")
        return (day is None, -(date.fromisoformat(day).toordinal()) if day else 0, row["lead_id"])

    seen, kept = set(), []
    for row in sorted(rows, key=order):
        own = {("id", row["lead_id"])}
        for kind in ("handle", "email", "phone"):
            if row.get(kind):
                own.add((kind, row[kind]))
        if row.get("store_name") and row.get("city"):
            own.add(("store", row["store_name"] + row["city"]))
        if not own & seen:
            seen |= own
            kept.append(row["lead_id"])
    return sorted(kept)


def kept_ids(raw, **options):
    leads = prepared_leads(raw, AS_OF)
    result = identity.resolve_duplicates(leads, **options)
    return sorted(r.lead_id for r in identity.drop_duplicates(leads, result).collect()), result


def random_rows(seed, n, values):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        row = {"lead_id": f"L{i:05d}", "last_touch_date": str(AS_OF - timedelta(days=rng.randrange(9)))}
        if rng.random() < 0.2:
            row["last_touch_date"] = None
        for kind, make in (
            ("handle", "seller{}"), ("email", "u{}@mail.com"), ("phone", "070000{:05d}"), ("store_name", "Shop {}"),
        ):
            if rng.random() < 0.6:
                row[kind] = make.format(rng.randrange(values))
        row["city"] = "Austin" if rng.random() < 0.8 else None
        rows.append(row)
    return rows


@pytest.mark.parametrize(("seed", "n", "values"), [(1, 60, 25), (2, 300, 120), (3, 150, 20)])
def test_equals_the_walk_row_by_row(leads, seed, n, values):
    rows = random_rows(seed, n, values)
    assert kept_ids(leads(*rows))[0] == walk(rows)


def chain(length):
    """Row i shares its handle with i - 1 and its e-mail with i + 1, newest first."""
    return [
        {
            "lead_id": f"L{i:05d}",
            "last_touch_date": str(AS_OF - timedelta(days=i)),
            "handle": f"seller{(i + 1) // 2}",
            "email": f"u{i // 2}@mail.com",
        }
        for i in range(length)
    ]


def test_long_chain_in_one_block(leads):
    rows = chain(300)
    got, result = kept_ids(leads(*rows))
    assert got == walk(rows)
    assert result.rounds == 1


@pytest.mark.parametrize(("seed", "n", "values"), [(4, 200, 90), (5, 120, 25)])
def test_blocks_of_any_size_equal_the_walk(leads, seed, n, values):
    rows = random_rows(seed, n, values)
    assert kept_ids(leads(*rows), block_rows=25)[0] == walk(rows)


def test_chain_over_a_hundred_blocks_takes_few_rounds(leads):
    rows = chain(1000)
    got, result = kept_ids(leads(*rows), block_rows=10)
    assert got == walk(rows)
    assert result.rounds <= 10


def ladder(length):
    """Row i shares keys with i - 1, i - 2 and i - 3: three rows to a key, so rows hang on several others."""
    return [
        {
            "lead_id": f"L{i:05d}",
            "last_touch_date": str(AS_OF - timedelta(days=i)),
            "handle": f"seller{i // 3}",
            "email": f"u{(i + 1) // 3}@mail.com",
            "phone": f"0700{(i + 2) // 3:07d}",
        }
        for i in range(length)
    ]


def test_rows_that_hang_on_several_others(leads):
    rows = ladder(45)
    assert kept_ids(leads(*rows), block_rows=10)[0] == walk(rows)


def test_symbolic_walk_equals_the_rule_for_every_outcome_before():
    """Whatever the rows before the block turn out to be, what hangs on them agrees with a plain walk."""
    rng = random.Random(11)
    for _ in range(300):
        outside = {f"o{i}": i for i in range(3)}  # key to the place of its only earlier row
        several = {"m0"}
        rows = [(10 + i, rng.sample([*outside, *several, "a", "b", "c", "d"], rng.randrange(1, 4))) for i in range(8)]
        links = pd.DataFrame(
            [(p, k, outside[k] if k in outside else -1 if k in several else None) for p, keys in rows for k in keys],
            columns=["place", "key", "before"],
        )
        found = identity._walk(links).set_index("place")
        for truth in range(16):
            kept = {i: bool(truth >> i & 1) for i in range(3)}
            taken = {k for k, p in outside.items() if kept[p]} | ({"m0"} if truth >> 3 else set())
            for place, keys in rows:
                kept[place] = taken.isdisjoint(keys)
                if kept[place]:
                    taken.update(keys)
                row = found.loc[place]
                if row["target"] != place or not pd.isna(row["verdict"]):
                    assert kept[place] == (row["verdict"] if not pd.isna(row["verdict"]) else kept[row["target"]] != row["odd"])


def test_dropped_rows_do_not_pass_their_keys_on(leads):
    rows = chain(3)
    assert kept_ids(leads(*rows))[0] == ["L00000", "L00002"]


def test_one_key_with_a_third_of_all_rows(leads):
    rows = [{"lead_id": f"L{i:04d}", "handle": "everyone" if i % 3 == 0 else f"seller{i}"} for i in range(300)]
    assert len(kept_ids(leads(*rows))[0]) == 201


def test_rows_without_keys_are_all_kept_and_copies_collapse(leads):
    empty = {"contact_name": "Someone"}
    copy = {"lead_id": "L1", "handle": "@seller"}
    raw = leads(empty, empty, empty, copy, copy)
    prepared = prepared_leads(raw, AS_OF)
    result = identity.resolve_duplicates(prepared)
    assert identity.drop_duplicates(prepared, result).count() == 4
    audit = identity.duplicate_audit(prepared, result).collect()
    assert [(r.lead_id, r.matched_on, r.copies) for r in audit] == [("L1", "lead_id", 1)]


def test_missing_lead_ids_are_no_key(leads):
    raw = leads({"handle": "ab"}, {"handle": "cd"}, {"handle": "@AB", "lead_id": "L3"})
    leads_ = prepared_leads(raw, AS_OF)
    assert identity.drop_duplicates(leads_).count() == 2


def test_audit_names_first_key_and_kept_lead(leads):
    raw = leads(
        {"lead_id": "A", "last_touch_date": "2025-12-30", "handle": "@sepia", "email": "x@y.com"},
        {"lead_id": "B", "last_touch_date": "2025-12-20", "email": "X@@y.com", "handle": "Sepia"},
        {"lead_id": "C", "last_touch_date": "2025-12-10", "phone": "+44 7737 683411", "store_name": "S", "city": "Rome"},
        {"lead_id": "D", "last_touch_date": "2025-12-09", "phone": "0044 7737683411"},
        {"lead_id": "E", "last_touch_date": "2025-12-08", "store_name": "s ", "city": "ROME"},
    )
    prepared = prepared_leads(raw, AS_OF)
    audit = identity.duplicate_audit(prepared, identity.resolve_duplicates(prepared))
    assert {(r.lead_id, r.matched_on, r.matched_lead_id) for r in audit.collect()} == {
        ("B", "handle", "A"), ("D", "phone", "C"), ("E", "store_city", "C"),
    }
    reasons = {r.lead_id: r.reason for r in audit.collect()}
    assert reasons["B"] == "handle @sepia already in pipeline"
    assert reasons["E"] == "store 's' in ROME already in pipeline"


def test_nothing_to_do(leads):
    prepared = prepared_leads(leads(), AS_OF)
    assert identity.drop_duplicates(prepared).count() == 0


def test_components_of_a_shuffled_chain(spark):
    order = list(range(24))
    random.Random(5).shuffle(order)
    links = spark.createDataFrame([(f"r{order[i]:03d}", f"r{order[i + 1]:03d}") for i in range(23)] + [("z", "z2")], "a string, b string")
    found = components(links).groupBy("root").agg(F.count("*").alias("n")).collect()
    assert sorted((r.root, r.n) for r in found) == [("r000", 24), ("z", 2)]
