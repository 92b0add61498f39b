from datetime import datetime, timedelta

import pytest

from leadloom.session import scratch_path
from leadloom.streaming.confirm import confirmed_stream, write_confirmed

START = datetime(2026, 6, 30, 8)
PLANS = [("L1", "One", START), ("L2", "Two", START), ("L3", "Three", START + timedelta(hours=1)), (None, "Nobody", START)]
TICKS = [
    ("L1", START + timedelta(hours=2)),
    ("L1", START + timedelta(hours=3)),
    ("L2", START - timedelta(minutes=1)),  # before it was planned
    ("L3", START + timedelta(hours=25)),
    ("L9", START + timedelta(hours=1)),
    (None, START + timedelta(hours=1)),
]


def run(spark, root, lateness="2 days"):
    kinds = {"plans": "lead_id string, store_name string, planned_at timestamp", "ticks": "lead_id string, ticked_at timestamp"}
    streams = [spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}") for name, kind in kinds.items()]
    query = write_confirmed(confirmed_stream(*streams, lateness=lateness), f"{root}/out", f"{root}/progress")
    query.awaitTermination()
    return query


def arrive(spark, root, name, *rows):
    kind = "lead_id string, store_name string, planned_at timestamp" if name == "plans" else "lead_id string, ticked_at timestamp"
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{root}/{name}")


@pytest.mark.parametrize("ticks_first", [True, False])
def test_any_order_of_arrival_gives_the_same_visits(spark, ticks_first):
    root = scratch_path(spark, "test")
    parts = [("ticks", TICKS[:1]), ("ticks", TICKS[1:]), ("plans", PLANS[2:]), ("plans", PLANS[:2])]
    for name in ("plans", "ticks"):
        arrive(spark, root, name)
    for name, rows in parts if ticks_first else reversed(parts):
        arrive(spark, root, name, *rows)
        run(spark, root)  # stops and goes on from its checkpoint
    found = spark.read.schema("lead_id string, store_name string, appointment_confirmed boolean").parquet(f"{root}/out")
    assert sorted(map(tuple, found.collect())) == [("L1", "One", True), ("L3", "Three", True)]


def test_what_no_tick_can_reach_any_more_is_forgotten(spark):
    root = scratch_path(spark, "test")
    arrive(spark, root, "plans", *PLANS)
    arrive(spark, root, "ticks", *TICKS[:1])
    run(spark, root, "1 hour")
    for day in (3, 4):
        arrive(spark, root, "plans", ("L5", "Five", START + timedelta(days=day)))
        arrive(spark, root, "ticks", ("L6", START + timedelta(days=day)))
        query = run(spark, root, "1 hour")
    kept = sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"])
    assert kept <= 4  # of the last days only
