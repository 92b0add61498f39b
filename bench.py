"""Time the main steps and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of cores.  Each
step is timed alone: the clean table is written before the steps that read it.
"""

from __future__ import annotations

import json
import os
import time

import catalog
from leadloom.operators import city, drafts, identity, queue, shops
from leadloom.plans import clean as clean_plan
from leadloom.session import local_session, scratch_path
from leadloom.sources import fixtures, tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "20"))


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def many_leads(spark, folder: str, copies: int):
    """The raw leads ``copies`` times, with identities of their own in every copy."""
    from pyspark.sql import functions as F

    def salted(name: str):
        return F.when(F.col(name).isNotNull(), F.concat(F.col("copy"), F.lit("x"), F.col(name)))

    copy = spark.range(copies).select(F.col("id").cast("string").alias("copy"))
    return (
        fixtures.raw_leads(spark, folder)
        .crossJoin(copy)
        .withColumns(
            {
                "lead_id": F.concat("lead_id", F.lit("-"), "copy"),
                "handle": F.concat("handle", F.lit("_"), "copy"),
                "email": salted("email"),
                "phone": F.concat("phone", F.lpad("copy", 4, "0")),
                "store_name": F.concat("store_name", F.lit(" "), "copy"),
            }
        )
        .drop("copy")
    )


def steps(spark, folder: str):
    """(name, function) of everything that is timed."""
    raw = spark.read.parquet(_stored(spark, "raw", lambda: fixtures.raw_leads(spark, folder)))
    leads = catalog.clean(spark, folder)
    prepared = lambda: clean_plan.prepared_leads(raw, fixtures.AS_OF)
    yield "classify", lambda: consume(clean_plan.classified_leads(raw, fixtures.AS_OF))
    yield "deduplicate", lambda: consume(identity.drop_duplicates(prepared()))
    yield "clean", lambda: consume(clean_plan.clean_leads(raw, fixtures.AS_OF))
    yield "daily_queue", lambda: consume(queue.daily_queue(leads))
    yield "shops", lambda: consume(shops.sequenced_shops(leads))
    yield "hubs", lambda: consume(shops.regional_hubs(leads))
    yield "messages", lambda: consume(drafts.todays_messages(queue.daily_queue(leads), shops.plan_shops(leads)))
    yield "city_rankings", lambda: consume(city.city_rankings(city.scored_shops(leads)))
    yield "visit_plan", lambda: consume(city.visit_plan(city.scored_shops(leads)))
    yield "batch", lambda: consume(catalog.checked(spark, folder))


def _stored(spark, name: str, make) -> str:
    path = scratch_path(spark, name)
    tables.write_leads(make(), path)
    return path


def timed(step) -> float:
    started = time.perf_counter()
    step()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    spark = local_session(CPUS, "bench")
    for _, step in steps(spark, FOLDER):  # warm-up: class loading and compilation
        step()
    times = {name: timed(step) for name, step in steps(spark, FOLDER)}
    if COPIES:
        big = spark.read.parquet(_stored(spark, "many", lambda: many_leads(spark, FOLDER, COPIES).repartition(32)))
        times[f"clean_x{COPIES}"] = timed(lambda: consume(clean_plan.clean_leads(big, fixtures.AS_OF)))
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "leads": spark.read.parquet(f"{FOLDER}/customer.parquet").count(),
            }
        )
    )


if __name__ == "__main__":
    main()
