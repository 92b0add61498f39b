"""Shape of the physical plans that matter on large tables."""

import pytest
from pyspark.sql import functions as F

from leadloom.operators import identity, queue, shops
from leadloom.plans.clean import classified_leads, prepared_leads
from leadloom.sources.fixtures import AS_OF, raw_leads
from leadloom.sources.tables import write_leads
from leadloom.session import cut_lineage, scratch_path
from tests.conftest import FOLDER


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "stored")
    write_leads(raw_leads(spark, FOLDER), path)
    return spark.read.parquet(path)


def test_cleaning_has_no_shuffle(stored):
    assert "Exchange" not in plan(classified_leads(stored, AS_OF))


def test_wide_rows_are_shuffled_once(stored, no_broadcast):
    leads = cut_lineage(prepared_leads(stored.union(stored.limit(20)), AS_OF))
    kept = identity.drop_duplicates(leads, identity.resolve_duplicates(leads))
    kept.collect()
    final = plan(kept).split("Initial Plan")[0]
    # the leads, and two narrow tables of ids; the second join reads the leads' shuffle again
    assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") == 3
    assert "ReusedExchange" in final


def test_most_wide_rows_are_neither_shuffled_nor_sorted(stored):
    leads = cut_lineage(prepared_leads(stored, AS_OF))
    text = plan(identity.drop_duplicates(leads, identity.resolve_duplicates(leads)))
    # the first branch joins only; rows collapse in the second, above the join with the repeated ids
    assert text.index("Union") < text.index("LeftAnti") < text.index("SortAggregate") < text.index("LeftSemi")
    assert "BroadcastHashJoin" in text


def test_first_row_of_a_key_is_combined_before_the_shuffle(stored):
    rows = identity.key_rows(prepared_leads(stored, AS_OF))
    members = rows.select(F.explode("keys").alias("key"), F.lit(0).alias("block"), F.lit(0).alias("place"))
    text = plan(identity._spans(members))
    assert "partial_min" in text and "Window" not in text


def test_filters_and_columns_reach_the_scan(spark, stored):
    path = scratch_path(spark, "clean")
    write_leads(classified_leads(stored, AS_OF), path)
    text = plan(shops.regional_hubs(spark.read.parquet(path)))
    scan = text[text.index("FileScan"):]
    assert "PushedFilters: [In(lead_type, [hybrid,physical_shop]), IsNotNull(city)]" in scan
    assert "last_inbound_text" not in scan and "notes" not in scan
    text = plan(queue.resellers(spark.read.parquet(path)).select(F.col("lead_id")))
    assert "ReadSchema: struct<lead_id:string,lead_type:string>" in text
