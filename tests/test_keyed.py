"""A stream with keys in its state against the one that reads the base."""

from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadloom.plans.clean import clean_leads
from leadloom.session import scratch_path
from leadloom.sources import tables
from leadloom.streaming import keyed
from leadloom.streaming.ingest import ingest_stream, load_batch

AS_OF = date(2026, 1, 1)
OLD = {"lead_id": "L0130", "handle": "@heritagefinds", "email": "a@b.co", "stage": "new"}
# The second file's leads meet the base, the first file, and each other.
FIRST = [
    {"lead_id": "L0295", "handle": "instagram.com/HeritageFinds"},
    {"lead_id": "L0300", "handle": "@heritagefinds_", "phone": "0044 7700 900123"},
    {"notes": "without any key"},
]
SECOND = [
    {"lead_id": "L0301", "handle": "heritagefinds_ "},
    {"lead_id": "L0302", "phone": "07700900123", "email": "A@b.co"},
    {"lead_id": "L0303", "handle": "@twice"},
    {"lead_id": "L0304", "handle": "@twice"},
    {"notes": "without any key"},
]
THIRD = [{"lead_id": "L0305", "handle": "@twice"}, {"lead_id": "L0300"}, {"lead_id": "L0306"}]


class State:
    """State of one group, as the function sees it."""

    def __init__(self):
        self.kept = None

    @property
    def exists(self):
        return self.kept is not None

    @property
    def get(self):
        return self.kept

    def update(self, value):
        self.kept = value


def entries(*rows):
    return pd.DataFrame(rows, columns=["kind", "key", "lead_id", "fields"])


def test_a_group_takes_in_keys_before_it_answers_once():
    state = State()
    asked, held = (keyed.ASKED, "1:x", None, None), (keyed.HELD, "1:x", "L2", None)
    assert list(keyed.answer(("1:x",), [entries(asked)], state)) == []
    found = list(keyed.answer(("1:x",), [entries(asked, asked), entries(held), entries((keyed.HELD, "1:x", "L1", None), asked)], state))
    assert [list(f.itertuples(index=False, name=None)) for f in found] == [[("held", "1:x", "L1", None)]]
    assert list(keyed.answer(("1:x",), [entries((keyed.HELD, "1:x", None, None))], state)) == [] and state.kept == ("L1",)


def test_a_key_of_a_lead_without_an_id_is_known():
    state = State()
    list(keyed.answer(("1:x",), [entries((keyed.HELD, "1:x", None, None))], state))
    assert state.exists
    (found,) = keyed.answer(("1:x",), [entries((keyed.ASKED, "1:x", None, None))], state)
    assert found["lead_id"].tolist() == [None]


def outcome(spark, root):
    base = tables.read_base(spark, f"{root}/base").select("lead_id", "handle", "email", "phone", "notes", "lead_type")
    log = spark.read.parquet(f"{root}/rejected").drop("batch_id")
    return [sorted(map(repr, df.collect())) for df in (base, log)]


def arrive(leads, root, *rows):
    leads(*rows).coalesce(1).write.mode("append").parquet(f"{root}/incoming")


def test_same_base_and_log_as_a_stream_that_reads_the_base(spark, leads, monkeypatch):
    root, plain = scratch_path(spark, "test"), scratch_path(spark, "test")
    for here in (root, plain):
        tables.append_to_base(clean_leads(leads(OLD), AS_OF), f"{here}/base", tables.FIRST_LOAD)
    for number, rows in enumerate((FIRST, SECOND, THIRD)):
        for here in (root, plain):
            arrive(leads, here, *rows)
        if number == 0:  # the second and third file are loaded in one run, a micro-batch each
            keyed.ingest_keyed(spark, f"{root}/incoming", f"{root}/base", f"{root}/rejected", f"{root}/progress", AS_OF)
        ingest_stream(spark, f"{plain}/incoming", f"{plain}/base", f"{plain}/rejected", f"{plain}/progress", AS_OF).awaitTermination()
    read = []
    monkeypatch.setattr(keyed, "take_up_base", lambda *_: None)  # nothing was loaded by others
    monkeypatch.setattr(tables, "find_base", lambda *_: read.append(1))
    run = {"max_files_per_batch": 1}
    keyed.ingest_keyed(spark, f"{root}/incoming", f"{root}/base", f"{root}/rejected", f"{root}/progress", AS_OF, **run)
    assert read == []
    monkeypatch.undo()
    assert outcome(spark, root) == outcome(spark, plain)
    assert {r.lead_id for r in tables.read_base(spark, f"{root}/base").collect()} == {
        "L0130", "L0300", "L0303", "L0304", "L0306", None
    }


def test_a_micro_batch_that_broke_off_is_done_again(spark, leads, monkeypatch):
    root, plain = scratch_path(spark, "test"), scratch_path(spark, "test")
    for here in (root, plain):
        tables.append_to_base(clean_leads(leads(OLD), AS_OF), f"{here}/base", tables.FIRST_LOAD)
        arrive(leads, here, *FIRST)
    place = (f"{root}/incoming", f"{root}/base", f"{root}/rejected", f"{root}/progress", AS_OF)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(keyed, "loaded_rows", broken)  # base and log are written by then, the keys are not
        with pytest.raises(Exception, match="lost"):
            keyed.ingest_keyed(spark, *place)
    for here in (root, plain):
        arrive(leads, here, *SECOND)
    for name in (plain, root):
        if name == root:
            keyed.ingest_keyed(spark, *place)
        else:
            load_batch(leads(*FIRST), f"{plain}/base", f"{plain}/rejected", 1, AS_OF)
            load_batch(leads(*SECOND), f"{plain}/base", f"{plain}/rejected", 2, AS_OF)
    assert outcome(spark, root) == outcome(spark, plain)


def test_batches_of_others_are_taken_up_at_the_start(spark, leads):
    root = scratch_path(spark, "test")
    place = (f"{root}/incoming", f"{root}/base", f"{root}/rejected", f"{root}/progress", AS_OF)
    arrive(leads, root, OLD)
    keyed.ingest_keyed(spark, *place)  # starts the base
    load_batch(leads({"lead_id": "X1", "handle": "@other"}), f"{root}/base", f"{root}/rejected", "by hand", AS_OF)
    arrive(leads, root, {"lead_id": "X2", "handle": "@other"}, {"lead_id": "X3"})
    keyed.ingest_keyed(spark, *place)
    assert sorted(r.lead_id for r in tables.read_base(spark, f"{root}/base").collect()) == ["L0130", "X1", "X3"]


def test_lines_and_additional_columns(spark, leads):
    root = scratch_path(spark, "test")
    spark.createDataFrame([("lead_id,campaign,handle",), ("L1,fair,@one",), ("L2,fair,@two,surplus",)], "value string").coalesce(1).write.text(
        f"{root}/incoming"
    )
    keyed.ingest_keyed(spark, f"{root}/incoming", f"{root}/base", f"{root}/rejected", f"{root}/progress", AS_OF, file_format="csv")
    assert [(r.lead_id, r.campaign) for r in tables.read_base(spark, f"{root}/base").collect()] == [("L1", "fair")]
    assert [r.line for r in spark.read.parquet(f"{root}/rejected-lines").collect()] == ["L2,fair,@two,surplus"]


def operators(spark, root):
    return {r.operatorName for r in spark.read.format("state-metadata").load(f"{root}/progress/checkpoint").collect()}


def test_no_function_is_called_for_each_key(spark, leads, monkeypatch):
    """A base without ids and copies of one lead among them; log and base as without state."""

    def called(*_):
        raise AssertionError("called for a key")

    monkeypatch.setattr(keyed, "answer", called)
    root, plain = scratch_path(spark, "test"), scratch_path(spark, "test")
    nameless, twice = {"handle": "@nobody"}, {"lead_id": "L7", "handle": "@seven", "phone": "07700900777"}
    for here in (root, plain):
        tables.append_to_base(clean_leads(leads(OLD, nameless), AS_OF), f"{here}/base", tables.FIRST_LOAD)
    for rows in ([*FIRST, twice, twice], [*SECOND, {"lead_id": "L8", "handle": "@nobody"}, {"phone": "00447700900777"}]):
        for here in (root, plain):
            arrive(leads, here, *rows)
        ingest_stream(spark, f"{plain}/incoming", f"{plain}/base", f"{plain}/rejected", f"{plain}/progress", AS_OF).awaitTermination()
        keyed.ingest_keyed(spark, f"{root}/incoming", f"{root}/base", f"{root}/rejected", f"{root}/progress", AS_OF)
    assert operators(spark, root) == {"stateStoreSave"}
    assert outcome(spark, root) == outcome(spark, plain)


def test_a_checkpoint_of_an_earlier_version_goes_on(spark, leads, monkeypatch):
    root, plain = scratch_path(spark, "test"), scratch_path(spark, "test")
    for here in (root, plain):
        tables.append_to_base(clean_leads(leads(OLD), AS_OF), f"{here}/base", tables.FIRST_LOAD)
    monkeypatch.setattr(keyed, "has_function_state", lambda *_: True)
    for rows in (FIRST, SECOND):
        for here in (root, plain):
            arrive(leads, here, *rows)
        ingest_stream(spark, f"{plain}/incoming", f"{plain}/base", f"{plain}/rejected", f"{plain}/progress", AS_OF).awaitTermination()
        keyed.ingest_keyed(spark, f"{root}/incoming", f"{root}/base", f"{root}/rejected", f"{root}/progress", AS_OF)
        monkeypatch.undo()
    assert operators(spark, root) == {"applyInPandasWithState"}
    assert outcome(spark, root) == outcome(spark, plain)
