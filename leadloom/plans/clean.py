"""Raw leads to clean leads: normalise, repair, remove duplicates, classify."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from leadloom.operators.additional import unpacked
from leadloom.operators.classify import classify_leads
from leadloom.operators.geo import repair_geography
from leadloom.operators.identity import drop_duplicates, resolve_duplicates, with_row_id
from leadloom.operators.normalise import normalise_leads
from leadloom.schema import CLEAN_COLUMNS
from leadloom.session import cut_lineage


def prepared_leads(raw: DataFrame, as_of: date) -> DataFrame:
    """Normalised and repaired leads with ``row_id``, duplicates still in."""
    return with_row_id(repair_geography(normalise_leads(raw, as_of)))


def classified_leads(raw: DataFrame, as_of: date) -> DataFrame:
    """Everything but the duplicate removal: one projection, no shuffle."""
    leads = repair_geography(normalise_leads(raw, as_of))
    return classify_leads(leads, as_of).select(*CLEAN_COLUMNS, *unpacked(leads))


def clean_leads(raw: DataFrame, as_of: date) -> DataFrame:
    """The clean table every later step reads; additional columns come last.

    The prepared leads are written once, because the duplicate search and the rows that
    stay both read them.
    """
    leads = cut_lineage(prepared_leads(raw, as_of))
    kept = drop_duplicates(leads, resolve_duplicates(leads))
    return classify_leads(kept, as_of).select(*CLEAN_COLUMNS, *unpacked(leads))
