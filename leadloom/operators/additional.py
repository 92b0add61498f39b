"""Columns beyond the known ones, carried through the steps in one struct column.

Inside the struct they cannot clash with the helper columns of a step, whatever they
are called; the last step takes them out again under their own names.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.schema import ADDITIONAL, CLEAN_COLUMNS


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def pack(leads: DataFrame) -> DataFrame:
    """Known columns, then the others in one struct column, if there are any."""
    if ADDITIONAL in leads.columns:
        return leads
    known = {name.lower() for name in CLEAN_COLUMNS}
    other = [name for name in leads.columns if name.lower() not in known]
    if not other:
        return leads
    packed = F.struct(*[F.col(_quoted(name)) for name in other]).alias(ADDITIONAL)
    return leads.select(*[name for name in leads.columns if name not in other], packed)


def packed_name(leads: DataFrame) -> list[str]:
    """The struct column, if the leads have one: a list to append to a selection."""
    return [ADDITIONAL] if ADDITIONAL in leads.columns else []


def unpacked(leads: DataFrame, without: Collection[str] = ()) -> list[Column]:
    """The additional columns under their own names, but for those of ``without``."""
    if ADDITIONAL not in leads.columns:
        return []
    taken = {name.lower() for name in without}
    names = leads.schema[ADDITIONAL].dataType.fieldNames()
    return [F.col(f"{ADDITIONAL}.{_quoted(name)}").alias(name) for name in names if name.lower() not in taken]


def unpack(leads: DataFrame) -> DataFrame:
    """The leads with their additional columns at the end."""
    return leads.select(*[name for name in leads.columns if name != ADDITIONAL], *unpacked(leads))
