"""Small builders that turn rule data into Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    return sql_text(value) if isinstance(value, str) else f"{value}D" if isinstance(value, float) else str(value)


def lookup(mapping: Mapping[str, object], key: ColumnLike, default: object = None) -> Column:
    """Value of ``key`` in a literal map, or ``default`` for unknown and missing keys."""
    table = F.expr("map(" + ", ".join(sql_literal(part) for item in mapping.items() for part in item) + ")")
    found = F.element_at(table, as_column(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def shortest(phrases: Iterable[str], covered_by: Iterable[str] = ()) -> list[str]:
    """Phrases that do not contain another one; a text with the longer has the shorter."""
    unique = list(dict.fromkeys(phrases))
    others = [*unique, *covered_by]
    return [p for p in unique if not any(o != p and o in p for o in others) and p not in set(covered_by)]


def sql_text(value: str) -> str:
    """SQL literal of a text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contains_any(column: str, phrases: Iterable[str], whole_words: bool = False) -> Column:
    """True if the text column contains one of the phrases; null text gives null.

    Written as one SQL text: a call per phrase would make building the plan slow.
    """
    phrases = shortest(phrases)
    if not phrases:
        return F.lit(False)
    if whole_words:
        return F.col(column).rlike(r"\b(" + "|".join(re.escape(p) for p in phrases) + r")\b")
    return F.expr(" OR ".join(f"contains(`{column}`, {sql_text(p)})" for p in phrases))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_match(cases: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first case whose condition is true."""
    chain = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if chain is None else chain.otherwise(default)


def fill(template: str, **values: ColumnLike) -> Column:
    """Replace ``{name}`` placeholders of a template by columns."""
    parts = []
    for position, part in enumerate(re.split(r"\{(\w+)\}", template)):
        if position % 2:
            parts.append(as_column(values[part]))
        elif part:
            parts.append(F.lit(part))
    return F.concat(*parts) if parts else F.lit("")


def pick(options: Iterable[object], position: ColumnLike) -> Column:
    """Element of a literal list at a 0-based position column."""
    table = F.expr("array(" + ", ".join(sql_literal(o) for o in options) + ")")
    return F.get(table, as_column(position))


def fill_picked(templates: Iterable[str], position: ColumnLike, **values: ColumnLike) -> Column:
    """Fill the template that each row picked.

    One replacement per placeholder serves all templates, so the expression does
    not grow with their number.  Placeholders are marked with control characters,
    which keeps braces in the inserted values from being taken for one.
    """
    marked = [re.sub(r"\{(\w+)\}", "\x02\\1\x03", t) for t in templates]
    filled = pick(marked, position)
    for name, value in values.items():
        filled = F.replace(filled, F.lit(f"\x02{name}\x03"), F.coalesce(as_column(value), F.lit("")))
    return filled
