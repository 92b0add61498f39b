"""Text, number and date normalisation as Column expressions.

Functions named ``*_of`` expect text that is already trimmed and null where blank
(``blank_to_null``); the cleaning step uses them on prepared columns so that no
input is trimmed twice.  The others take any text.
"""

from __future__ import annotations

import calendar
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom import rules
from leadloom.functions.logic import ColumnLike, as_column, let, lookup, sql_text

WHITESPACE = " \t\n\r\x0b\x0c\u00a0"
BLANK_WORDS = ("", "nan", "none")
QUOTES = "'`\""
INVALID = "INVALID: "
EMAIL_SHAPE = r"^[^@]+@[^@]+\.[^@]+$"
EMAIL_IN_TEXT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PROFILE_URL = r"^(https?://)?(www\.)?instagram\.com/"

MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
MONTHS = {
    spelling: str(number)
    for number, name in enumerate(MONTH_NAMES, start=1)
    for spelling in dict.fromkeys((name, name[:3], "sept" if number == 9 else name))
}
DATE_SEPARATORS = r"[-/., :]+|(?<=\d)T"
#: A time behind a date, which does not count.
TIME_OF_DAY = r"(?<=\d)[T ,]+\d{1,2}:\d{2}.*$"


def strip_sql(expression: str) -> str:
    return f"btrim({expression}, {sql_text(WHITESPACE)})"


def strip(text: ColumnLike) -> Column:
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def present_sql(column: str) -> str:
    blank = ", ".join(sql_text(word) for word in BLANK_WORDS)
    return f"CASE WHEN octet_length({column}) > 4 OR lower({column}) NOT IN ({blank}) THEN {column} END"


def present(trimmed: ColumnLike) -> Column:
    """Trimmed text, or null if it is blank, ``nan`` or ``none`` (any case)."""
    column = as_column(trimmed)
    return F.when((F.octet_length(column) > 4) | ~F.lower(column).isin(*BLANK_WORDS), column)


def blank_to_null(text: ColumnLike) -> Column:
    """Trimmed text; blank, ``nan`` and ``none`` (any case) become null."""
    return present(strip(text))


def handle_of(text: ColumnLike) -> Column:
    lowered = F.lower(as_column(text))
    plain = F.when(lowered.contains("instagram.com/"), F.regexp_replace(lowered, PROFILE_URL, "")).otherwise(lowered)
    return strip(F.ltrim(plain, F.lit("@")))


def clean_handle(handle: ColumnLike) -> Column:
    """Plain lower-case account name; missing gives an empty text."""
    return F.coalesce(handle_of(blank_to_null(handle)), F.lit(""))


def stage_of(text: ColumnLike, strict_map: bool = False) -> Column:
    spellings = dict(rules.STAGE_SPELLINGS)
    if not strict_map:
        spellings.update(rules.EXTRA_STAGE_SPELLINGS)
    return lookup(spellings, F.lower(as_column(text)), "New")


def clean_stage(stage: ColumnLike, strict_map: bool = False) -> Column:
    """One of the standard stages; unknown and missing give ``New``."""
    return stage_of(blank_to_null(stage), strict_map)


def number_of(text: ColumnLike) -> Column:
    # A number ends in a digit or a point.  This also keeps words away from the
    # cast, and endings like ``5d`` that Java would read as 5.0.
    column = as_column(text)
    return F.when(F.right(column, F.lit(1)) <= "9", column.try_cast("double"))


def clean_number(value: ColumnLike) -> Column:
    """Text to double; anything that is not a decimal number gives null."""
    return finite(number_of(strip(value)))


def finite(number: ColumnLike) -> Column:
    """Null for infinite and undefined numbers."""
    column = as_column(number)
    return F.when(F.abs(column) < float("inf"), column)


def spend_of(text: ColumnLike) -> Column:
    return number_of(strip(F.replace(F.replace(as_column(text), F.lit("£"), F.lit("")), F.lit(","), F.lit(""))))


def clean_spend(spend: ColumnLike) -> Column:
    """Pound amount as a double; missing or unreadable gives 0."""
    return F.coalesce(finite(spend_of(spend)), F.lit(0.0))


def whole(value: ColumnLike) -> Column:
    """Number cut to its whole part, as a bigint."""
    column = as_column(value)
    return F.when(column >= 0, F.floor(column)).otherwise(F.ceil(column))


def _latest_leap_day(as_of: date) -> date:
    year = as_of.year
    while not (calendar.isleap(year) and date(year, 2, 29) <= as_of):
        year -= 1
    return date(year, 2, 29)


def _date_of(year: Column, month: Column, day: Column) -> Column:
    # The text-to-date cast gives null for impossible days without raising.
    return F.concat_ws("-", year, month, day).try_cast("date")


def _date_from_parts(parts: Column, as_of: date) -> Column:
    first, second, third = (F.get(parts, F.lit(i)) for i in range(3))
    month_first, month_second = lookup(MONTHS, F.lower(first)), lookup(MONTHS, F.lower(second))
    month, day = F.coalesce(month_first, month_second), F.when(month_first.isNotNull(), second).otherwise(first)
    this_year = _date_of(F.lit(str(as_of.year)), month, day)
    yearless = (
        F.when((month == "2") & (day == "29"), F.lit(_latest_leap_day(as_of)))
        .when(this_year <= F.lit(as_of), this_year)
        .otherwise(_date_of(F.lit(str(as_of.year - 1)), month, day))
    )
    # Two digits are a year of 1969 to 2068.
    short = third.rlike(r"^\d{2}$")
    year = F.when(short, F.concat(F.when(third >= "69", F.lit("19")).otherwise(F.lit("20")), third)).otherwise(third)
    numeric = F.coalesce(_date_of(year, second, first), _date_of(year, first, second))
    return (
        F.when(first.rlike(r"^\d{4}$"), _date_of(first, second, F.regexp_extract(third, r"^([0-9]{1,2})$", 1)))
        .when(F.size(parts) > 3, F.lit(None).cast("date"))
        .when(month.isNotNull() & third.isNull() & day.rlike(r"^\d{4}$"), _date_of(day, month, F.lit("1")))
        .when(month.isNotNull(), F.when(third.isNull(), yearless).otherwise(_date_of(year, month, day)))
        .when(F.length(year) == 4, numeric)
    )


def date_of(text: ColumnLike, as_of: date) -> Column:
    def read(column: Column) -> Column:
        def at(position: int, length: int) -> Column:
            return F.substring(column, position, length)

        ten = F.length(column) == 10
        year, second, first = at(7, 4), at(4, 2), at(1, 2)
        return (
            F.when(ten & (at(5, 1) == "-"), column.try_cast("date"))
            .when(
                ten & (at(3, 1) == "/") & (at(6, 1) == "/"),
                F.coalesce(_date_of(year, second, first), _date_of(year, first, second)),
            )
            .when(
                column.isNotNull(),
                let(
                    F.split(F.regexp_replace(column, TIME_OF_DAY, ""), DATE_SEPARATORS),
                    lambda parts: _date_from_parts(parts, as_of),
                ),
            )
        )

    return let(as_column(text), read)


def clean_date(value: ColumnLike, as_of: date) -> Column:
    """Date from ISO, day-first, month-first, ``23 Jul 2001``, ``July 2025`` or year-less text.

    ISO text keeps its meaning, numeric dates are read day first and month first only
    if that fails, a time behind a date does not count, a year of two digits lies in
    1969 to 2068, a month with a year is its first day, and a date without a year is
    the latest such day that is not after ``as_of``.
    """
    return date_of(blank_to_null(value), as_of)


def unflagged(text: ColumnLike) -> Column:
    """The e-mail as it was typed, without the flag of an earlier cleaning."""
    column = as_column(text)
    return F.when(column.startswith(INVALID), strip(F.substr(column, F.lit(len(INVALID) + 1)))).otherwise(
        column
    )


def email_is_valid(email: ColumnLike) -> Column:
    """True for exactly one ``@`` and a dotted domain; missing gives false."""
    return F.coalesce(unflagged(blank_to_null(email)).rlike(EMAIL_SHAPE), F.lit(False))


def flagged_email_of(text: ColumnLike, valid: ColumnLike) -> Column:
    return F.when(as_column(valid), as_column(text)).otherwise(F.concat(F.lit(INVALID), as_column(text)))


def flag_email(email: ColumnLike) -> Column:
    """E-mail text with ``INVALID: `` in front of a broken one; missing gives an empty text."""
    text = unflagged(blank_to_null(email))
    return F.coalesce(flagged_email_of(text, text.rlike(EMAIL_SHAPE)), F.lit(""))


def email_in_text(text: ColumnLike) -> Column:
    """First e-mail address inside a text, or null."""
    found = F.regexp_extract(as_column(text), EMAIL_IN_TEXT, 0)
    return F.when(found != "", found)


def message_text(message: ColumnLike) -> Column:
    """Lower-case message without surrounding quote characters; missing gives null."""
    return present(F.lower(strip(F.btrim(strip(message), F.lit(QUOTES)))))


def city_title(city: ColumnLike) -> Column:
    return F.initcap(strip(city))


def first_present(*candidates: ColumnLike, default: str | None = None) -> Column:
    """First candidate that is neither null nor blank."""
    present = [blank_to_null(c) for c in candidates]
    return F.coalesce(*present, *([] if default is None else [F.lit(default)]))


def format_gbp(amount: ColumnLike) -> Column:
    """``£1,234``: whole pounds, cut and not rounded."""
    return F.concat(F.lit("£"), F.format_number(whole(amount), 0))


def format_thousands(value: ColumnLike) -> Column:
    return F.format_number(whole(value), 0)


def next_tuesday(as_of: date | Column) -> Column:
    """The first Tuesday strictly after the run date."""
    return F.next_day(as_of if isinstance(as_of, Column) else F.lit(as_of), "TU")


def long_date(day: Column) -> Column:
    """``Tuesday 08 December 2026``."""
    return F.date_format(day, "EEEE dd MMMM yyyy")


def days_since(day: ColumnLike, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), as_column(day))


def is_uk(country: ColumnLike, names: tuple[str, ...] = ("UK",), fold_case: bool = True,
          blank_is_uk: bool = False) -> Column:
    """UK test shared by all operators; never null."""
    text = F.upper(strip(country)) if fold_case else as_column(country)
    test = F.coalesce(text.isin(*names), F.lit(False))
    if blank_is_uk:
        test = test | blank_to_null(country).isNull()
    return test
