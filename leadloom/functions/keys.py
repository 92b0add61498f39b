"""Identity keys: the normalised values on which two leads are the same party."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.functions.logic import ColumnLike, as_column, let
from leadloom.functions.text import blank_to_null, handle_of, unflagged

# Checked in this order; the first kind that matches names the reason.
KEY_KINDS = ("lead_id", "handle", "email", "phone", "store_city")

MIN_PHONE_DIGITS = 7
MIN_EMAIL_LENGTH = 4


def handle_key(handle: ColumnLike, clean: bool = False) -> Column:
    name = as_column(handle) if clean else handle_of(blank_to_null(handle))
    return F.when(F.length(name) > 1, name)


def email_key(email: ColumnLike, clean: bool = False) -> Column:
    """Lower-case address with repeated ``@`` collapsed, if it then has exactly one."""
    def key(typed: Column) -> Column:
        text = F.when(typed.contains("@@"), F.regexp_replace(typed, "@+", "@")).otherwise(typed)
        one_at = F.length(F.replace(text, F.lit("@"), F.lit(""))) == F.length(text) - 1
        return F.when(one_at & (F.length(text) >= MIN_EMAIL_LENGTH), text)

    return let(F.lower(unflagged(as_column(email) if clean else blank_to_null(email))), key)


def phone_key(phone: ColumnLike) -> Column:
    """Digits without international prefix, UK numbers in national form."""
    def key(digits: Column) -> Column:
        start = F.when(digits.startswith("00"), 3).otherwise(1)
        uk = digits.rlike(r"^(00)?44\d{9}")
        national = F.concat(F.lit("0"), F.substr(digits, start + 2))
        return F.when(
            F.length(digits) >= MIN_PHONE_DIGITS, F.when(uk, national).otherwise(F.substr(digits, start))
        )

    return let(F.regexp_replace(as_column(phone), r"\D", ""), key)


def store_city_key(store: ColumnLike, city: ColumnLike, clean: bool = False) -> Column:
    parts = [as_column(c) if clean else blank_to_null(c) for c in (store, city)]
    return F.concat(F.lower(parts[0]), F.lit("|"), F.lower(parts[1]))


def identity_keys(clean: bool = False) -> Column:
    """Array of ``<kind number>:<key>`` texts of a lead, without missing keys.

    ``clean`` says that the lead went through the cleaning step, so that its
    texts need no trimming.
    """
    keys = (
        F.col("lead_id") if clean else blank_to_null("lead_id"),
        handle_key("handle", clean),
        email_key("email", clean),
        phone_key("phone"),
        store_city_key("store_name", "city", clean),
    )
    return F.array_compact(
        F.array(*[F.concat(F.lit(f"{kind}:"), key) for kind, key in enumerate(keys)])
    )


def kind_of(key: ColumnLike) -> Column:
    """Kind name of a ``<kind number>:<key>`` text."""
    names = F.array(*[F.lit(name) for name in KEY_KINDS])
    return F.element_at(names, F.left(as_column(key), F.lit(1)).cast("int") + 1)


def value_of(key: ColumnLike) -> Column:
    return F.substr(as_column(key), F.lit(3))
