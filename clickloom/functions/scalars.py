"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_long_string(number: Column, text: Column, sep: str) -> Column:
    """``number + sep + text``; a null on either side is written as ``null``."""
    return F.concat(
        F.coalesce(number.cast("string"), F.lit("null")),
        F.lit(sep),
        F.coalesce(text, F.lit("null")),
    )


def json_field(json: Column, field: str) -> Column:
    """Top-level field of a JSON object as text, dots in its name included; numbers keep their JSON spelling."""
    return F.get_json_object(json, f"$['{field}']")


# --- time -------------------------------------------------------------------

_TIME = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}"


def parse_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text (the hour may have one digit) to timestamp, null if unreadable.

    What follows the seconds is ignored; a time without date or a date without time is unreadable. A cast is
    parsed by generated code; a pattern would go through a formatter per row.
    """
    return F.regexp_extract(text, _TIME, 0).try_cast("timestamp")


def parse_date_key(text: Column) -> Column:
    """``yyyyMMdd`` text to date, null if unreadable."""
    return F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")


def format_date(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def format_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def format_date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def format_time_minute(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm")


def date_hour(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH")


def before(left: Column, right: Column) -> Column:
    """True when the time text ``left`` is earlier; false when either is unreadable."""
    return F.coalesce(parse_time(left) < parse_time(right), F.lit(False))


def after(left: Column, right: Column) -> Column:
    """True when the time text ``left`` is later; false when either is unreadable."""
    return F.coalesce(parse_time(left) > parse_time(right), F.lit(False))


def minus_seconds(left: Column, right: Column) -> Column:
    """Seconds from the time text ``right`` to ``left``; 0 when either is unreadable."""
    seconds = F.unix_seconds(parse_time(left)) - F.unix_seconds(parse_time(right))
    return F.coalesce(seconds, F.lit(0))


def today() -> Column:
    return F.current_date().cast("string")


def yesterday() -> Column:
    return F.date_sub(F.current_date(), 1).cast("string")


# --- numbers and text -------------------------------------------------------


def ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """``numerator / denominator`` of two counts, rounded half up to ``scale`` decimals.

    Integer arithmetic, so the result does not depend on binary fractions. Null on a zero denominator.
    """
    unit = 10**scale
    doubled = F.lit(2) * denominator
    # Null out a zero divisor first: integer division by zero raises in ANSI mode.
    safe = F.when(denominator != 0, doubled)
    # The division operator of Column is the fractional one; "div" keeps integers.
    half_up = F.call_function("div", F.lit(2 * unit) * numerator + denominator, safe)
    return half_up / F.lit(float(unit))


def is_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def is_not_empty(text: Column) -> Column:
    return ~is_empty(text)


def trim_comma(text: Column) -> Column:
    """Remove at most one comma from each end."""
    return F.regexp_replace(text, "^,|,$", "")


def pad2(text: Column) -> Column:
    """Two-character text is kept, anything else gets one leading zero."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))
