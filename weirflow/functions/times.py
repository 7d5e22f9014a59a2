"""Time and date columns. All text is UTC: the session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to an instant, NULL where it is not one.

    The text must begin with a date: a bare time of day would mean another instant
    on each day it is read.
    """
    dated = text.rlike(r"^\s*[+-]?\d{4,}(-\d{1,2})?(-\d{1,2})?([T ].*)?\s*$")
    return F.when(dated, F.try_to_timestamp(text))


def datetime_text(instant: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, fractions cut."""
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss")


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970; a time-zone-free timestamp is read as UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def millis_to_seconds(millis: Column) -> Column:
    """Whole seconds in integer arithmetic, cut toward zero."""
    return F.call_function("div", millis.cast("bigint"), F.lit(1000))


def micros_to_seconds(micros: Column) -> Column:
    return F.call_function("div", micros.cast("bigint"), F.lit(1_000_000))


def millis_or_now(text: Column, now: Column | None = None) -> Column:
    """Epoch-millisecond text to an instant; text that is no number becomes ``now``."""
    parsed = F.timestamp_millis(F.trim(text).try_cast("bigint"))
    return F.coalesce(parsed, F.current_timestamp() if now is None else now)


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def change_sequence(millis: Column | None = None) -> Column:
    """Arrival time, by default now, as lower-case hexadecimal milliseconds."""
    return F.lower(F.hex(now_millis() if millis is None else millis))


def newest_first_key(dim: Column, millis: Column) -> Column:
    """``dim#(2^63-1 - millis)``: ascending text order is newest first per dimension."""
    return F.concat(dim, F.lit("#"), (F.lit(2**63 - 1) - millis).cast("string"))


def window_path(window_end: Column) -> Column:
    """Folder ``yyyy/MM/dd/HH`` of a window, from its end."""
    return F.date_format(window_end, "yyyy/MM/dd/HH")


def window_stamp(window_end: Column) -> Column:
    """Last millisecond of the window as file-name-safe ISO text."""
    last = window_end - F.expr("INTERVAL 1 MILLISECOND")
    return F.translate(F.date_format(last, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), ":", "-")
