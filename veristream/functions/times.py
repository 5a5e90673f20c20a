"""Time expressions: ISO text, parsing of feed times, hour labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from veristream.functions.text import non_empty

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_Z_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def iso_z(ts: Column, pattern: str = ISO_Z) -> Column:
    """Timestamp as ISO text with ``Z`` (the session zone must be UTC)."""
    return F.date_format(ts, pattern)


def now_z() -> Column:
    return iso_z(F.current_timestamp())


def parse_time(c: Column) -> Column:
    """ISO-8601 or RFC-822 text to a timestamp, null if neither."""
    no_day = F.regexp_replace(c, r"^\w{3}, ", "")
    named_zone = F.regexp_replace(no_day, r" (GMT|UTC|UT|Z)$", " +0000")
    return F.coalesce(
        F.try_to_timestamp(c),
        F.try_to_timestamp(named_zone, F.lit("d MMM yyyy HH:mm:ss Z")),
    )


def sortable(c: Column) -> Column:
    """Feed times as ISO text in UTC; ISO texts in UTC and what cannot be parsed stay as they are."""
    utc = c.rlike(r"^\d{4}-\d{2}-\d{2}([T ][0-9:.]*Z?)?$")
    return F.when(utc, c).otherwise(F.coalesce(iso_z(parse_time(c), ISO_Z_SECONDS), c))


def hour_label(ts_text: Column) -> Column:
    """Characters 12-13 of the time text; '00' where they are blank."""
    hour = non_empty(F.substring(ts_text, 12, 2))
    return F.when(ts_text.isNotNull(), F.coalesce(hour, F.lit("00")))
