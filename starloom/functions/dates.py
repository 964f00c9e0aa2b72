"""Date parsers and date keys. Nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.text import blank_to_null
from starloom.schema import UNKNOWN_KEY

# Fixed value: month/day/year and a 12-hour clock, one or two digits each.
US_TIMESTAMP = "M/d/yyyy h:mm a"


# Fixed value: a whole ISO date, with or without a time of day from 0:00 to 23:59:59.
ISO_DATE = (
    r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T]([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]+)?)?)?\z"
)


def is_us_timestamp(col: Column) -> Column:
    """Whether the text fits the mask; never raises."""
    return F.try_to_timestamp(blank_to_null(col), F.lit(US_TIMESTAMP)).isNotNull()


def parse_us_timestamp(col: Column, strict: bool = True) -> Column:
    """``09/01/2023 10:07 AM`` as TIMESTAMP_NTZ; blank is NULL.

    ``strict`` raises on other text (under ANSI mode); otherwise NULL.
    """
    stamp = F.to_timestamp_ntz(blank_to_null(col), F.lit(US_TIMESTAMP))
    return stamp if strict else F.when(is_us_timestamp(col), stamp)


def _is_plain_date(text: Column) -> Column:
    """Whether the text has the places of 2024-03-01, which most have: cheaper to see than to match.

    A cast reads nothing else of this form but a whole date, as a ``T`` may not stand last.
    """
    dash = lambda place: F.substring(text, place, 1) == "-"
    return (F.octet_length(text) == 10) & dash(5) & dash(8) & (F.substring(text, 10, 1) != "T")


def parse_date(col: Column, strict: bool = True) -> Column:
    """ISO date text as DATE; blank is NULL.

    ``strict`` raises on other text (under ANSI mode); otherwise NULL. Part of a date, and
    a date with anything but a time of day behind it, are other text.
    """
    text = blank_to_null(col)
    fits = _is_plain_date(text) | text.rlike(ISO_DATE)
    if strict:
        return F.when(fits, text).otherwise(F.concat(F.lit("no date: "), text)).cast("date")
    return F.when(fits, text).try_cast("date")


def date_key(date: Column) -> Column:
    """YYYYMMDD as INT; a missing date gives the key of the unknown member."""
    key = F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
    return F.coalesce(key, F.lit(UNKNOWN_KEY))
