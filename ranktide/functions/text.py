"""Normalising text and numbers that arrive as strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All white space, Unicode included, and the four ASCII separators.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def strip(value: Column) -> Column:
    """Without white space at either end; a plain trim, which is far cheaper than a pattern."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def keyword_key(value: Column) -> Column:
    """Natural key of a keyword: stripped and lower-cased."""
    return F.lower(strip(value))


def url_key(value: Column) -> Column:
    """Natural key of a page: stripped, letter case kept."""
    return strip(value)


def is_blank(value: Column) -> Column:
    return strip(F.coalesce(value, F.lit(""))) == ""


def url_host(url: Column) -> Column:
    """Host part of an absolute URL; an empty string when there is none."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def is_day(value: Column) -> Column:
    """True for text that is a day of the calendar, written as YYYY-MM-DD."""
    return F.coalesce(value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull(), F.lit(False))


def parse_int(value: Column, type_name: str = "bigint") -> Column:
    """Whole number from text; NULL when the text is not one or does not fit."""
    # The cast takes ordinary white space by itself; other kinds are stripped only if it fails.
    return F.coalesce(value.try_cast(type_name), strip(value).try_cast(type_name))


def is_malformed_int(value: Column, type_name: str = "bigint") -> Column:
    """True for text that is present but is no whole number of the type."""
    return (F.coalesce(value, F.lit("")) != "") & parse_int(value, type_name).isNull()
