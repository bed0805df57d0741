"""Text / CSV column expressions with the reference's Java parsing rules."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_RE = r"^[+-]?[0-9]+$"


def decode_payload(payload: Column) -> Column:
    """bytes -> UTF-8 string; malformed bytes become U+FFFD (never fails)."""
    return F.make_valid_utf8(payload.cast("string"))


def csv_fields(text: Column, delimiter: str = ",") -> Column:
    """Positional split on a literal delimiter, no quoting. Like Java's
    ``String.split``, trailing empty fields are dropped."""
    d = re.escape(delimiter)
    if len(delimiter) == 1:
        stripped = F.rtrim(text, F.lit(delimiter))
    else:
        stripped = F.regexp_replace(text, f"(?:{d})+$", "")
    # only delimiters: every field is a trailing empty one -> no fields
    return F.when((stripped == F.lit("")) & (text != F.lit("")), F.array().cast("array<string>")) \
            .otherwise(F.split(stripped, d, -1))


def field_at(fields: Column, i: int) -> Column:
    """0-based field, null when missing."""
    return F.get(fields, i)


def java_int(s: Column) -> Column:
    """``Integer.valueOf``: optional sign + digits, within int range; else null."""
    return F.when(s.rlike(_INT_RE), s.try_cast("int"))


def java_long(s: Column) -> Column:
    return F.when(s.rlike(_INT_RE), s.try_cast("bigint"))


def java_float(s: Column) -> Column:
    return F.trim(s).try_cast("float")


def java_double(s: Column) -> Column:
    return F.trim(s).try_cast("double")


def java_bool(s: Column) -> Column:
    """``Boolean.valueOf``: only a case-insensitive ``true`` is true."""
    return F.coalesce(F.lower(s) == F.lit("true"), F.lit(False))


# Fixed value: the word pattern of the word-count sample (splits on runs of
# anything but ASCII letters and apostrophes).
WORD_SPLIT = "[^a-zA-Z']+"


WORD = "[a-zA-Z']+"


def tokenize(text: Column) -> Column:
    """Array of words; empties are removed by the caller (``drop_empty``)."""
    return F.split(text, WORD_SPLIT, -1)


def words_of(text: Column) -> Column:
    """The non-empty tokens of ``tokenize`` directly: the maximal runs of
    letters/apostrophes (one regex pass, no empty strings to filter)."""
    return F.regexp_extract_all(text, F.lit(WORD), 0)
