"""Scalar helpers beside the Spark built-ins."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_IDENTIFIER = 64

# SQL date pattern tokens and their Java counterparts.
DATE_PATTERN_TOKENS = {
    "YYYY": "yyyy",
    "YY": "yy",
    "MM": "MM",
    "MON": "MMM",
    "MONTH": "MMMM",
    "DD": "dd",
    "HH24": "HH",
    "HH12": "hh",
    "HH": "hh",
    "MI": "mm",
    "SS": "ss",
    "MS": "SSS",
    "US": "SSSSSS",
    "AM": "a",
    "PM": "a",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_substring(text: Column | str, start: int, length: int | None = None) -> Column:
    """SQL-standard ``SUBSTRING(x FROM start FOR length)``: positions before 1 use up length but yield nothing."""
    text = _col(text)
    if length is not None and length < 0:
        raise ValueError("negative substring length")
    first = max(start, 1)
    if length is None:
        return F.substring(text, first, 2**31 - 1)
    return F.substring(text, first, max(start + length - first, 0))


def integer_divide(left: Column | str, right: Column | str) -> Column:
    """Division of integers as SQL defines it: ``12/2`` is ``6``, the fraction is cut off."""
    return F.call_function("div", _col(left), _col(right))


def case_value(subject: Column | str, branches: Mapping, default=None) -> Column:
    """Simple ``CASE subject WHEN k THEN v …``; without a default an unmatched value gives NULL."""
    if not branches:
        raise ValueError("CASE needs at least one branch")
    subject = _col(subject)
    chain = None
    for when, then in branches.items():
        chain = F.when(subject == F.lit(when), F.lit(then)) if chain is None else chain.when(subject == F.lit(when), F.lit(then))
    return chain if default is None else chain.otherwise(F.lit(default))


def java_pattern(sql_pattern: str) -> str:
    """Translate a SQL ``to_timestamp`` pattern (``YYYY-MM-DD HH24:MI:SS``) into the one Spark reads."""
    tokens = sorted(DATE_PATTERN_TOKENS, key=len, reverse=True)

    def convert(piece: re.Match) -> str:
        word = piece.group(0)
        known = DATE_PATTERN_TOKENS.get(word.upper())
        if known is not None:
            return known
        if word.isalpha():
            raise ValueError(f"unknown token {word!r} in date pattern {sql_pattern!r}")
        return word

    return re.sub("|".join(tokens) + r"|[A-Za-z]+", convert, sql_pattern, flags=re.IGNORECASE)


def parse_timestamp(text: Column | str, sql_pattern: str) -> Column:
    """``to_timestamp(text, pattern)`` without a zone."""
    return F.call_function("to_timestamp_ntz", _col(text), F.lit(java_pattern(sql_pattern)))


def epoch_to_utc(seconds: Column | str) -> Column:
    """Whole seconds since 1970-01-01 UTC as a zone-free UTC timestamp, whatever the session zone is."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _col(seconds).cast("decimal(18,6)"))


def content_hash(content: Column | str) -> Column:
    """SHA-256 of the whole content, as lower-case hex."""
    return F.sha2(_col(content), 256)


def checked_identifier(name: str, max_length: int | None = MAX_IDENTIFIER) -> str:
    """A 1- to 3-part name that is safe to place in generated SQL, or ValueError. The length limit is that of the
    source databases."""
    if name is None:
        raise ValueError("an identifier is required")
    name = name.strip()
    if not name:
        raise ValueError("an identifier is required")
    if max_length is not None and len(name) > max_length:
        raise ValueError(f"identifier longer than {max_length} characters: {name!r}")
    if not re.fullmatch(r"[\w.\-]+", name):
        raise ValueError(f"identifier with characters that are not allowed: {name!r}")
    return name


def quote_name(name: str, quote: str = "`", end_quote: str | None = None, max_length: int | None = MAX_IDENTIFIER) -> str:
    """Quote each part of a dotted name; None lifts the length limit, for Spark's own names."""
    end_quote = end_quote or quote
    parts = checked_identifier(name, max_length).split(".")
    if "" in parts:
        raise ValueError(f"identifier with an empty part: {name!r}")
    return ".".join(f"{quote}{part}{end_quote}" for part in parts)


def quote_column(name: str) -> str:
    """Backtick-quote one column name of any characters, for use with ``F.col``."""
    return "`" + name.replace("`", "``") + "`"
