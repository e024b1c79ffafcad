"""String and id column functions (JVM-side expressions, no UDFs)."""

from __future__ import annotations

import string
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whitespace_class() -> str:
    """Regex class of every code point Python's ``str.isspace`` accepts
    (what the source helpers strip), as ``\\x{..}`` ranges that both Java
    regex and RE2 read the same way."""
    points = [c for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    ranges, start, prev = [], points[0], points[0]
    for p in points[1:] + [None]:
        if p is not None and p == prev + 1:
            prev = p
            continue
        ranges.append(f"\\x{{{start:x}}}" if start == prev else f"\\x{{{start:x}}}-\\x{{{prev:x}}}")
        if p is not None:
            start = prev = p
    return "[" + "".join(ranges) + "]"


WHITESPACE = _whitespace_class()
STRIP_PATTERN = f"^{WHITESPACE}+|{WHITESPACE}+$"
# the same set as characters, for trim(): linear time on long texts
WHITESPACE_CHARS = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` without
    a character set only removes the space character)."""
    return F.trim(_c(c), F.lit(WHITESPACE_CHARS))


# -- O34 ---------------------------------------------------------------------
def clean_list(arr: Column | str) -> Column:
    """Drop white-space-only elements and strip the rest; null -> [].

    The empty string is kept (it is not "white space only"), null elements
    are dropped.
    """
    a = _c(arr)
    kept = F.filter(a, lambda x: x.isNotNull() & ((x == F.lit("")) | (strip(x) != F.lit(""))))
    return F.coalesce(F.transform(kept, lambda x: strip(x)), F.array().cast("array<string>"))


# -- O35 ---------------------------------------------------------------------
def flatten_whitespace(c: Column | str) -> Column:
    """CR, LF and TAB each become one space, then strip."""
    return strip(F.translate(_c(c), "\r\n\t", "   "))


# -- O36 ---------------------------------------------------------------------
# 63 symbols: digits, upper case, lower case, underscore (safe in file names)
ALPHABET = string.digits + string.ascii_uppercase + string.ascii_lowercase + "_"
BASE = len(ALPHABET)
DIGITS_PER_HALF = 11  # 63**10 < 2**60 <= 63**11
POWERS = [BASE ** e for e in range(DIGITS_PER_HALF)]


def _encode_half_sql(hex_sql: str) -> str:
    """Base-63 digits of a 60-bit value, most significant first, as one
    ``concat`` of 11 ``substr`` picks (no lambda, so the value is computed
    once per row by common-subexpression elimination)."""
    value = f"CAST(conv({hex_sql}, 16, 10) AS BIGINT)"
    digits = [f"substr('{ALPHABET}', CAST(({value} div CAST({POWERS[e]} AS BIGINT)) % {BASE} + 1 AS INT), 1)"
              for e in range(DIGITS_PER_HALF - 1, -1, -1)]
    return "concat(" + ", ".join(digits) + ")"


def surrogate_key(*names: str) -> Column:
    """Repeatable 22-character id over a 63-symbol alphabet.

    MD5 of the key text (parts joined by U+001F; a null part is U+001E n, and
    either character inside a part is led by U+001E, so different keys have
    different texts); the first and the next 60
    bits (15 hex digits each) are written in base 63, 11 digits each, with
    exact integer division. Same key, same id, on every run and engine.
    Takes column names.
    """
    led = "replace(replace(CAST(`{0}` AS STRING), char(30), char(30) || char(30)), char(31), char(30) || char(31))"
    parts = ", ".join(f"coalesce({led.format(n)}, char(30) || 'n')" for n in names)
    h = f"md5(concat_ws(char(31), {parts}))"
    return F.expr(f"concat({_encode_half_sql(f'substr({h}, 1, 15)')}, {_encode_half_sql(f'substr({h}, 16, 15)')})")


# -- O37 ---------------------------------------------------------------------
def parse_taxonomy(c: Column | str) -> Column:
    """'Category;|Subcategory;' -> struct(category, subcategory, level).

    A missing trailing ';' is tolerated; a one-level entry has a null
    subcategory.
    """
    parts = F.split(F.regexp_replace(_c(c), ";$", ""), ";\\|")
    return F.struct(
        parts.getItem(0).alias("category"),
        F.when(F.size(parts) > 1, parts.getItem(1)).alias("subcategory"),
        F.size(parts).alias("level"),
    )


def normalize(c: Column | str) -> Column:
    """Case- and space-insensitive form: strip, collapse white-space runs, lower-case."""
    return F.lower(F.regexp_replace(strip(c), f"{WHITESPACE}+", " "))
