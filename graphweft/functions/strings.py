"""String functions of the query language and of the function library."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Letter codes of the simplified soundex behind difference().
SOUNDEX_CODES = {
    "1": "BFPV",
    "2": "CGJKQSXZ",
    "3": "DT",
    "4": "L",
    "5": "MN",
    "6": "R",
}
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def to_upper(s: Column) -> Column:
    return F.upper(s)


def to_lower(s: Column) -> Column:
    return F.lower(s)


def size_of_text(s: Column) -> Column:
    """size/length of a string in characters."""
    return F.char_length(s)


def is_empty_text(s: Column) -> Column:
    """NULL counts as empty."""
    return F.coalesce(F.length(s), F.lit(0)) == 0


def is_empty_list(items: Column) -> Column:
    return F.coalesce(F.array_size(items), F.lit(0)) == 0


def reverse(s: Column) -> Column:
    """Characters (or list elements) in reverse order."""
    return F.reverse(s)


def substring(s: Column, start: int, length: int | None = None) -> Column:
    """Zero-based start."""
    return F.substring(s, start + 1, length if length is not None else 2**31 - 1)


def left(s: Column, n: int) -> Column:
    return F.left(s, F.lit(n))


def right(s: Column, n: int) -> Column:
    return F.right(s, F.lit(n))


def replace(s: Column, search: str, by: str) -> Column:
    return F.replace(s, F.lit(search), F.lit(by))


def split(s: Column, separator: str) -> Column:
    """Pieces between literal separators; empty pieces are dropped."""
    return F.filter(F.split(s, re.escape(separator)), lambda x: x != "")


def replicate(s: Column, n: Column) -> Column:
    """s repeated n times; a negative n is an error."""
    return F.when(n < 0, F.raise_error(F.lit("replicate: negative count"))).otherwise(F.repeat(s, n))


def proper(s: Column) -> Column:
    """Title case after blanks."""
    return F.initcap(s)


def padl(s: Column, n: int) -> Column:
    """Pad with blanks on the left; never shortens."""
    return F.when(F.length(s) < n, F.lpad(s, n, " ")).otherwise(s)


def padr(s: Column, n: int) -> Column:
    return F.when(F.length(s) < n, F.rpad(s, n, " ")).otherwise(s)


def padc(s: Column, n: int) -> Column:
    """Centre; the odd blank goes to the right."""
    room = F.greatest(F.lit(n) - F.length(s), F.lit(0))
    before = F.floor(room / 2).cast("int")
    return F.concat(F.repeat(F.lit(" "), before), s, F.repeat(F.lit(" "), room - before))


def charindex(needle: str, hay: Column, start: int = 1) -> Column:
    """1-based position from ``start``, 0 if absent or if the needle is empty."""
    if needle == "":
        return F.when(hay.isNotNull(), F.lit(0))
    return F.locate(needle, hay, max(start, 1))


def strfilter(s: Column, allowed: str) -> Column:
    """Only the characters that occur in ``allowed``."""
    if not allowed:
        return F.when(s.isNotNull(), F.lit(""))
    return F.regexp_replace(s, "[^" + "".join("\\" + x if not x.isalnum() else x for x in allowed) + "]", "")


def simple_soundex(s: Column) -> Column:
    """First letter, then the codes of all letters including the first; runs are kept, vowels skipped."""
    letters = F.regexp_replace(F.translate(s, _LOWER, _LOWER.upper()), "[^A-Z]", "")
    coded = "".join(SOUNDEX_CODES.values())
    digits = "".join(d * len(v) for d, v in SOUNDEX_CODES.items())
    codes = F.translate(letters, coded + "AEHIOUWY", digits)
    return F.when(letters == "", F.lit("?000")).otherwise(F.concat(F.left(letters, F.lit(1)), F.rpad(F.left(codes, F.lit(3)), 3, "0")))


def difference(a: Column, b: Column) -> Column:
    """0–4: equal positions of the two soundex texts."""
    x, y = simple_soundex(a), simple_soundex(b)
    same = [(F.substring(x, i, 1) == F.substring(y, i, 1)).cast("int") for i in range(1, 5)]
    return same[0] + same[1] + same[2] + same[3]
