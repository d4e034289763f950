"""Canonical forms of session codes, page numbers, URLs and clock times (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Session codes: date parts and the number of the diary, with any separators.
CODE = r"^(\d{4})[^0-9A-Za-z]+(\d{1,2})[^0-9A-Za-z]+(\d{1,2})[^0-9A-Za-z]+0*(\d+)$"
#: Clock times: h:m[:s], h.m[.s] and "h m s" with unit letters.
CLOCK = r"^(\d{1,3})\s*[:.hH]\s*(\d{1,2})(?:\s*[:.mM]\s*(?:(\d{1,2})\s*[sS]?)?)?$"
# Fixed value: blanks of any kind.
BLANKS = " \t\n\r\x0b\x0c\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def bare(c: Column) -> Column:
    """Without surrounding blanks of any kind; null where nothing is left."""
    return F.nullif(F.btrim(c, F.lit(BLANKS)), F.lit(""))


def _parts(c: Column, pattern: str, groups: int, use) -> Column:
    """``use`` of the array of the pattern's groups in the bare text, null where it doesn't fit; one pass of the pattern."""
    to = "\u0001".join(f"${k}" for k in range(1, groups + 1))
    fits = lambda p: F.size(p) == groups
    split = F.split(F.regexp_replace(bare(c), pattern, to), "\u0001")
    return F.get(F.transform(F.array(split), lambda p: F.when(fits(p), use(p))), F.lit(0))


def session_code(c: Column) -> Column:
    """``yyyy_mm_dd_n``, n without leading zeros; null if the text is no code."""
    two = lambda x: F.lpad(x, 2, "0")
    return _parts(c, CODE, 4, lambda p: F.concat_ws("_", F.get(p, F.lit(0)), two(F.get(p, F.lit(1))), two(F.get(p, F.lit(2))), F.get(p, F.lit(3))))


def code_key(c: Column) -> Column:
    """The canonical code, or the bare lower-case text where it is no code."""
    return F.coalesce(session_code(c), F.lower(bare(c)))


def page_key(c: Column) -> Column:
    return F.regexp_replace(bare(c.cast("string")), r"^0+(?=\d)", "")


def url_key(c: Column) -> Column:
    """Lower case, without scheme and final slashes."""
    return F.regexp_replace(F.lower(bare(c)), r"^[a-z][a-z0-9+.-]*://|/+$", "")


def clock_seconds(c: Column) -> Column:
    """Seconds since midnight of the session's day, null if unreadable.

    Times before 06:00:00 belong to the next day; hours from 24 on are meant literally.
    """

    def seconds(p: Column) -> Column:
        h, m = F.get(p, F.lit(0)).cast("int"), F.get(p, F.lit(1)).cast("int")
        s = F.coalesce(F.nullif(F.get(p, F.lit(2)), F.lit("")).cast("int"), F.lit(0))
        total = h * 3600 + m * 60 + s
        return F.when((m < 60) & (s < 60), F.when(total < 6 * 3600, total + 86400).otherwise(total))

    return _parts(c, CLOCK, 3, seconds).cast("int")
