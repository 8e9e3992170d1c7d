"""Column helpers for dirty text: keys, placeholders, trimming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings that mean "not stated" (compared trimmed and in lower case).
NOT_STATED = ("", "unknown", "n/a", "na", "none", "nan", "not reported")


#: Unicode's white space.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """``c`` without outer white space of any kind (tabs, line breaks and no-break spaces too)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def norm_key(c: Column) -> Column:
    """A key for comparison: apart from letter case and outer white space. Null stays null."""
    return F.lower(strip(c))


def stated(c: Column) -> Column:
    """True where a text holds a value, false for null and for the ``NOT_STATED`` spellings."""
    return c.isNotNull() & ~norm_key(c).isin(*NOT_STATED)
