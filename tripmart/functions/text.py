"""String cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters with the Unicode White_Space property, in code point order.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _visible(c: Column) -> Column:
    """Whether the first character is a visible ASCII one: a comparison of bytes."""
    return (c >= "!") & (c < "\x7f")


def trim_ws(c: Column) -> Column:
    """Strip every kind of white space from both ends (Spark's ``trim`` only strips U+0020).

    Stripping a set of characters looks up each of them in the set. What begins and ends with a visible ASCII
    character once U+0020 is stripped has nothing else to lose, so only other texts go that way.
    """
    plain = F.trim(c)
    ends = _visible(plain) & _visible(F.substring(plain, -1, 1))
    return F.when(ends, plain).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def not_blank(c: Column) -> Column:
    """Whether anything is left after trimming. Stops at the first visible character."""
    return c.rlike(f"[^{WHITESPACE}]")


def blank_to_null(c: Column) -> Column:
    """Trim, then turn an empty result into NULL."""
    return F.nullif(trim_ws(c), F.lit(""))


def fold(c: Column) -> Column:
    """Case- and space-insensitive form of a label."""
    return F.lower(trim_ws(c))
