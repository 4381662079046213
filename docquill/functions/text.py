"""String helpers with the whitespace rules of Python's str methods."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that str.strip and str.split remove.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same as a class, for patterns with the flag (?U): its \s lacks four of them.
SPACE = r"[\s\x1c-\x1f]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """NULL, empty or only whitespace."""
    return F.coalesce(strip(c) == "", F.lit(True))


def words(c: Column) -> Column:
    """Whitespace-separated words, no empty ones."""
    return F.array_remove(F.split(c, f"(?U){SPACE}+"), "")


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)[^\s\x1c-\x1f]+")), F.lit(0))


def lines(c: Column) -> Column:
    """Stripped, non-blank lines."""
    return F.array_remove(F.transform(F.split(c, "\n"), strip), "")


def tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), "")


def est_tokens(c: Column) -> Column:
    """Token estimate by words, 1.25 per word, rounded down."""
    return F.floor(word_count(c) * F.lit(1.25)).cast("int")


def contains_any(c: Column, phrases: list[str]) -> Column:
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | F.contains(c, F.lit(phrase))
    return hit


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double, NULL when b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def fixed(c: Column, places: int) -> Column:
    """A number with a fixed number of decimals; halves go to the even digit, as in Python.

    A double lies half-way between two such decimals only if it is a whole
    number of 2^-(places + 1).
    """
    halves = c * F.lit(float(2 ** (places + 1)))
    return F.format_string(f"%.{places}f", F.when(halves == F.floor(halves), F.bround(c, places)).otherwise(c))
