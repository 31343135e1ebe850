"""Text building blocks as columns: white space, counts, rounding."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All characters that count as white space, inside a class: those of (?U)\s and U+001C to U+001F. The low ones by themselves, which Java keeps as bits;
#: the others behind one comparison.
SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"


def count_char(text: Column, char: str) -> Column:
    """How often one character occurs."""
    return (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))).cast("long")


def count_of(text: Column, phrase: str) -> Column:
    """Non-overlapping occurrences of a phrase from left to right; texts without it skip the replacement."""
    length = len(phrase)
    gone = F.length(text) - F.length(F.replace(text, F.lit(phrase), F.lit("")))
    return F.when(F.contains(text, F.lit(phrase)), gone / F.lit(length)).otherwise(F.lit(0)).cast("long")


def count_all(text: Column, phrases: Iterable[str]) -> Column:
    """Occurrences of several phrases, each counted by itself, so nested ones count twice."""
    return reduce(lambda a, b: a + b, [count_of(text, p) for p in sorted(phrases)])


def contains_any(text: Column, phrases: Iterable[str]) -> Column:
    """Whether any phrase occurs."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in sorted(phrases)])


def matches(text: Column, pattern: str, flags: str = "U") -> Column:
    """Whether a pattern occurs."""
    return F.rlike(text, F.lit(f"(?{flags}){pattern}"))


def count_matches(text: Column, pattern: str, flags: str = "U") -> Column:
    """Non-overlapping matches of a pattern."""
    return F.regexp_count(text, F.lit(f"(?{flags}){pattern}")).cast("long")


def ratio(part: Column, whole: Column, digits: int) -> Column:
    """part / whole to so many digits, halves up, by whole numbers; whole counts as 1 if it is 0."""
    whole = F.greatest(whole, F.lit(1)).cast("long")
    scaled = F.call_function("div", part.cast("long") * F.lit(2 * 10**digits) + whole, whole * 2)
    return scaled / F.lit(float(10**digits))


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, f"(?U)^[{SPACE}]+|[{SPACE}]+\\z", "")


def words(text: Column) -> Column:
    """The tokens between white space."""
    return F.filter(F.split(text, f"(?U)[{SPACE}]+"), lambda w: w != "")
