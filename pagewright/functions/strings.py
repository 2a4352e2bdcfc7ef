"""String helpers with Unicode white space, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space of any script at either end (trim() removes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Stripped, each run of white space one space."""
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def words(c: Column) -> Column:
    """Maximal runs without white space; an empty array for blank text."""
    return F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def filled(c: Column) -> Column:
    """Whether the text is neither null nor empty."""
    return text_or_empty(c) != ""


def contains_any(c: Column, parts) -> Column:
    """Whether any of the plain strings occurs."""
    return reduce(lambda a, b: a | b, [c.contains(p) for p in parts])


def starts_any(c: Column, parts) -> Column:
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in parts])


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null where nothing matches or the group is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def every(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of every match, in order."""
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two word arrays taken as sets; 0 if either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def is_title(c: Column) -> Column:
    """Each letter that follows a non-letter is upper-case, each that follows a letter is lower-case, and there is one."""
    return c.rlike(r"(?U)\p{L}") & ~c.rlike(r"(?U)(?<!\p{L})\p{Ll}|(?<=\p{L})\p{Lu}")


def is_upper(c: Column) -> Column:
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"\p{Ll}")
