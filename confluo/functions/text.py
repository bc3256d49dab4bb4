"""Scalar normalizers of names, addresses, titles and skills, as Column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode text knows it, spelled out because Java's \s is narrower.
WS = r"[\t-\r\x1c-\x1f\x85\p{Z}]"
NOT_WS = r"[^\t-\r\x1c-\x1f\x85\p{Z}]"
EMAIL = r"^[^@\t-\r\x1c-\x1f\x85\p{Z}]+@[^@\t-\r\x1c-\x1f\x85\p{Z}]+\.[^@\t-\r\x1c-\x1f\x85\p{Z}]+\z"
#: What marks a position that is still held.
ONGOING = ("present", "current", "ongoing")


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, where c is worked out once however often f names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+\\z", "")


def strip_chars(c: Column, chars: str) -> Column:
    """c without the given characters at either end; ``chars`` is the inside of a character class."""
    return F.regexp_replace(c, f"^[{chars}]+|[{chars}]+\\z", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def filled(c: Column) -> Column:
    """Null for the empty string."""
    return F.when(c != "", c)


def present(c: Column, kind: str = "string") -> Column:
    """Whether a value counts as given: neither null nor empty; zero is given. kind: string, array, map or number."""
    if kind == "string":
        return F.coalesce(c != "", F.lit(False))
    if kind in ("array", "map"):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull()


def size_of(c: Column, kind: str = "string") -> Column:
    """Characters of a string, elements of an array or map; 0 for all else."""
    if kind == "string":
        return F.coalesce(F.length(c), F.lit(0))
    if kind in ("array", "map"):
        return F.coalesce(F.size(c), F.lit(0))
    return F.lit(0)


def as_list(c: Column, is_array: bool = False) -> Column:
    """A value as an array: null is an empty one, a scalar an array of one."""
    if is_array:
        return F.coalesce(c, F.array().cast("array<string>"))
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(c))


def clean(c: Column) -> Column:
    return filled(strip(c))


def normalize_name(c: Column) -> Column:
    return filled(collapse(c))


def normalize_email(c: Column) -> Column:
    """Stripped and lower-cased if it has the shape of an address, else null."""
    e = F.lower(strip(c))
    return F.when(e.rlike(EMAIL), e)


def distinct_present(values: Column) -> Column:
    """The values of an array that aren't null, each once, in the order first seen."""
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull()))


def normalize_emails(values: Column) -> Column:
    return distinct_present(F.transform(values, normalize_email))


def normalize_skill(c: Column) -> Column:
    """The key under which spellings of a skill meet: lower case without white space and hyphens."""
    return F.regexp_replace(F.lower(c), r"[\t-\r\x1c-\x1f\x85\p{Z}-]", "")


def alnum(c: Column) -> Column:
    """Lower-case ASCII letters and digits alone; empty for null."""
    return F.coalesce(F.regexp_replace(F.lower(c), "[^a-z0-9]", ""), F.lit(""))


normalize_degree = alnum


def normalize_title(c: Column) -> Column:
    return F.coalesce(collapse(F.lower(c)), F.lit(""))
