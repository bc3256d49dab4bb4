"""Year-month normalization."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ONGOING, WS, filled, strip

#: English month names; their first three letters count as well.
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
)

#: How many parts a numeric date has, where its year of four digits and its month stand, and the month's greatest width. The first that fits counts.
LAYOUTS = ((3, 2, 1, 99), (3, 0, 1, 99), (3, 1, 2, 99), (2, 1, 0, 2), (2, 0, 1, 2))


def _year_month(year: Column, month: Column) -> Column:
    """YYYY-MM if the month is 1 to 12 and the year 1 to 9999."""
    y, m = year.try_cast("int"), month.try_cast("int")
    return F.when(m.between(1, 12) & y.between(1, 9999), F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), F.lpad(m.cast("string"), 2, "0")))


def _month_number(word: Column) -> Column:
    return reduce(lambda chosen, k: chosen.when(word.isin(MONTHS[k], MONTHS[k][:3]), k + 1), range(1, 12), F.when(word.isin(MONTHS[0], MONTHS[0][:3]), 1))


def normalize_date(c: Column) -> Column:
    """YYYY-MM, or null for ongoing markers and what can't be read.

    First: the first word that names a month, with the first four digits in a row. Else
    parts between hyphens and slashes, all digits: of three, the year is the third, else the
    first, else the second, whichever has four digits, and the month the one beside it that
    makes DD-MM-YYYY, YYYY-MM-DD or DD-YYYY-MM; of two, the year has four digits and the
    month two at most. A day is never checked.
    """

    def of_parts(parts: Column) -> Column:
        def fit(n: int, year: int, month: int, widest: int) -> tuple[Column, Column]:
            y, m = (F.get(parts, F.lit(k)) for k in (year, month))
            return (F.size(parts) == n) & (F.length(y) == 4) & (F.length(m) <= widest), _year_month(y, m)

        first, *others = (fit(*layout) for layout in LAYOUTS)
        numeric = F.forall(parts, lambda p: p.rlike(r"^\p{Nd}+\z"))
        return F.when(numeric, reduce(lambda chosen, f: chosen.when(*f), others, F.when(*first)))

    def of_text(s: Column) -> Column:
        ongoing = F.regexp_replace(F.lower(s), f"{WS}+", "").isin(*ONGOING)
        words = F.regexp_extract_all(F.lower(s), F.lit("([a-z]+)"), 1)
        month = F.get(F.filter(F.transform(words, _month_number), lambda m: m.isNotNull()), F.lit(0))
        four = filled(F.regexp_extract(s, r"(\p{Nd}{4})", 1))
        named = F.transform(F.array(F.when(four.isNotNull(), month)), lambda m: F.struct(m.isNotNull().alias("any"), _year_month(four, m).alias("value")))[0]
        parts = F.filter(F.transform(F.split(s, "[-/]"), strip), lambda p: p != "")
        by_number = F.transform(F.array(parts), of_parts)[0]
        return F.when(ongoing, None).otherwise(F.transform(F.array(named), lambda n: F.when(n["any"], n["value"]).otherwise(by_number))[0])

    # Arrays of one element name a value, so that it is computed once.
    return F.transform(F.array(strip(c)), of_text)[0]


def year_from_date(c: Column) -> Column:
    """The first four digits in a row if they are 1 to 9999, else the year of ``normalize_date``."""
    y = filled(F.regexp_extract(c, r"(\p{Nd}{4})", 1)).try_cast("int")
    return F.coalesce(F.when(y.between(1, 9999), y), F.substring(normalize_date(c), 1, 4).cast("int"))


def year_of(year_month: Column) -> Column:
    return filled(F.regexp_extract(year_month, r"^(\p{Nd}{4})", 1)).try_cast("int")
