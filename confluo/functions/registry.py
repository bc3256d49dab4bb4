"""The scalar functions by name: for plans as Columns, and for SQL texts as temporary SQL functions.

A registered function is its Column's own expression, so Spark puts it into the query that
calls it; nothing runs in Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dates, geo, phones, resume, text

LIST, PLACE = "ARRAY<STRING>", "STRUCT<city: STRING, region: STRING, country: STRING>"


@dataclass(frozen=True)
class Function:
    """``make`` gives the Column for columns of the arguments' types; ``takes`` names the arguments."""

    takes: dict[str, str]
    gives: str
    doc: str
    make: Callable[..., Column]
    #: The function looks something up in tables that the session makes.
    needs_session: bool = False

    def column(self, spark: SparkSession, *args: Column) -> Column:
        return self.make(spark, *args) if self.needs_session else self.make(*args)


FUNCTIONS: dict[str, Function] = {
    "norm_name": Function({"v": "STRING"}, "STRING", "White space collapsed; null if nothing is left.", text.normalize_name),
    "norm_email": Function({"v": "STRING"}, "STRING", "Stripped and lower-cased if it has the shape of an address, else null.", text.normalize_email),
    "norm_emails": Function({"v": LIST}, LIST, "The addresses of a list, each once.", text.normalize_emails),
    "norm_phone": Function({"v": "STRING"}, "STRING", "A number with a plus sign in E.164 form, else null.", phones.normalize_phone),
    "norm_phones": Function({"v": LIST}, LIST, "The numbers of a list, each once.", phones.normalize_phones),
    "country_code": Function({"v": "STRING"}, "STRING", "A country name or code as alpha-2, else null.", geo.country_alpha2, needs_session=True),
    "norm_location": Function({"v": "STRING"}, PLACE, "City, region and country of a text with commas.", geo.location_of_text, needs_session=True),
    "norm_date": Function({"v": "STRING"}, "STRING", "A date as YYYY-MM; null for ongoing markers and what can't be read.", dates.normalize_date),
    "year_of_date": Function({"v": "STRING"}, "INT", "The year of a date.", dates.year_from_date),
    "skill_key": Function({"v": "STRING"}, "STRING", "What spellings of a skill have in common.", text.normalize_skill),
    "norm_degree": Function({"v": "STRING"}, "STRING", "Lower-case letters and digits alone.", text.normalize_degree),
    "norm_title": Function({"v": "STRING"}, "STRING", "Lower case, white space collapsed.", text.normalize_title),
    "link_kind": Function({"url": "STRING", "anchor": "STRING"}, "STRING", "contact, linkedin, profile, portfolio or other.", resume.link_kind),
    "headline_of": Function({"v": LIST}, "STRING", "An introduction's first sentence.", resume.headline),
    "skills_of_lines": Function({"v": LIST}, LIST, "Skills of labelled lines.", resume.skill_tokens),
}

#: A quoted text or name, or a name before a bracket that SQL only takes in back quotes.
_CALL = re.compile(r"'(?:[^'\\]|\\.|'')*'|`[^`]*`|((?:[!=<>+*/%|&^~-]+|\b(?:and|or|not|in|case|when|then|else|end)\b))(?=\()")


def as_sql(c: Column) -> str:
    """A column's expression as SQL text; operators are called by their functions' names."""
    return _CALL.sub(lambda m: f"`{m.group(1)}`" if m.group(1) else m.group(), c._jc.node().sql())


def register(spark: SparkSession, prefix: str = "", names: list[str] | None = None) -> list[str]:
    """Makes the functions (all, or those named) callable in the session's SQL under ``prefix`` and their names; gives the names."""
    made = []
    for name in names or FUNCTIONS:
        f = FUNCTIONS[name]
        body = as_sql(f.column(spark, *[F.col(a) for a in f.takes]))
        takes = ", ".join(f"{a} {t}" for a, t in f.takes.items())
        doc = f.doc.replace("'", "\\'")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({takes}) RETURNS {f.gives} COMMENT '{doc}' RETURN {body}")
        made.append(prefix + name)
    return made


def listing(spark: SparkSession) -> DataFrame:
    """(name, takes, gives, doc) of the functions."""
    rows = [(n, ", ".join(f"{a} {t}" for a, t in f.takes.items()), f.gives, f.doc) for n, f in FUNCTIONS.items()]
    return spark.createDataFrame(rows, "name string, takes string, gives string, doc string")
