"""Fusion of an identity's records into one profile.

Records become one relation of entries, of all fields alike. Equal values of a candidate
are folded first (the smallest of composite keys wins a slot), then a candidate's values are
collected in the order of their first record: two exchanges in all, and no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.dates import year_of
from ..functions.text import alnum, normalize_degree, normalize_title, present, size_of, strip

#: What each field counts for in the overall confidence.
WEIGHTS = {
    "full_name": 0.20,
    "emails": 0.15,
    "phones": 0.15,
    "location": 0.10,
    "skills": 0.20,
    "experience": 0.10,
    "education": 0.05,
    "other_fields": 0.05,
}
#: Confidence without any agreement, and of entries that disagree on a year.
NO_AGREEMENT, MISMATCH = 0.7, 0.6
ORDER = ("source", "rid")
#: A record's time, so that the later one is the smaller text; worked out once for a record.
LATER = "_later"
#: Kinds of which a candidate has one value.
SINGLE = ("full_name", "headline", "linkedin", "github", "portfolio", "location", "years")


def descending(c: Column) -> Column:
    """A string whose ascending order is c's descending one (null is the smallest of c)."""
    return F.concat(F.translate(F.hex(F.coalesce(c, F.lit(""))), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def agreement(n: Column, distinct: Column) -> Column:
    """The share of repeats among n values; 1 for none given, a fixed value where all differ."""
    return F.when(n == 0, 1.0).when(distinct < n, (n - distinct) / n).otherwise(NO_AGREEMENT)


def leaves(location: Column) -> Column:
    return sum((F.when(present(location[k]), 1).otherwise(0) for k in ("city", "region", "country")), F.lit(0))


def list_text(values: Column) -> Column:
    """An array of strings as the text that orders it: quoted, comma-separated, in brackets."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", "), F.lit("]"))


class _Entries:
    """Builds the entries of records: (kind, k1, k2, pos, w1, w2, w3, flag, y, said), all of one type.

    Entries of a candidate that agree in kind, k1 and k2 are one value. pos is the place in
    a list of the record; w1 to w3 hold a key and what the smallest key wins; y is a year,
    of which the least and the greatest count; said is collected in the order of records.
    """

    def __init__(self, members: DataFrame):
        rid = members.schema["rid"].dataType.simpleString()
        key = f"struct<at:string,num:double,text:string,source:string,rid:{rid},pos:int>"
        place = "struct<city:string,region:string,country:string>"
        self.types = {
            "k1": "string", "k2": "string", "pos": "int", "w1": f"struct<key:{key},v:struct<value:string,number:double,place:{place},source:string,method:string>>", "w2": f"struct<key:{key},v:string>",
            "w3": f"struct<key:{key},v:string,list:array<string>,year:int>", "flag": "boolean", "y": "int", "said": "array<string>",
        }
        self.none = F.array().cast("array<struct<kind:string," + ",".join(f"{k}:{v}" for k, v in self.types.items()) + ">>")

    def one(self, kind: str, **given: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), *[given.get(k, F.lit(None)).cast(t).alias(k) for k, t in self.types.items()])

    def each(self, kind: str, values: Column, make) -> Column:
        """An entry for each element of a list."""
        return F.coalesce(F.transform(values, lambda x, i: self.one(kind, pos=i, **make(x, i))), self.none)

    @staticmethod
    def key(at: Column | None = None, num: Column | None = None, text: Column | None = None, pos: Column | None = None) -> Column:
        kinds = ((at, "at", "string"), (num, "num", "double"), (text, "text", "string"))
        return F.struct(*[(F.lit(None) if c is None else c).cast(t).alias(n) for c, n, t in kinds], *ORDER, (F.lit(None) if pos is None else pos).cast("int").alias("pos"))

    def best(self, value: Column, kind: str = "string", text: Column | None = None, pos: Column | None = None) -> Column:
        """The key whose smallest is the better value: later, then larger, then first by its text, then first in record order."""
        return self.key(F.col(LATER), -size_of(value, kind), value.cast("string") if text is None else text, pos)

    def won(self, given: Column, key: Column, value: Column | None = None, number: Column | None = None, place: Column | None = None) -> Column:
        no = F.lit(None)
        v = F.struct(*[(no if c is None else c).cast(t).alias(n) for c, n, t in ((value, "value", "string"), (number, "number", "double"), (place, "place", "struct<city:string,region:string,country:string>"))], "source", "method")
        return F.when(given, F.struct(key.alias("key"), v.alias("v")))

    def scalars(self, only: Sequence[str] | None = None) -> Column:
        """The record itself and its single values, of the kinds named alone, if any are."""
        name, loc, years = F.col("full_name"), F.col("location"), F.col("years_experience")
        plain = {"headline": F.col("headline"), **{k: F.col("links")[k] for k in ("linkedin", "github", "portfolio")}}
        n_leaves = leaves(loc)
        found = {
            "full_name": self.one("full_name", k1=alnum(name), w1=self.won(present(name), self.best(name), name)),
            **{k: self.one(k, w1=self.won(present(v), self.best(v), v)) for k, v in plain.items()},
            "location": self.one("location", w1=self.won(n_leaves > 0, self.key(F.col(LATER), -n_leaves), place=F.struct(*[loc[k].alias(k) for k in ("city", "region", "country")]))),
            "years": self.one("years", w1=self.won(years.isNotNull(), self.key(num=-years), number=years)),
        }
        given = [x for k, x in found.items() if only is None or k in only]
        return F.concat(F.array(self.one("record")), F.filter(F.array(*given), lambda x: x["w1"].isNotNull())) if given else F.array(self.one("record"))

    def values(self, kind: str, values: Column) -> Column:
        return F.filter(self.each(kind, values, lambda v, i: {"k1": v}), lambda x: present(x["k1"]))

    def skills(self) -> Column:
        return self.each("skills", F.col("skills"), lambda x, i: {"k1": x["name"], "said": F.coalesce(x["sources"], F.array().cast("array<string>"))})

    def experience(self) -> Column:
        def make(x: Column, i: Column) -> dict[str, Column]:
            start, end, summary = x["start"], x["end"], x["summary"]
            longest = self.key(num=-F.length(summary), pos=i)
            return {
                "k1": x["company"], "k2": x["title"], "flag": ~present(end), "y": year_of(start), "w1": self.won(present(start), self.key(text=start), start),
                "w2": F.when(present(end), F.struct(self.key(text=descending(end)).alias("key"), end.alias("v"))), "w3": self.third(present(summary), longest, summary),
            }

        return self.each("experience", F.col("experience"), make)

    @staticmethod
    def third(given: Column, key: Column, value: Column | None = None, values: Column | None = None, year: Column | None = None) -> Column:
        no = F.lit(None)
        return F.when(given, F.struct(key.alias("key"), *[(no if c is None else c).cast(t).alias(n) for c, n, t in ((value, "v", "string"), (values, "list", "array<string>"), (year, "year", "int"))]))

    def education(self) -> Column:
        def make(x: Column, i: Column) -> dict[str, Column]:
            degree, field, year = x["degree"], x["field"], x["end_year"]
            return {
                "k1": x["institution"], "k2": normalize_degree(degree), "y": year, "w1": self.won(present(degree), self.key(num=-F.length(degree), pos=i), degree),
                "w2": F.when(present(field), F.struct(self.key(num=-F.length(field), pos=i).alias("key"), field.alias("v"))), "w3": self.third(year.isNotNull(), self.key(F.col(LATER), pos=i), year=year),
            }

        return self.each("education", F.col("education"), make)

    def projects(self) -> Column:
        def make(x: Column, i: Column) -> dict[str, Column]:
            title, said, tools = x["title"], x["description"], x["tech_stack"]
            return {
                "k1": normalize_title(title), "w1": self.won(F.lit(True), self.key(pos=i), title), "w2": F.when(present(said), F.struct(self.best(said, pos=i).alias("key"), said.alias("v"))),
                "w3": self.third(present(tools, "array"), self.best(tools, "array", list_text(tools), i), values=tools),
            }

        return self.each("projects", F.col("projects"), make)


def _folded(members: DataFrame, *entries: Column) -> DataFrame:
    """(candidate_id, ...): what each candidate has of each kind: winners, counts, and lists of values in the order first met.

    Every field is in one relation of entries. Equal values of a candidate are folded within
    tasks, then across them, so what is sent for a candidate of many records is its distinct
    values; a second exchange brings these together, each kind apart. Columns that nothing
    reads are pruned with the work for them.
    """
    if "procured_at" in members.columns:
        members = members.withColumn(LATER, descending(F.col("procured_at")))
    # An inner explode would have the planner test the list's size first, and so work all entries out a second time.
    each = members.select("candidate_id", *ORDER, F.explode_outer(F.concat(*entries)).alias("x")).where("x is not null").select("candidate_id", *ORDER, "x.*")
    said = F.collect_list(F.when(F.col("said").isNotNull(), F.struct(*ORDER, "pos", "said")))
    values = each.groupBy("candidate_id", "kind", "k1", "k2").agg(
        F.min(F.struct(*ORDER, "pos")).alias("first"), F.count(F.lit(1)).alias("n"), *[F.min(w).alias(w) for w in ("w1", "w2", "w3")], F.bool_or("flag").alias("flag"),
        F.min("y").alias("least"), F.max("y").alias("most"), F.flatten(F.transform(F.sort_array(said), lambda v: v["said"])).alias("said"),
    )
    return values.groupBy("candidate_id").agg(
        *[F.min(_if("record", c)).alias(f"record_{c}") for c in ("n", "first")], F.sum(_if("full_name", "n")).alias("names"), F.count(_if("full_name", "n")).alias("distinct_names"),
        *[F.min(_if(k, "w1")).alias(k) for k in SINGLE], *[F.sort_array(F.collect_list(_if(k, F.struct(*[F.col("first")[c].alias(c) for c in (*ORDER, "pos")], "k1", "k2", *told)))).alias(k) for k, told in _listed().items()],
    )


def _if(kind: str, value: Column | str) -> Column:
    return F.when(F.col("kind") == kind, F.col(value) if isinstance(value, str) else value)


def _listed() -> dict[str, list[Column]]:
    """What is told of each value of a list, beside its place and keys."""
    n, said, disagree = F.col("n"), F.col("said"), F.when(F.col("least") != F.col("most"), MISMATCH).otherwise(1.0).alias("score")
    first, second, third = F.col("w1.v.value"), F.col("w2.v"), F.col("w3")
    job = F.struct(F.col("k1").alias("company"), F.col("k2").alias("title"), first.alias("start"), F.when(~F.col("flag"), second).alias("end"), third["v"].alias("summary"))
    school = F.struct(F.col("k1").alias("institution"), first.alias("degree"), second.alias("field"), third["year"].alias("end_year"))
    project = F.struct(first.alias("title"), second.alias("description"), F.coalesce(third["list"], F.array().cast("array<string>")).alias("tech_stack"))
    return {
        **{k: [n] for k in ("emails", "phones", "links_other", "any")}, "skills": [said], "experience": [job.alias("x"), disagree], "education": [school.alias("x"), disagree], "projects": [project.alias("x")],
    }


def _sum(values: Column, get) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + get(x))


def _mean(scores: Column) -> Column:
    """The mean as a sum from the left, so that it doesn't depend on the plan; null for none."""
    return F.when(F.size(scores) > 0, F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores))


def _scalar_columns() -> dict[str, Column]:
    def won(kind: str, value: str = "value") -> Column:
        v = F.col(kind)["v"]
        return F.when(v.isNotNull(), F.struct(v[value].alias("value"), v["source"].alias("source"), v["method"].alias("method")))

    place = won("location", "place")
    return {
        "n": F.col("record_n"), "first_record": F.struct(*[F.col("record_first")[c].alias(c) for c in ORDER]), "full_name": won("full_name"), **{k: won(k) for k in ("headline", "linkedin", "github", "portfolio")},
        "location": place, "years": won("years", "number"), "name_score": agreement(F.coalesce("names", F.lit(0)), F.col("distinct_names")),
        "location_score": F.coalesce(leaves(place["value"]) / 3.0, F.lit(0.0)),
    }


def _union_columns(kind: str, normal=alnum, into: str | None = None) -> dict[str, Column]:
    values, into = F.transform(kind, lambda x: x["k1"]), into or kind
    return {into: values, f"{into}_score": agreement(_sum(F.col(kind), lambda x: x["n"]), F.size(F.array_distinct(F.transform(values, normal))))}


def _skill_columns() -> dict[str, Column]:
    rate = lambda x: F.size(x["said"]) / F.col("record_n")
    return {"skills": F.transform("skills", lambda x: F.struct(x["k1"].alias("name"), x["said"].alias("sources"), rate(x).alias("confidence"))), "skills_score": _mean(F.transform("skills", rate))}


def _entry_columns(kind: str) -> dict[str, Column]:
    return {kind: F.transform(kind, lambda x: x["x"]), f"{kind}_score": _mean(F.transform(kind, lambda x: x["score"]))}


def _project_columns() -> dict[str, Column]:
    return {"projects": F.transform("projects", lambda x: x["x"])}


def _told(found: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return found.select("candidate_id", *[c.alias(n) for n, c in columns.items()])


def scalars(members: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """One row for each candidate: the number of records, the first one, winners of single values, and their confidences.

    ``only`` names the values to work out (all, if it isn't given); the others are null, and their fields aren't read.
    """
    return _told(_folded(members, _Entries(members).scalars(only)), _scalar_columns())


def union(members: DataFrame, values: Column, into: str, normal=alnum) -> DataFrame:
    """(candidate_id, into, into_score): distinct values in the order first met, and their agreement over all mentions."""
    return _told(_folded(members, _Entries(members).values("any", values)), _union_columns("any", normal, into))


def skills(members: DataFrame) -> DataFrame:
    """Skills by name, with the sources of all mentions in record order; confidence: sources over records."""
    e = _Entries(members)
    return _told(_folded(members, F.array(e.one("record")), e.skills()), _skill_columns()).where(F.size("skills") > 0)


def experience(members: DataFrame) -> DataFrame:
    """Positions by company and title: earliest start; no end if one mention has none, else the latest; longest summary."""
    return _told(_folded(members, _Entries(members).experience()), _entry_columns("experience"))


def education(members: DataFrame) -> DataFrame:
    """Schools by institution and degree (letters and digits alone): longest degree and field, the end year of the latest record."""
    return _told(_folded(members, _Entries(members).education()), _entry_columns("education"))


def projects(members: DataFrame) -> DataFrame:
    """Projects by title (case and spacing aside): first title, best description and best tools."""
    return _told(_folded(members, _Entries(members).projects()), _project_columns())


def overall_confidence() -> Column:
    """The weighted sum of the fields' scores, from the left, to six places."""
    scores = ("name_score", "emails_score", "phones_score", "location_score", "skills_score", "experience_score", "education_score")
    parts = [F.lit(w) * F.coalesce(F.col(s), F.lit(1.0)) for w, s in zip(WEIGHTS.values(), scores, strict=False)]
    return F.round(reduce(lambda a, b: a + b, parts) + F.lit(WEIGHTS["other_fields"]), 6)


def provenance() -> Column:
    """One entry for each field, in a fixed order; values as JSON."""

    def json(c: Column) -> Column:
        """JSON text of any value: wrapped for to_json, then unwrapped; null stays null."""
        whole = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
        return F.when(c.isNotNull(), F.substr(whole, F.lit(6), F.length(whole) - 6))

    def entry(field: str, value: Column, source: Column, method: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), json(value).alias("value"), source.alias("source"), method.alias("method"))

    def won(field: str, c: str, value: Column | None = None) -> Column:
        return entry(field, F.col(f"{c}.value") if value is None else value, F.col(f"{c}.source"), F.col(f"{c}.method"))

    def united(field: str, value: Column) -> Column:
        return entry(field, value, F.lit("multiple"), F.lit("union"))

    return F.array(
        won("full_name", "full_name"), united("emails", F.col("emails")), united("phones", F.col("phones")), won("location", "location", whole_location()), won("headline", "headline"), won("years_experience", "years"),
        won("links.linkedin", "linkedin"), won("links.github", "github"), won("links.portfolio", "portfolio"), united("links.other", F.col("links_other")),
        united("experience", F.col("experience")), united("education", F.col("education")), united("projects", F.col("projects")), united("skills", F.transform("skills", lambda s: s["name"])),
    )


def whole_location() -> Column:
    return F.struct(*[F.col(f"location.value.{k}").alias(k) for k in ("city", "region", "country")])


def with_candidates(records: DataFrame, members: DataFrame, key: str = "rid") -> DataFrame:
    """Records with their candidate_id, and ``rid`` as the tie-breaker of record order."""
    own = records if key == "rid" else records.withColumn("rid", F.col(key))
    return own.join(members, key)


#: The single values and lists that a profile's fields are made of, and the records' field of each.
SCORED = ("full_name", "emails", "phones", "location", "skills", "experience", "education")
FIELD_OF = {
    "full_name": "full_name", "headline": "headline", "linkedin": "links", "github": "links", "portfolio": "links", "location": "location", "years": "years_experience",
    "emails": "emails", "phones": "phones", "links_other": "links", "skills": "skills", "experience": "experience", "education": "education", "projects": "projects",
}
MADE_OF = {
    "candidate_id": (), "total_source_points": (), "years_experience": ("years",), "links": ("linkedin", "github", "portfolio", "links_other"), "overall_confidence": SCORED, "provenance": tuple(FIELD_OF),
    **{f: (f,) for f in ("full_name", "emails", "phones", "location", "headline", "skills", "experience", "education", "projects")},
}


def fields_read(fields: Sequence[str]) -> list[str]:
    """The records' fields that these fields of a profile come from, beside those of the record itself."""
    return list(dict.fromkeys(["source", "method", "procured_at", *(FIELD_OF[k] for f in fields for k in MADE_OF[f])]))


def fuse(members: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Profiles (see ``schema.PROFILE``) of records with candidate_id, rid and the record contract's columns.

    Arrays that are null count as empty. A candidate's order of records is by source, then rid.
    ``fields`` names the profile's fields to work out (all, if it isn't given), in the profile's order;
    only what these are made of is read and sent.
    """
    fields = [f for f in schema.PROFILE.names if fields is None or f in fields]
    kinds = {k for f in fields for k in MADE_OF[f]}
    e = _Entries(members)
    lists = {
        "emails": lambda: e.values("emails", F.col("emails")), "phones": lambda: e.values("phones", F.col("phones")), "links_other": lambda: e.values("links_other", F.col("links.other")),
        "skills": e.skills, "experience": e.experience, "education": e.education, "projects": e.projects,
    }
    columns = _scalar_columns() | _union_columns("emails") | _union_columns("phones", strip) | _union_columns("links_other") | _skill_columns() | _entry_columns("experience") | _entry_columns("education") | _project_columns()
    whole = _told(_folded(members, e.scalars(kinds), *[make() for k, make in lists.items() if k in kinds]), columns)
    links = F.struct(F.col("linkedin.value").alias("linkedin"), F.col("github.value").alias("github"), F.col("portfolio.value").alias("portfolio"), F.col("links_other").alias("other"))
    made = {
        "full_name": F.col("full_name.value"), "location": whole_location(), "links": links, "headline": F.col("headline.value"), "years_experience": F.col("years.value"),
        "total_source_points": F.col("n").cast("int"), "overall_confidence": overall_confidence(), "provenance": provenance(),
    }
    return whole.select(*[made.get(f, F.col(f)).alias(f) for f in fields])
