"""Reading of resumes: contacts, links, skills, education and projects from extracted text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .geo import country_alpha2
from .phones import normalize_phones
from .text import WS, collapse, filled, let, normalize_emails, strip, strip_chars

WORD = r"\p{L}\p{N}_"
#: Fixed patterns: an address and a telephone number in running text.
EMAIL_IN_TEXT = rf"([{WORD}.+-]+@[{WORD}-]+\.[{WORD}.-]+)"
PHONE_IN_TEXT = rf"(\+\p{{Nd}}(?:\p{{Nd}}|{WS}|-){{6,}}\p{{Nd}})"
#: Fixed pattern: the same of ASCII digits and white space alone.
ASCII_PHONE_IN_TEXT = r"(\+[0-9][0-9\t\n\f\r -]{6,}[0-9])"
#: Fixed pattern: month and year, a dash, month and year or an ongoing word.
DATE_RANGE = rf"(?iu)[A-Za-z]{{3,9}}\.?{WS}*\p{{Nd}}{{4}}{WS}*[-–—]{WS}*(?:[A-Za-z]{{3,9}}\.?{WS}*\p{{Nd}}{{4}}|present|current|ongoing)"
#: Where a project's title ends.
TITLE_END = r"§|\bGit repo\b|\bGithub\b|\bGit\b"
NO_STRINGS = "array<string>"


def _none() -> Column:
    return F.array().cast(NO_STRINGS)


def section(sections: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(sections, F.lit(name)), _none())


def extract_emails(raw: Column, links: Column) -> Column:
    """Addresses of mailto links, then those in the text; normalized, each once."""
    mail = F.transform(F.filter(links, lambda x: F.lower(x["url"]).startswith("mailto:")), lambda x: F.substr(x["url"], F.lit(8)))
    in_text = F.regexp_extract_all(F.coalesce(raw, F.lit("")), F.lit(EMAIL_IN_TEXT), 1)
    return normalize_emails(F.concat(F.coalesce(mail, _none()), in_text))


def extract_phones(raw: Column) -> Column:
    return normalize_phones(F.regexp_extract_all(F.coalesce(raw, F.lit("")), F.lit(PHONE_IN_TEXT), 1))


def dialled_numbers(raw: Column) -> Column:
    """Telephone numbers as they stand in the text, as ``+`` and digits, each once; whether a country has such numbers isn't asked."""
    found = F.regexp_extract_all(F.coalesce(raw, F.lit("")), F.lit(ASCII_PHONE_IN_TEXT), 1)
    return F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, "[^+0-9]", "")))


def link_kind(url: Column, anchor: Column) -> Column:
    """contact, linkedin, profile (a github address of one path segment), portfolio or other."""
    low = F.lower(url)
    tail = F.regexp_replace(F.regexp_extract(low, r"github\.com/(.*)", 1), "^/+|/+\\z", "")
    profile = low.contains("github.com/") & (tail != "") & ~tail.contains("/")
    return (
        F.when(low.startswith("mailto:") | low.startswith("tel:"), "contact")
        .when(low.contains("linkedin.com"), "linkedin")
        .when(low.contains("github.com"), F.when(profile, "profile").otherwise("other"))
        .when(F.lower(F.coalesce(anchor, F.lit(""))).contains("portfo"), "portfolio")
        .otherwise("other")
    )


def classify_links(links: Column) -> Column:
    """linkedin, github and portfolio are the first of their kind; further profiles join the others, each once; further linkedin and portfolio links are dropped."""
    kinds = F.transform(F.coalesce(links, F.array().cast("array<struct<url:string,anchor:string>>")), lambda x, i: F.struct(x["url"].alias("url"), link_kind(x["url"], x["anchor"]).alias("kind"), i.alias("at")))

    def first(a: Column, kind: str) -> Column:
        return F.get(F.filter(a, lambda x: x["kind"] == kind), F.lit(0))

    def whole(a: Column) -> Column:
        profile = first(a, "profile")["at"]
        others = F.filter(a, lambda x: (x["kind"] == "other") | ((x["kind"] == "profile") & (x["at"] != profile)))
        return F.struct(
            first(a, "linkedin")["url"].alias("linkedin"),
            first(a, "profile")["url"].alias("github"),
            first(a, "portfolio")["url"].alias("portfolio"),
            F.array_distinct(F.transform(others, lambda x: x["url"])).alias("other"),
        )

    return F.transform(F.array(kinds), whole)[0]


def headline(lines: Column) -> Column:
    """The introduction's first sentence."""
    first = strip(F.substring_index(strip(F.array_join(lines, " ")), ".", 1))
    return F.when(first != "", F.concat(first, F.lit(".")))


def skill_tokens(lines: Column) -> Column:
    """Skills of labelled lines: what follows the colon, without ratings, split at commas and ampersands."""

    def of_line(line: Column) -> Column:
        s = strip(F.regexp_replace(line, "^•+", ""))
        s = F.when(s.contains(":"), F.regexp_replace(s, "(?s)^[^:]*:", "")).otherwise(s)
        parts = F.split(F.regexp_replace(s, r"\([^)]*\)", ""), "[,&]")
        return F.filter(F.transform(parts, lambda p: strip_chars(p, " .")), lambda p: p != "")

    return F.flatten(F.transform(lines, of_line))


def dedup_phrase(c: Column) -> Column:
    """A phrase said twice, said once; all else unchanged."""

    def of_words(w: Column) -> Column:
        half = F.floor(F.size(w) / 2).cast("int")
        low = F.transform(w, F.lower)
        twice = (F.size(w) > 1) & (F.size(w) % 2 == 0) & (F.slice(low, F.lit(1), half) == F.slice(low, half + 1, half))
        return F.when(twice, F.array_join(F.slice(w, F.lit(1), half), " "))

    words = F.filter(F.split(collapse(c), " "), lambda w: w != "")
    return F.coalesce(F.transform(F.array(words), of_words)[0], c)


def education(spark: SparkSession, lines: Column) -> Column:
    """(location, education): the first line is the institution, perhaps with city and country; the second degree, field and years."""
    one, two = F.get(lines, F.lit(0)), F.get(lines, F.lit(1))
    parts = F.transform(F.split(one, ","), strip)
    country = F.when(F.size(parts) >= 2, country_alpha2(spark, F.try_element_at(parts, F.lit(-1))))
    city = F.when(country.isNotNull() & (F.size(parts) >= 3), dedup_phrase(F.try_element_at(parts, F.lit(-2))))
    institution = filled(F.when(country.isNotNull(), F.get(parts, F.lit(0))).otherwise(one))
    year = F.array_max(F.transform(F.regexp_extract_all(two, F.lit(r"(\p{Nd}{4})"), 1), lambda y: y.try_cast("int")))
    core = F.regexp_replace(F.regexp_replace(F.regexp_replace(two, r"\([^)]*\)", ""), r"\p{Nd}{4}", ""), "[–—-]", "")
    core = collapse(core)
    at = F.instr(core, " in ")
    degree = filled(F.when(at > 0, strip(F.substr(core, F.lit(1), at - 1))).otherwise(core))
    field = filled(F.when(at > 0, strip_chars(F.substr(core, at + 4), " .")))
    entry = F.struct(institution.alias("institution"), degree.alias("degree"), field.alias("field"), year.alias("end_year"))
    entries = F.when(F.size(lines) > 0, F.array(entry)).otherwise(F.array().cast("array<struct<institution:string,degree:string,field:string,end_year:int>>"))
    location = F.struct(city.alias("city"), F.lit(None).cast("string").alias("region"), country.alias("country"))
    return F.struct(location.alias("location"), entries.alias("education"))


def projects(lines: Column) -> Column:
    """A line with a date range opens a project; later lines are its description or, after ``Tech Stack:``, its tools (the last such line counts)."""

    def title(line: Column) -> Column:
        before = F.get(F.split(line, DATE_RANGE, 2), F.lit(0))
        return let(strip_chars(F.get(F.split(before, TITLE_END, 2), F.lit(0)), " :–\\-•"), filled)

    def entry(h: Column, following: Column) -> Column:
        return let(F.transform(following, lambda x: strip(F.regexp_replace(x, "^•+", ""))), lambda own: of_lines(h, own))

    def of_lines(h: Column, own: Column) -> Column:
        tech = F.filter(own, lambda x: x.rlike(rf"(?i)^tech{WS}*stack{WS}*:"))
        text = F.filter(own, lambda x: ~x.rlike(rf"(?i)^tech{WS}*stack{WS}*:.*") & (x != ""))
        tools = F.split(F.regexp_replace(F.try_element_at(tech, F.lit(-1)), rf"(?i)^tech{WS}*stack{WS}*:", ""), ",")
        tools = F.filter(F.transform(tools, lambda x: strip_chars(x, " .")), lambda x: x != "")
        return F.struct(title(h).alias("title"), let(F.array_join(text, " "), filled).alias("description"), F.coalesce(tools, _none()).alias("tech_stack"))

    def of(a: Column) -> Column:
        heads = F.filter(F.transform(a, lambda x, i: F.when(x.rlike(DATE_RANGE), i)), lambda i: i.isNotNull())

        def each(hs: Column) -> Column:
            def one(h: Column, k: Column) -> Column:
                end = F.coalesce(F.get(hs, k + 1), F.size(a))
                return entry(F.get(a, h), F.slice(a, h + 2, end - h - 1))

            return F.transform(hs, one)

        return F.transform(F.array(heads), each)[0]

    return F.transform(F.array(lines), of)[0]


# --- lines and sections from positioned text


def is_heading(line: Column) -> Column:
    """Short, with two ASCII letters at least, six in ten of them upper case."""
    letters, upper = F.length(F.regexp_replace(line, "[^A-Za-z]", "")), F.length(F.regexp_replace(line, "[^A-Z]", ""))
    return (letters >= 2) & (F.length(line) <= 45) & (upper >= 0.6 * letters)


def heading_key(line: Column) -> Column:
    return F.regexp_replace(F.upper(line), "[^A-Z0-9]", "")


def plain_heading_key(line: Column) -> Column:
    """``heading_key`` where letters are upper-cased one for one, as in SQL: sharp s and ligatures, which have no single ASCII capital, go."""
    return F.upper(F.regexp_replace(line, "[^A-Za-z0-9ıſ]", ""))


def segment_sections(lines: Column, key_of: Callable[[Column], Column] = heading_key) -> Column:
    """Lines by the heading above them (``HEADER`` before the first, always there); a repeated heading's lines are appended.

    Each section is a slice between two headings, so lines are read once.
    """

    def of(a: Column) -> Column:
        heads = F.filter(F.transform(a, lambda x, i: F.when(is_heading(x), i)), lambda i: i.isNotNull())

        def cut(hs: Column) -> Column:
            def piece(h: Column, k: Column) -> Column:
                below = F.coalesce(F.get(hs, k), F.size(a))
                key = F.when(h < 0, "HEADER").otherwise(key_of(F.get(a, h)))
                return F.struct(key.alias("key"), F.slice(a, h + 2, below - h - 1).alias("lines"))

            return F.transform(F.concat(F.array(F.lit(-1)), hs), piece)

        def as_map(pieces: Column) -> Column:
            keys = F.array_distinct(F.transform(pieces, lambda p: p["key"]))
            own = lambda k: F.flatten(F.transform(F.filter(pieces, lambda p: p["key"] == k), lambda p: p["lines"]))
            return F.map_from_arrays(keys, F.transform(keys, own))

        return F.transform(F.transform(F.array(heads), cut), as_map)[0]

    return F.transform(F.array(F.coalesce(lines, _none())), of)[0]
