"""Countries and locations."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import clean, strip

#: Names that neither the platform's table nor the rules below give; a parameter of ``countries``.
ALIASES = {
    "united states of america": "US", "iran": "IR",
    "korea, republic of": "KR", "republic of korea": "KR", "korea, democratic people's republic of": "KP", "democratic people's republic of korea": "KP", "russian federation": "RU", "viet nam": "VN", "czech republic": "CZ", "turkey": "TR",
    "congo": "CG", "republic of the congo": "CG", "congo, the democratic republic of the": "CD", "democratic republic of the congo": "CD", "taiwan, province of china": "TW", "republic of china": "TW", "palestine, state of": "PS", "state of palestine": "PS", "syrian arab republic": "SY",
    "lao people's democratic republic": "LA", "brunei darussalam": "BN", "french republic": "FR", "hellenic republic": "GR", "swiss confederation": "CH", "slovak republic": "SK", "united kingdom of great britain and northern ireland": "GB",
    "argentine republic": "AR", "italian republic": "IT", "portuguese republic": "PT", "holy see (vatican city state)": "VA", "côte d'ivoire": "CI", "myanmar": "MM",
}
#: A formal name is a title of these words, "of" and a name; in lists the title may follow the name.
TITLE = r"(?:(?:ARAB|BOLIVARIAN|CO-OPERATIVE|COMMONWEALTH|DEMOCRATIC|DUCHY|EASTERN|FEDERAL|FEDERATED|FEDERATIVE|GRAND|HASHEMITE|INDEPENDENT|ISLAMIC|KINGDOM|PEOPLE'S|PLURINATIONAL|PRINCIPALITY|REPUBLIC|SOCIALIST|STATE|STATES|SULTANATE|UNION|UNITED|UNITARY) ?)+"


@cache
def _table(spark: SparkSession) -> dict[str, str]:
    """Upper-case key to alpha-2 code: ``2:`` for alpha-2, ``3:`` for alpha-3, ``n:`` for names; from the Java platform's ISO-3166 data."""
    locale, found = spark.sparkContext._jvm.java.util.Locale, {}
    for code in locale.getISOCountries():
        own = locale("", code)
        found |= {f"2:{code}": code, f"3:{own.getISO3Country()}": code, f"n:{own.getDisplayCountry(locale.ENGLISH).upper()}": code}
    return found


def countries(spark: SparkSession, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """(key, alpha2): about 750 rows, a bound that data can't move."""
    table = _table(spark) | {f"n:{k.upper()}": v for k, v in aliases.items()}
    return spark.createDataFrame(sorted(table.items()), "key string, alpha2 string")


def country_alpha2(spark: SparkSession, c: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """A country's alpha-2 code: two letters are looked up as alpha-2 alone; three as alpha-3, then as a name; all else as a name, at last without its formal title. A miss is null.

    The table is a map literal, so that the lookup is a projection.
    """
    table = _table(spark) | {f"n:{k.upper()}": v for k, v in aliases.items()}
    kinds = {k: F.create_map(*[F.lit(x) for key, v in sorted(table.items()) if key.startswith(k) for x in (key[2:], v)]) for k in ("2:", "3:", "n:")}
    s = F.upper(strip(c))
    get = lambda kind: F.try_element_at(kinds[kind], s)
    letters = lambda n: s.rlike(f"^\\p{{L}}{{{n}}}\\z")
    plain = F.regexp_replace(F.regexp_replace(s, rf"^(?:THE )?{TITLE} OF (?:THE )?", ""), rf", (?:THE )?{TITLE} OF\z", "")
    named = F.coalesce(get("n:"), F.try_element_at(kinds["n:"], F.regexp_replace(plain, "^THE ", "")))
    return F.when(letters(2), get("2:")).when(letters(3), F.coalesce(get("3:"), get("n:"))).otherwise(named)


def location_of_parts(spark: SparkSession, parts: Column) -> Column:
    """A location of city, region and country, by place; further parts are ignored."""
    at = lambda k: F.get(parts, F.lit(k))
    return F.struct(clean(at(0)).alias("city"), clean(at(1)).alias("region"), country_alpha2(spark, at(2)).alias("country"))


def location_of_text(spark: SparkSession, c: Column) -> Column:
    return location_of_parts(spark, F.coalesce(F.split(c, ","), F.array().cast("array<string>")))


def location_of_fields(spark: SparkSession, city: Column, region: Column, state: Column, country: Column) -> Column:
    """From named fields; the state stands in for an absent region."""
    return F.struct(clean(city).alias("city"), clean(F.coalesce(F.when(region != "", region), state)).alias("region"), country_alpha2(spark, country).alias("country"))
