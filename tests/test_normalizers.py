import pytest
from pyspark.sql import functions as F

from confluo.functions import dates, geo, phones, text


def values(spark, f, inputs, kind="string"):
    rows = spark.createDataFrame(list(enumerate(inputs)), f"n int, v {kind}")
    return [r[0] for r in rows.orderBy("n").select(f(F.col("v"))).collect()]


#: One input for each rule: day, month and year in each order and with either sign, names of months, ongoing dates, what is no date.
DATED = {
    "07-11-2019": "2019-11", "2020-06-30": "2020-06", "28-2018-10": "2018-10", "11/2017": "2017-11", "2016/08": "2016-08", "Apr 2015": "2015-04", "September 2014": "2014-09", "2013 Dec": "2013-12", "77-05-2012": "2012-05",
    "PRESENT": None, " current ": None, "On Going": None, "some day": None, "14-2011": None, "2010-00-09": None, "Sept 2008": None, "": None, None: None, "Aug 0000": None,
}


@pytest.mark.parametrize("given, expected", DATED.items())
def test_dates(spark, given, expected):
    assert values(spark, dates.normalize_date, [given]) == [expected]


def test_years(spark):
    assert values(spark, dates.year_from_date, ["Oct 1998", "in 2007 or so", "never", "0000", None]) == [1998, 2007, None, None, None]


PHONES = {
    "+1 (212) 555-0147": "+12125550147", "+44 20 7946 0958": "+442079460958", "+44 (0)20 7946 0958": "+442079460958", "+49 (0) 30 901820": "+4930901820", "+39 06 6982 0000": "+390669820000", "+33 1 42 68 53 00 ext. 12": "+33142685300",
    "+1-800-FLOWERS": "+18003569377", "Tel: +81 3-5321-1111": "+81353211111", "+65 12345": None, "+65 6123 4567": "+6561234567", "+7 8 495 123-45-67": "+74951234567", "+1 212 555 0147 x9": "+12125550147", "+353 1 234 5678;ext=4": "+35312345678",
    "98765": None, "+123": None, "": None, None: None, "ring me": None, "+0 123 456 789": None, "020 7946 0958": None, "＋44 20 7946 0958": "+442079460958",
}


def test_phones(spark):
    assert dict(zip(PHONES, values(spark, phones.normalize_phone, list(PHONES)), strict=True)) == PHONES


def test_formal_names_of_countries(spark):
    given = {"Republic of India": "IN", "Kingdom of Spain": "ES", "the United Mexican States": None, "Federal Republic of Germany": "DE", "Bolivia, Plurinational State of": "BO", "Iran, Islamic Republic of": "IR", "People's Republic of China": "CN", "Republic of China": "TW", "United States of America": "US", "Republic of Nowhere": None, "The Netherlands": "NL"}
    assert dict(zip(given, values(spark, lambda c: geo.country_alpha2(spark, c), list(given)), strict=True)) == given


def test_locations(spark):
    got = values(spark, lambda c: geo.location_of_text(spark, c), ["Pune, MH, India", "X,Y,Atlantis", "Lyon", None])
    assert [tuple(x) for x in got] == [("Pune", "MH", "IN"), ("X", "Y", None), ("Lyon", None, None), (None, None, None)]
    by_field = spark.range(1).select(geo.location_of_fields(spark, F.lit("Austin"), F.lit(""), F.lit("TX"), F.lit("usa"))).first()[0]
    assert tuple(by_field) == ("Austin", "TX", "US")
    assert values(spark, lambda c: geo.country_alpha2(spark, c), ["in", "zz", "GBR", "United States", "United States of America", "nowhere", " fr "]) == ["IN", None, "GB", "US", "US", None, "FR"]


def test_emails(spark):
    got = values(spark, text.normalize_emails, [["A@x.com", " a@X.com ", "junk", None, "b@y.org."], []], "array<string>")
    assert got == [["a@x.com", "b@y.org."], []]


def test_spacing_and_keys(spark):
    assert values(spark, text.normalize_name, ["  A\t  B\x1c", "   ", None]) == ["A B", None, None]
    assert values(spark, text.normalize_skill, ["Docker-Swarm", " Node . JS "]) == ["dockerswarm", "node.js"]
    assert values(spark, text.normalize_title, [" Blue  Kite ", None]) == ["blue kite", ""]
    assert values(spark, text.normalize_degree, ["B.Tech", None]) == ["btech", ""]
