"""International telephone numbers to E.164."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import distinct_present, let, strip

#: Fixed values of the international numbering plan: the country codes of one and of two digits; all others have three.
ONE_DIGIT = ("1", "7")
TWO_DIGITS = (
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58",
    "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
)
#: Fixed values of national plans: how many digits may follow a country code; other codes have the general bounds.
GENERAL = "5-12"
LENGTHS = {
    "1": "10", "7": "10", "20": "8-10", "27": "5-9", "30": "10-12", "31": "5-11", "32": "8-9", "33": "9", "34": "9", "36": "8-9", "39": "6-12", "40": "9", "41": "9", "43": "4-13", "44": "7 9-10", "45": "8",
    "46": "6-12", "47": "5 8", "48": "9", "49": "4-15", "51": "8-9", "52": "10-11", "53": "6-8 10", "54": "10-11", "55": "8-11", "56": "9-11", "57": "8 10-11", "58": "10", "60": "8-10", "61": "5-12 15",
    "62": "7-13", "63": "6 8-13", "64": "5-10", "65": "8 10-11", "66": "8-10 13", "81": "8-17", "82": "5-6 8-14", "84": "7-10", "86": "7-12", "90": "7 10 12-13", "91": "8-13", "92": "8-12", "93": "9", "94": "9",
    "95": "6-10", "98": "4-10", "351": "9", "352": "4-11", "353": "7-10", "354": "7 9", "358": "5-12", "370": "8", "371": "8", "380": "9-10", "420": "9-12", "852": "5-9 11", "880": "6-10", "886": "7-11", "966": "9-10",
    "971": "5-12", "972": "7-12",
}
#: Fixed values of national plans: the digit dialled before a number at home, which has no place after a country code; 0 unless named here.
TRUNK = {"1": "1", "7": "8", "34": "", "36": "", "39": "", "45": "", "47": "", "48": "", "65": "", "351": "", "352": "", "354": "", "371": "", "420": "", "852": ""}
#: The letters of a telephone's keys.
LETTERS, KEYS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "22233344455566677778889999"
#: Signs that stand within numbers, and what precedes an extension.
SIGNS = r"\-x‐-―−ー－／\p{Z}\t­​⁠()（）［］.\[\]/~⁓∼～*"
EXTENSION = r"(?i)(?:;ext=|[ \t,]*(?:e?xt(?:ensi[oó]n?)?n?|anexo|int|[x#~])[:.]?[ \t,-]*)\p{Nd}{1,9}#?\z"


def _mask(lengths: str) -> int:
    """A bit for each number of digits allowed."""
    bounds = ([int(x) for x in part.split("-")] for part in lengths.split())
    return sum(1 << n for b in bounds for n in range(b[0], b[-1] + 1))


def normalize_phone(c: Column) -> Column:
    """``+`` and digits if the text has a number with a ``+`` that may be one by its country's lengths, else null.

    What precedes the ``+`` is passed over, an extension is left out, letters stand for their
    keys if there are three of them or more, and a trunk digit (``+44 (0)20 ...``) goes.
    Numbers without a country code can't be told apart and are null. Number ranges within a
    country aren't checked, as a number that is only possible is accepted.
    """
    table = lambda d: F.create_map(*[F.lit(x) for pair in d.items() for x in pair])
    allowed = lambda lengths, n: F.getbit(lengths, F.least(F.length(n), F.lit(62))) == 1

    def whole(x: Column) -> Column:
        code, national, lengths, trunk = x["code"], x["national"], x["lengths"], x["trunk"]
        home = F.when((trunk != "") & national.startswith(trunk), F.substr(national, F.lit(2), F.lit(20)))
        # A number that is possible as it stands and would not be without the digit keeps it.
        drop = home.isNotNull() & (allowed(lengths, home) | ~allowed(lengths, national)) & ((trunk == "0") | ~allowed(lengths, national))
        return let(F.when(drop, home).otherwise(national), lambda n: F.when(allowed(lengths, n), F.concat(F.lit("+"), code, n)))

    def planned(x: Column) -> Column:
        lengths = F.coalesce(F.try_element_at(table({k: _mask(v) for k, v in LENGTHS.items()}), x["code"]), F.lit(_mask(GENERAL))).cast("long")
        trunk = F.coalesce(F.try_element_at(table(TRUNK), x["code"]), F.lit("0"))
        return let(F.struct(x["code"].alias("code"), x["national"].alias("national"), lengths.alias("lengths"), trunk.alias("trunk")), whole)

    def of_digits(digits: Column) -> Column:
        size = F.when(F.substring(digits, 1, 1).isin(*ONE_DIGIT), 1).when(F.substring(digits, 1, 2).isin(*TWO_DIGITS), 2).otherwise(3)
        parts = let(size, lambda n: F.struct(F.substr(digits, F.lit(1), n).alias("code"), F.substr(digits, n + 1, F.lit(20)).alias("national")))
        return F.when(~digits.startswith("0"), let(parts, planned))

    def of_bare(bare: Column) -> Column:
        shaped = bare.rlike(rf"^[+＋]+(?:[{SIGNS}]*\p{{Nd}}){{3,}}[{SIGNS}A-Za-z\p{{Nd}}]*\z")
        spelled = F.when(bare.rlike("(?s)(?:.*?[A-Za-z]){3}"), F.translate(F.upper(bare), LETTERS, KEYS)).otherwise(bare)
        return F.when(shaped, let(F.regexp_replace(spelled, r"\P{Nd}", ""), of_digits))

    found = F.regexp_extract(strip(c), r"(?s)[+＋\p{Nd}].*", 0)
    cut = F.regexp_replace(F.regexp_replace(found, r"(?s)[\\/] *x.*", ""), r"[^\p{L}\p{Nd}#]+\z", "")
    return let(F.regexp_replace(cut, EXTENSION, ""), of_bare)


def normalize_phones(values: Column) -> Column:
    return distinct_present(F.transform(values, normalize_phone))
