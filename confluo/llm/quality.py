"""Quality rules: text statistics and a learned decision list, as DataFrame expressions only.

The statistics are SQL functions over each row. Sequential covering on a bounded sample of
labelled rows, on the driver, gives ordered threshold conjunctions; the list is emitted as
one CASE expression, so that judging a table is a projection without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import columns_but

SPACE = r"[\\x20\\x09-\\x0D]+"
NO_SPACE = r"[^\\x20\\x09-\\x0D]"
#: Bits of a sort key that hold a window's position; longer texts take the slow path.
POSITION_BITS = 24


def _covered(q: str) -> str:
    """SQL: the number of words in the union of the 3-word windows at the ordered positions ``q``."""
    return f"aggregate({q}, struct(-3 AS last, 0L AS t), (a, p) -> struct(p AS last, a.t + least(3, p - a.last) AS t), a -> a.t)"


def _gram(w: str, i: str) -> str:
    return f"concat_ws(' ', {w}[{i}], {w}[{i} + 1], {w}[{i} + 2])"


def _repeat_words(w: str) -> str:
    """SQL: the words of the array ``w`` that lie in a 3-word window found twice or more.

    Fast path: one primitive sort of longs, the upper bits a window's hash, the lower its
    position; equal neighbours are verified as text. Where a hash was equal and a text not,
    or a text is too long for the position bits, the windows are sorted as text.
    """
    low = (1 << POSITION_BITS) - 1
    n = f"size({w})"
    keys = f"sort_array(transform(sequence(0, {n} - 3), i -> (xxhash64({w}[i], {w}[i + 1], {w}[i + 2]) & {~low}L) | i))"
    place = lambda k: f"cast({k} & {low}L AS int)"
    pairs = (
        f"transform(filter(sequence(1, size(k) - 1), j -> (k[j] & {~low}L) = (k[j - 1] & {~low}L)), j -> struct({place('k[j - 1]')} AS p, {place('k[j]')} AS q))"
    )
    same = f"{_gram(w, 'x.p')} = {_gram(w, 'x.q')}"
    places = "array_distinct(sort_array(concat(m.p, m.q)))"
    sorted_text = f"sort_array(transform(sequence(0, {n} - 3), i -> struct({_gram(w, 'i')} AS g, i AS p)))"
    slow = (
        f"transform(array({sorted_text}), s -> {_covered('sort_array(transform(filter(sequence(0, size(s) - 1), j -> (j > 0 AND s[greatest(j - 1, 0)].g = s[j].g) OR (j < size(s) - 1 AND s[least(j + 1, size(s) - 1)].g = s[j].g)), j -> s[j].p))')})[0]"
    )
    fast = f"transform(array({keys}), k -> if(size(k) < 2, cast(array() as array<struct<p:int,q:int>>), {pairs}))[0]"
    judged = f"transform(array({fast}), m -> CASE WHEN size(m) = 0 THEN 0L WHEN exists(m, x -> NOT ({same})) THEN {slow} ELSE {_covered(places)} END)[0]"
    return f"CASE WHEN {n} < 4 THEN 0L WHEN {n} > {low} THEN {slow} ELSE {judged} END"


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs", "n_digits")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however the optimizer moves the expression."""
    return F.transform(F.array(value), use)[0]


def statistics(text: Column | str = "text") -> Column:
    """A struct of counts (long) of one text; null counts as empty."""
    t = f"coalesce(`{text}`, '')"
    words = f"filter(split({t}, '{SPACE}'), w -> w <> '')"
    lines = f"filter(split({t}, '\\n'), l -> l RLIKE '{NO_SPACE}')"
    return F.expr(
        f"transform(array(struct({words} AS w, {lines} AS l, {t} AS t)), z -> struct("
        f"cast(size(z.w) AS long) AS n_words,"
        f" aggregate(z.w, 0L, (a, v) -> a + length(v)) AS word_chars,"
        f" cast(regexp_count(z.t, '[#*$%&|<>]') AS long) AS n_symbols,"
        f" cast(size(z.l) - size(array_distinct(z.l)) AS long) AS n_dup_lines,"
        f" {_repeat_words('z.w')} AS n_repeat_words,"
        f" cast(size(z.l) AS long) AS n_lines,"
        f" cast(regexp_count(z.t, '\\\\p{{Lu}}') AS long) AS n_upper,"
        f" cast(regexp_count(z.t, '!') AS long) AS n_bangs,"
        f" cast(regexp_count(z.t, '[0-9]') AS long) AS n_digits))[0]"
    )


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


#: What conditions compare: ratios of the counts, the same in short and long texts.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "bangs_per_word": ("n_bangs", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "chars_per_word": ("word_chars", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "dup_lines_per_line": ("n_dup_lines", "n_lines"),
    "repeat_words_per_word": ("n_repeat_words", "n_words"),
}


def feature(s: Column, name: str) -> Column:
    """A ratio of counts; 0 where the text has no words."""
    a, b = FEATURES[name]
    return F.when(s[b] > 0, s[a].cast("double") / s[b]).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    bound: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, list(FEATURES).index(self.name)]
        return v >= self.bound if self.above else v < self.bound

    def column(self, s: Column) -> Column:
        v = feature(s, self.name)
        return v >= self.bound if self.above else v < self.bound

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.bound:.6g}"


Conjunction = tuple[Condition, ...]


@dataclass(frozen=True)
class Learner:
    """Bounds and settings of the sequential covering."""

    #: At most so many labelled rows, those whose ids hash lowest, are drawn for fitting.
    sample_rows: int = 8_000
    thresholds: int = 64
    most_conditions: int = 3
    most_rules: int = 12
    #: A rule stays if, on rows held back for pruning, at least this share of what it rejects is bad.
    least_precision: float = 0.9
    least_covered: int = 5

    def fit(self, x: np.ndarray, bad: np.ndarray) -> list[Conjunction]:
        """Ordered conjunctions that describe bad rows: each is grown on two rows of three, pruned on the third."""
        third = np.arange(len(x)) % 3 == 2
        left, rules = np.ones(len(x), bool), []
        while len(rules) < self.most_rules:
            grow, prune = left & ~third, left & third
            if (bad & grow).sum() < self.least_covered:
                break
            rule = self._prune(self._grow(x[grow], bad[grow]), x[prune], bad[prune])
            if not rule:
                break
            hit = np.logical_and.reduce([c.holds(x) for c in rule])
            for part in (grow, prune):
                n = (hit & part).sum()
                if n and (hit & part & bad).sum() < self.least_precision * n:
                    return rules
            if (hit & left & bad).sum() < self.least_covered:
                break
            rules.append(rule)
            left &= ~hit
        return rules

    def _grow(self, x: np.ndarray, bad: np.ndarray) -> Conjunction:
        """Adds the condition of the largest FOIL gain until nothing good is covered."""
        rule: Conjunction = ()
        inside = np.ones(len(x), bool)
        while len(rule) < self.most_conditions:
            p, n = (bad & inside).sum(), (~bad & inside).sum()
            if not n or not p:
                break
            now, best, chosen = np.log2(p / (p + n)), 1e-9, None
            for k, name in enumerate(FEATURES):
                v = x[inside, k]
                for bound in np.unique(np.quantile(v, np.linspace(0, 1, self.thresholds))):
                    above = v >= bound
                    for side, hit in ((True, above), (False, ~above)):
                        p1 = (bad[inside] & hit).sum()
                        if p1:
                            gain = p1 * (np.log2(p1 / hit.sum()) - now)
                            if gain > best:
                                best, chosen = gain, Condition(name, side, float(bound))
            if chosen is None:
                break
            rule += (chosen,)
            inside &= chosen.holds(x)
        return rule

    def _prune(self, rule: Conjunction, x: np.ndarray, bad: np.ndarray) -> Conjunction:
        """The shortest beginning of the rule whose value (p - n) / (p + n) on the held-back rows is the largest."""
        best, kept = -np.inf, rule
        for k in range(1, len(rule) + 1):
            hit = np.logical_and.reduce([c.holds(x) for c in rule[:k]])
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            if p + n and (p - n) / (p + n) > best:
                best, kept = (p - n) / (p + n), rule[:k]
        return kept


def learn(docs: DataFrame, labels: DataFrame, how: Learner = Learner(), id_col: str = "doc_id", text_col: str = "text") -> list[Conjunction]:
    """The decision list from the labelled rows of docs; ``labels`` has doc_id and quality (0: bad; null: skipped).

    A document with several labels is bad if one of them says so. Without labels, or with
    one kind only, the list is empty and rejects nothing.
    """
    known = labels.where("quality is not null").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.sample_rows)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # The sample is bounded by its limit; it goes to the documents, not they to it.
    rows = own.join(F.broadcast(drawn), "doc_id").select("doc_id", "bad", _bound(statistics("text"), lambda s: F.struct(base_failed(s).alias("base_failed"), *[feature(s, f).alias(f) for f in FEATURES])).alias("s"))
    drawn_rows = rows.select("doc_id", "bad", "s.*").orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(how.sample_rows).collect()
    # Those that the base rejects are left out here: as a filter it would be moved below the join, to all documents.
    picked = [r for r in drawn_rows if not r["base_failed"]]
    if not picked:
        return []
    x = np.array([[r[f] for f in FEATURES] for r in picked], float)
    return how.fit(x, np.array([r["bad"] for r in picked], bool))


def rejected_by(s: Column, rules: list[Conjunction]) -> Column:
    """The text of the first rule that holds, as one ordered CASE expression; null if none does."""
    chosen = None
    for rule in rules:
        holds = rule[0].column(s)
        for c in rule[1:]:
            holds = holds & c.column(s)
        said = " and ".join(map(str, rule))
        chosen = F.when(holds, said) if chosen is None else chosen.when(holds, said)
    return chosen if chosen is not None else F.lit(None).cast("string")


def judge(docs: DataFrame, rules: list[Conjunction], text_col: str = "text", into: str = "judged") -> DataFrame:
    """docs with a struct column ``into``: the statistics, base_failed, rule (the one that rejects) and kept.

    Null and empty texts have no words and so fail the base. Every row is judged for itself,
    repeated ones too; an empty table gives no rows; other columns stay as they are, but one named like ``into``.
    """

    def verdict(s: Column) -> Column:
        failed, rule = base_failed(s), rejected_by(s, rules)
        counts = [s[c].alias(c) for c in COUNTS]
        return F.struct(*counts, failed.alias("base_failed"), F.when(~failed, rule).alias("rule"), (~failed & rule.isNull()).alias("kept"))

    return docs.withColumn(into, _bound(statistics(text_col), verdict))


def keep_good(docs: DataFrame, rules: list[Conjunction], text_col: str = "text") -> DataFrame:
    """The rows of docs that the base and the list keep, columns unchanged."""
    into = columns_but(docs)
    return judge(docs, rules, text_col, into).where(F.col(f"{into}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
    return judge(docs, rules).select("doc_id", *[f"judged.{c}" for c in shown])
