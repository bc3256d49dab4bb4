"""URL verdicts from a rule list, else from empirical-Bayes host reputation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import settle
from ..plans.sizing import broadcast_if_small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Public suffixes of two labels that many sites stand under.
LONG_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.za", "co.in", "co.jp", "ne.jp", "or.jp", "co.kr", "com.ar", "com.br", "com.cn", "com.mx", "com.tr", "com.tw")


@dataclass(frozen=True)
class Rule:
    """``text`` is a host, a slash and the start of a path; it fits the host and its subdomains."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


#: The rules of the registered query.
RULES = (
    Rule("com/en/", "block"),
    Rule("example.com/en/7", "allow"),
    Rule("net/de/", "allow"),
    Rule("example.net/de/8", "block"),
    Rule("org/es/", "block"),
)


@dataclass(frozen=True)
class Reputation:
    """How outcomes become verdicts.

    A host is blocked if its bad rate, ``z`` of the posterior's standard deviations below
    its mean, still exceeds ``lift`` times the rate over all outcomes: so what is blocked
    stands out, whatever share of a table is bad.
    """

    lift: float = 1.0
    z: float = 1.645
    #: Pseudo-counts of a level's prior where its groups can't tell (fewer than two of them, or no spread).
    default_strength: float = 10.0
    least_strength: float = 1.0
    most_strength: float = 1000.0
    #: Suffixes of several labels, such as co.uk; any other host's suffix is its last label.
    long_suffixes: tuple[str, ...] = LONG_SUFFIXES


def host_of(url: Column) -> Column:
    after = F.substring_index(url, "://", 1)
    rest = F.when(url.contains("://"), F.substr(url, F.length(after) + 4))
    return F.translate(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    after = F.substring_index(url, "://", 1)
    rest = F.when(url.contains("://"), F.substr(url, F.length(after) + 4))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, long_suffixes: tuple[str, ...] = ()) -> Column:
    last = F.substring_index(host, ".", -1)
    for s in sorted(long_suffixes, key=len):
        last = F.when((host == s) | host.endswith("." + s), s).otherwise(last)
    return last


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix with one more label (the host itself if it has none)."""
    before = F.substr(host, F.lit(1), F.length(host) - F.length(suffix) - 1)
    return F.when(F.length(host) <= F.length(suffix), host).otherwise(F.concat_ws(".", F.substring_index(before, ".", -1), suffix))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """A (rule, verdict) struct: the longest rule that fits (of equally long ones, the first); else null."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    chosen = None
    for r in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        got = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        chosen = F.when(fits, got) if chosen is None else chosen.when(fits, got)
    return chosen


def _strength(groups: DataFrame, how: Reputation) -> float:
    """Pseudo-counts by the method of moments: groups hold n, bad and the mean m of what they shrink to.

    With s the summed squared distance of the groups' rates from m, s = sum(m(1-m)(1/n + (1-1/n)/(k+1))).
    """
    own = groups.where("n > 0")
    v = F.col("m") * (1 - F.col("m"))
    got = own.agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum((F.col("bad") / F.col("n") - F.col("m")) ** 2).alias("s"),
        F.sum(v / F.col("n")).alias("noise"),
        F.sum(v * (1 - 1 / F.col("n"))).alias("room"),
    ).first()
    if got["groups"] < 2 or not got["room"] or got["s"] is None:
        return how.default_strength
    share = (got["s"] - got["noise"]) / got["room"]  # 1 / (k + 1)
    if share <= 0:
        return how.most_strength
    return min(max(1 / share - 1, how.least_strength), how.most_strength)


def host_reputation(outcomes: DataFrame, hosts: DataFrame, how: Reputation = Reputation()) -> DataFrame:
    """(host, n, bad, posterior_mean, lower_bound, reputation) for every host of ``hosts``.

    ``outcomes`` has host and bad (0 or 1, null: skipped). The prior of a suffix is the
    overall rate, of a domain the posterior mean of its suffix's other domains, of a host that
    of its domain's other hosts; each level's strength is estimated from that level's groups. With no outcomes at all the
    overall rate is 0 and everything is allowed.
    """
    counted = outcomes.where("bad is not null").groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
    every = hosts.select("host").distinct().join(counted, "host", "full_outer").fillna(0.0, ["n", "bad"])
    level = every.withColumn("suffix", suffix_of(F.col("host"), how.long_suffixes)).withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    level = settle(level, "hosts")  # the pages are read once for it; all that follows reads a row for each host
    whole = level.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = (whole["bad"] / whole["n"]) if whole["n"] else 0.0

    # What a group shrinks to is what the others above it say: its own outcomes count once, in itself.
    others = lambda k: (F.col("up_bad") - F.col("bad") + k * F.col("up_m")) / (F.col("up_n") - F.col("n") + k)
    suffixes = level.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("m", F.lit(overall))
    k = _strength(suffixes, how)
    suffixes = suffixes.select(F.col("suffix").alias("up"), *[F.col(c).alias(f"up_{c}") for c in ("n", "bad", "m")])
    domains = level.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = domains.join(broadcast_if_small(suffixes), domains["suffix"] == suffixes["up"]).withColumn("m", others(k))
    domains = domains.select("domain", "n", "bad", "m")
    k = _strength(domains, how)
    domains = domains.select(F.col("domain").alias("up"), *[F.col(c).alias(f"up_{c}") for c in ("n", "bad", "m")])
    level = level.join(broadcast_if_small(domains), level["domain"] == domains["up"]).withColumn("m", others(k)).select("host", "n", "bad", "m")
    k = _strength(level, how)
    a, b = F.col("bad") + k * F.col("m"), F.col("n") - F.col("bad") + k * (1 - F.col("m"))
    mean = a / (a + b)
    lower = mean - how.z * F.sqrt(mean * (1 - mean) / (a + b + 1))
    return level.select(
        "host", "n", "bad", mean.alias("posterior_mean"), lower.alias("lower_bound"), F.when(lower > how.lift * overall, "block").otherwise("allow").alias("reputation")
    )


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, how: Reputation = Reputation(), url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """A verdict for each row of pages: the longest fitting rule's, else its host's reputation.

    Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: from there up to ``?``, ``#`` or the end; both empty for a null url
    or one without ``://``, and the empty host is judged like any other. ``outcomes`` has
    url and bad. Repeated rows and ids are judged one by one; an empty table gives no
    rows; further columns are ignored. The reputation table has a row for each host; it
    is broadcast only if counted to be small, else both sides shuffle and adaptive
    execution splits a host that holds much of the table.
    """
    own = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    seen = outcomes.select(host_of(F.col("url")).alias("host"), F.col("bad").cast("int").alias("bad"))
    known = settle(host_reputation(seen, own, how).select(F.col("host").alias("known"), "reputation", "posterior_mean"), "reputations")
    # A struct as key has both sides exchanged for this join alone, which adaptive execution can split.
    judged = own.join(broadcast_if_small(known), F.struct(own["host"]) == F.struct(known["known"].alias("host")), "left")
    got = rule_of(F.col("host"), F.col("path"), rules)
    return judged.withColumn("got", got).select(
        "page_id", "host", "path", F.col("got.rule").alias("rule"), F.coalesce("got.verdict", "reputation").alias("verdict"), "posterior_mean"
    )


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): a page whose url's path ends in a document's number has that document's label; bad: low quality or toxic."""
    number = F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})(?:\.html)?/?$", 1)
    own = pages.select("url", F.when(number != "", number.cast("long")).alias("named"))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull(), 0)
    known = labels.groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return own.join(known, own["named"] == known["doc_id"]).select("url", "bad")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    outcomes = labelled_pages(pages, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return filter_urls(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


def oracle() -> str:
    """The query in DuckDB's SQL."""
    how, rules = Reputation(), sorted(RULES, key=lambda r: -len(r.text))

    def fits(r: Rule) -> str:
        return f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')"

    rule = "case " + " ".join(f"when {fits(r)} then '{r.text}'" for r in rules) + " end"
    verdict = "case " + " ".join(f"when {fits(r)} then '{r.verdict}'" for r in rules) + " else reputation end"

    suffix = "case " + " ".join(f"when x.host = '{x}' or ends_with(x.host, '.{x}') then '{x}'" for x in how.long_suffixes) + " else regexp_extract(x.host, '[^.]*$') end"

    def strength(table: str) -> str:
        return f"""(select case when count(*) < 2 or coalesce(sum(m*(1-m)*(1-1/n)), 0) = 0 then {how.default_strength}
            when sum((bad/n-m)*(bad/n-m)) <= sum(m*(1-m)/n) then {how.most_strength}
            else least(greatest(sum(m*(1-m)*(1-1/n)) / (sum((bad/n-m)*(bad/n-m)) - sum(m*(1-m)/n)) - 1, {how.least_strength}), {how.most_strength}) end as k from {table} where n > 0)"""

    return f"""
with p as (
  select page_id, url, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), q as (
  select page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') as host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from p
), l as (
  select doc_id, max(case when quality = 0 or toxic = 1 then 1 when quality is not null then 0 end) as bad from labels group by 1
), o as (
  select q.host, l.bad from q join l on l.doc_id = try_cast(nullif(regexp_extract(q.path, '/(\\d{{1,18}})(?:\\.html)?/?$', 1), '') as bigint)
), c as (
  select host, count(*)::double as n, sum(bad)::double as bad from o where bad is not null group by 1
), h as (
  select x.host, coalesce(n, 0) as n, coalesce(bad, 0) as bad, {suffix} as suffix,
    case when length(x.host) <= length({suffix}) then x.host else concat_ws('.', regexp_extract(x.host[: length(x.host) - length({suffix}) - 1], '[^.]*$'), {suffix}) end as domain
  from (select distinct host from q) x left join c using (host)
), s0 as (
  select suffix, sum(n) as n, sum(bad) as bad, coalesce((select sum(bad) / sum(n) from c), 0.0) as m from h group by 1
), s as (
  select *, k from s0, {strength("s0")}
), d0 as (
  select domain, suffix, sum(h.n) as n, sum(h.bad) as bad, any_value(s.n) as un, any_value(s.bad) as ub, any_value(s.m) as um, any_value(s.k) as k from h join s using (suffix) group by 1, 2
), d1 as (
  select domain, n, bad, (ub - bad + k * um) / (un - n + k) as m from d0
), d as (
  select *, k from d1, {strength("d1")}
), h0 as (
  select host, h.n, h.bad, (d.bad - h.bad + d.k * d.m) / (d.n - h.n + d.k) as m from h join d using (domain)
), h1 as (
  select host, (bad + k * m) / (n + k) as mean, n + k as total from h0, {strength("h0")}
), r as (
  select host, case when mean - {how.z} * sqrt(mean * (1 - mean) / (total + 1)) > {how.lift} * coalesce((select sum(bad) / sum(n) from c), 0.0) then 'block' else 'allow' end as reputation from h1
)
select page_id, host, path, {rule} as rule, {verdict} as verdict from q join r using (host)
"""
