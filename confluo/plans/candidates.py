"""A candidate view over the customer and orders tables, for queries and benchmarks.

Every column is arithmetic over the customer's key, so that SQL engines can derive the same
records. Spellings, spacing, ties, nulls and shared contacts are varied on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import location_of_text
from ..functions.phones import normalize_phones
from ..functions.text import normalize_emails, normalize_name
from ..operators.identity import candidate_id, identity_components
from ..operators.taxonomy import GROUPINGS, skills_of
from ..sources.tables import record
from .shared import settle

SKILLS = ("js", "JavaScript", "PY", "docker swarm", "Svelte", "K8s")
CITIES = ("Pune", "Austin", "Leeds", "Osaka", "Lyon")

#: Scalar columns in the SQL that Spark and DuckDB share; ``{a} // {b}`` is written by ``dialect``.
RAW = {
    "rid": "k",
    "source": "case when k % 2 = 0 then 'csv_' else 'resume_' end || lpad(cast(k as string), 9, '0')",
    "method": "case when k % 2 = 0 then 'normalization' else 'openresume+normalization' end",
    "procured_at": "case when k % 11 <> 0 then '2024-01-0' || cast((k * 37) % 5 + 1 as string) || 'T00:00:00Z' end",
    "raw_name": "case when k % 5 = 0 then 'Someone Else ' || cast(k as string) when k % 4 = 0 then 'Person ' || cast(third as string)"
    " when k % 4 = 1 then '  person   ' || cast(third as string) when k % 4 = 2 then 'PERSON ' || cast(third as string) else 'Person' || chr(9) || ' ' || cast(third as string) || ' ' end",
    "raw_email": "' C' || cast(third as string) || '@Example.COM '",
    "raw_phone": "case when k % 7 in (2, 3) then '+1 415-' || lpad(cast(seventh as string), 7, '0') end",
    "city": "case k % 5 when 0 then 'Pune' when 1 then 'Austin' when 2 then 'Leeds' when 3 then 'Osaka' else 'Lyon' end",
    "region": "case when k % 3 = 0 then ' ' else 'R' || cast(k % 3 as string) end",
    "country": "case nation % 4 when 0 then 'India' when 1 then 'US' when 2 then ' gbr' else 'Nowhere' end",
    "headline": "case when k % 6 <> 0 then segment end",
    "years_experience": "case when balance >= 0 then floor(balance / 1000) end",
    "linkedin": "case when k % 4 = 0 then 'https://www.linkedin.com/in/p' || cast(third as string) end",
    "github": "case when k % 4 = 1 then 'https://github.com/p' || cast(k as string) end",
    "portfolio": "case when k % 4 = 2 then 'https://p.example/' || cast(third as string) end",
    "other": "case when k % 2 = 0 then 'https://other.example/' || cast(k % 3 as string) end",
    "institution": "'Institute ' || cast(third % 25 as string)",
    "degree": "case k % 3 when 0 then 'B.Eng.' when 1 then 'b eng' else 'Dipl.' end",
    "field": "case when k % 2 = 0 then 'Maths' else 'Applied Maths' end",
    "end_year": "cast(2020 + k % 3 as int)",
    "project": "case k % 3 when 0 then 'Ledger' when 1 then 'ledger' else ' Blue  Kite ' end",
    "description": "case when k % 5 <> 0 then repeat('d', cast(k % 4 + 1 as int)) end",
    "n_tools": "k % 2",
    "skill1": "k % 6",
    "skill2": "(k + 1) % 6",
    "skill3": "case when k % 2 = 0 then (k * 7 + 3) % 6 end",
}


def dialect(duck: bool) -> str:
    """The raw view as a SELECT over customer."""
    div = (lambda a, b: f"{a} // {b}") if duck else (lambda a, b: f"{a} div {b}")
    base = f"select c_custkey as k, {div('c_custkey', 3)} as third, {div('c_custkey', 7)} as seventh, c_nationkey as nation, c_mktsegment as segment, c_acctbal as balance from customer"
    return f"select {', '.join(f'{v} as {k}' for k, v in RAW.items())} from ({base})"


def dealt(df: DataFrame, key: str) -> DataFrame:
    """A narrow table's rows dealt out by key to as many tasks as a shuffle has: its few splits would leave most of them without work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def raw_candidates(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The raw view, its skills an array, with the customer's orders as positions. With ``spread`` the rows are dealt out first."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    if spread:
        customer = dealt(customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"), "c_custkey")
    base = customer.selectExpr("c_custkey as k", "c_custkey div 3 as third", "c_custkey div 7 as seventh", "c_nationkey as nation", "c_mktsegment as segment", "c_acctbal as balance")
    return base.selectExpr(*[f"{v} as {k}" for k, v in RAW.items()])


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rid, experience): a customer's orders as positions, by order key."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    date = F.col("o_orderdate")
    end = F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.year(date) + 1, F.date_format(date, "-MM")))
    one = F.struct(
        F.col("o_orderkey").alias("key"),
        F.struct(F.col("o_orderpriority").alias("company"), F.col("o_orderstatus").alias("title"), F.date_format(date, "yyyy-MM").alias("start"), end.alias("end"), F.concat(F.lit("s"), F.col("o_orderkey") % 7).alias("summary")).alias("x"),
    )
    rows = orders.groupBy(F.col("o_custkey").alias("rid")).agg(F.array_sort(F.collect_list(one)).alias("all"))
    return rows.select("rid", F.transform("all", lambda v: v["x"]).alias("experience"))


def norm_map() -> dict[str, str]:
    """The default taxonomy as a map from keys to names."""
    key = lambda s: "".join(s.lower().replace("-", "").split())
    return {key(s): name for name, spellings in GROUPINGS.items() for s in [name, *spellings]}


def candidates(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """The view as records of the contract, with rid; of the fields named alone, if any are. Positions are read only for experience."""
    raw = raw_candidates(spark, sf_dir, spread=True)
    if not fields or "experience" in fields:
        raw = raw.join(positions(spark, sf_dir), "rid", "left")
    else:
        raw = raw.withColumn("experience", F.lit(None))
    pick = F.array(*[F.lit(s) for s in SKILLS])
    mentions = F.filter(F.array(*[F.get(pick, F.col(c).cast("int")) for c in ("skill1", "skill2", "skill3")]), lambda s: s.isNotNull())
    tools = F.when(F.col("n_tools") == 0, F.array(F.lit("Lua"))).otherwise(F.array(F.lit("Lua"), F.lit("Kafka")))
    links = F.struct("linkedin", "github", "portfolio", F.filter(F.array("other"), lambda o: o.isNotNull()).alias("other"))
    whole = raw.select(
        "rid",
        *record(
            source=F.col("source"),
            method=F.col("method"),
            procured_at=F.col("procured_at"),
            full_name=normalize_name(F.col("raw_name")),
            emails=normalize_emails(F.array("raw_email")),
            phones=normalize_phones(F.array("raw_phone")),
            location=location_of_text(spark, F.concat_ws(",", "city", "region", "country")),
            links=links,
            headline=F.col("headline"),
            years_experience=F.col("years_experience"),
            skills=skills_of(mentions, norm_map(), F.col("source")),
            experience=F.col("experience"),
            education=F.array(F.struct("institution", "degree", "field", "end_year")),
            projects=F.array(F.struct(F.col("project").alias("title"), "description", tools.alias("tech_stack"))),
        ),
    )
    return whole.select("rid", *fields) if fields else whole


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rid, emails, phones): what identities rest on, as a table.

    Read lazily, they would be worked out by every branch, and in the scan's one split: Spark puts
    the filter that it infers for an explode (the array has items) below the rows' dealing out.
    """
    return settle(candidates(spark, sf_dir, "emails", "phones"), "contacts")


def members(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """The records, of all fields or those named, with component and candidate_id, as a table, since the branches of a fusion read them several times."""
    found = identity_components(contacts(spark, sf_dir))
    return settle(candidates(spark, sf_dir, *fields).join(found, "rid").withColumn("candidate_id", candidate_id(F.col("component"))), "members")


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rid, component) of the records."""
    return identity_components(contacts(spark, sf_dir))
