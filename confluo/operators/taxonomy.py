"""Skill taxonomy: lookup of spellings, and registration of unseen ones."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_skill, strip
from ..plans.sizing import broadcast_if_small

# Canonical skill names and their spellings.
GROUPINGS = {
    "AWS": ["aws", "amazon web services"],
    "Algorithms": ["algorithms"],
    "Azure": ["azure", "microsoft azure"],
    "Bash": ["bash", "shell"],
    "C": ["c"],
    "C++": ["c++", "cpp", "cplusplus"],
    "C/C++": ["c/c++"],
    "CI/CD Pipeline": ["ci/cdpipeline"],
    "CS Fundamentals": ["csfundamentals"],
    "CSS": ["css", "css3", "vanilla css"],
    "Computer Architecture": ["computerarchitecture"],
    "Computer Networks": ["computernetworks"],
    "Concurrency": ["concurrency"],
    "DBMS": ["dbms"],
    "Data Structures": ["datastructures"],
    "Deep Learning": ["deep learning", "dl"],
    "Django": ["django"],
    "Docker": ["docker"],
    "Docker Swarm": ["docker swarm", "dockerswarm"],
    "Express": ["express", "expressjs", "express.js"],
    "FastAPI": ["fastapi", "fast api"],
    "Flask": ["flask"],
    "GCP": ["gcp", "google cloud", "google cloud platform"],
    "Git": ["git"],
    "Go": ["go", "golang"],
    "Grafana": ["grafana"],
    "GraphQL": ["graphql"],
    "HTML": ["html", "html5"],
    "Java": ["java"],
    "JavaScript": ["javascript", "js", "java script"],
    "Kubernetes": ["kubernetes", "k8s"],
    "Linux": ["linux"],
    "Machine Learning": ["machine learning", "ml"],
    "MongoDB": ["mongodb", "mongo"],
    "Multi-threading": ["multithreading"],
    "MySQL": ["mysql"],
    "NLP": ["nlp", "natural language processing"],
    "Next.js": ["next", "nextjs", "next.js"],
    "Nginx": ["nginx"],
    "Node.js": ["node", "nodejs", "node.js"],
    "NumPy": ["numpy"],
    "OOPS": ["oops"],
    "OS": ["os"],
    "Pandas": ["pandas"],
    "Pgbouncer": ["pgbouncer"],
    "PostgreSQL": ["postgresql", "postgres", "psql"],
    "PyTorch": ["pytorch", "torch"],
    "Python": ["python", "py", "python3"],
    "REST": ["rest", "rest api", "restful"],
    "React": ["react", "reactjs", "react.js"],
    "Redis": ["redis"],
    "Rust": ["rust"],
    "SQL": ["sql"],
    "Spring Boot": ["spring boot", "springboot", "spring"],
    "Supabase": ["supabase"],
    "System Design": ["systemdesign"],
    "Tailwind CSS": ["tailwind", "tailwindcss", "tailwind css"],
    "TensorFlow": ["tensorflow", "tf"],
    "Terraform": ["terraform"],
    "TypeScript": ["typescript", "ts"],
    "WebSockets": ["websockets"],
    "k6": ["k6"],
}

SCHEMA = "norm string, canonical string"


def taxonomy(spark: SparkSession, groupings: dict[str, list[str]] = GROUPINGS) -> DataFrame:
    """(norm, canonical): every canonical name and spelling under its key; of equal keys the last one counts."""
    rows = [(k, n, spelling, canonical) for k, (canonical, spellings) in enumerate(groupings.items()) for n, spelling in enumerate([canonical, *spellings])]
    all_rows = spark.createDataFrame(rows, "k int, n int, spelling string, canonical string")
    return all_rows.groupBy(normalize_skill(F.col("spelling")).alias("norm")).agg(F.max_by("canonical", F.struct("k", "n")).alias("canonical"))


def load_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """A taxonomy file: either groupings (names with lists of spellings) or keys with their names, as ``save_taxonomy`` writes them."""
    said = load_groupings(path)
    if all(isinstance(v, list) for v in said.values()):
        return taxonomy(spark, said) if said else spark.createDataFrame([], SCHEMA)
    return spark.createDataFrame(list(said.items()), SCHEMA)


def load_groupings(path: str) -> dict[str, list[str]]:
    """Groupings from a JSON file; none if there is no such file."""
    return json.loads(Path(path).read_text("utf-8")) if Path(path).exists() else {}


def save_taxonomy(known: DataFrame, path: str) -> None:
    """A JSON object, keys sorted. A taxonomy is made by hand, and so small."""
    Path(path).write_text(json.dumps({r["norm"]: r["canonical"] for r in known.toLocalIterator()}, indent=2, ensure_ascii=False, sort_keys=True), "utf-8")


def unseen(mentions: DataFrame, known: DataFrame, order: list[str]) -> DataFrame:
    """(norm, canonical) of the skills that the taxonomy lacks: the spelling first met, by the columns of ``order``, becomes the name.

    ``mentions`` has raw and the columns of ``order``.
    """
    own = mentions.withColumn("raw", strip(F.col("raw"))).withColumn("norm", normalize_skill(F.col("raw"))).where("norm <> ''")
    first = own.groupBy("norm").agg(F.min_by("raw", F.struct(*order)).alias("canonical"))
    return first.join(broadcast_if_small(known.select("norm")), "norm", "left_anti")


def register(mentions: DataFrame, known: DataFrame, order: list[str]) -> DataFrame:
    """The taxonomy with ``unseen`` skills added."""
    return known.unionByName(unseen(mentions, known, order))


def canonicalize(mentions: DataFrame, known: DataFrame, key: list[str], position: str = "pos") -> DataFrame:
    """(key..., skill, pos) of each record's skills: canonical names, each once, where first mentioned; blank mentions are skipped, unknown ones keep their spelling."""
    own = mentions.withColumn("raw", strip(F.col("raw"))).withColumn("norm", normalize_skill(F.col("raw"))).where("norm <> ''")
    named = own.join(broadcast_if_small(known), "norm", "left").withColumn("skill", F.coalesce("canonical", "raw"))
    return named.groupBy(*key, "skill").agg(F.min(position).alias("pos"))


def with_skills(records: DataFrame, mentions: DataFrame, known: DataFrame) -> DataFrame:
    """Records (one for each source) with the skills that ``mentions`` (source, raw, pos) has of them, by a join with the taxonomy."""
    named = canonicalize(mentions, known, ["source"]).groupBy("source").agg(F.array_sort(F.collect_list(F.struct("pos", "skill"))).alias("named"))
    own = records.drop("skills").join(named, "source", "left")
    told = F.transform("named", lambda x: F.struct(x["skill"].alias("name"), F.array("source").alias("sources")))
    return own.withColumn("skills", F.coalesce(told, F.array().cast(records.schema["skills"].dataType))).select(*records.columns)


def skills_of(raw: Column, known: dict[str, str], source: Column) -> Column:
    """The skills of one array of mentions, as {name, sources}, by a map literal; for a taxonomy that fits into the plan."""
    table = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
    own = F.filter(F.transform(raw, strip), lambda s: s.isNotNull() & (normalize_skill(s) != ""))
    names = F.array_distinct(F.transform(own, lambda s: F.coalesce(F.try_element_at(table, normalize_skill(s)), s)))
    return F.transform(names, lambda n: F.struct(n.alias("name"), F.array(source).alias("sources")))

