"""Command line: ``run`` fuses a folder of CSV files and extracted resumes; ``project`` reshapes stored profiles; ``taxonomy`` makes a lookup of a file of names and spellings."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import sinks, taxonomy
from .operators.identity import membership
from .operators.projection import Config, ProjectionError
from .operators.survivorship import fuse, with_candidates
from .plans.shared import settle
from .sources import tables

OK, FAILED, UNREADABLE = 0, 1, 2


def session() -> SparkSession:
    return SparkSession.builder.appName("confluo").config("spark.sql.session.timeZone", "UTC").getOrCreate()


#: The order in which skills are met; the first spelling of an unknown one becomes its name.
MET = ["kind", "file", "row", "pos"]


def skill_names(spark: SparkSession) -> dict[str, str]:
    return {r["norm"]: r["canonical"] for r in taxonomy.taxonomy(spark).collect()}  # the hand-made taxonomy: some hundred rows


def records(spark: SparkSession, csvs: str | None, resumes: str | None, known: DataFrame | None = None, source_id: str = "file_row", originals: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all records of both folders, the taxonomy with the skills that they add, the files passed over with the reason).

    Folders are on any file system that Spark reads; one that is named but absent is an
    error. rid, which tells records apart, is the source. ``originals``: see ``scan_resumes``.
    """
    known = taxonomy.taxonomy(spark) if known is None else known
    found = spark.createDataFrame([], tables.schema.RECORD)
    mentions = spark.createDataFrame([], "source string, kind int, file string, row int, pos int, raw string")
    skipped = spark.createDataFrame([], "file string, reason string")
    if csvs:
        rows, bad = tables.scan_csv(spark, csvs, source_id)
        skipped = skipped.unionByName(bad)
        found, mentions = found.unionByName(tables.csv_records(rows)), mentions.unionByName(tables.csv_mentions(rows))
    if resumes:
        raw, bad = tables.scan_resumes(spark, resumes, originals)
        skipped = skipped.unionByName(bad)
        found, mentions = found.unionByName(tables.resume_records(spark, raw)), mentions.unionByName(tables.resume_mentions(raw))
    grown = settle(taxonomy.register(mentions, known, MET), "taxonomy")
    return taxonomy.with_skills(found, mentions, grown).withColumn("rid", F.col("source")), grown, skipped


def run(spark: SparkSession, csvs: str | None, resumes: str | None, out: str, source_id: str = "file_row", known: DataFrame | None = None, originals: str | None = None) -> DataFrame:
    """Records, profiles, the grown taxonomy and the list of files passed over as Parquet under ``out``; inputs are never touched."""
    own, grown, skipped = records(spark, csvs, resumes, known, source_id, originals)
    skipped.write.mode("overwrite").parquet(f"{out}/skipped")
    sinks.write_records(own, f"{out}/records")
    grown.write.mode("overwrite").parquet(f"{out}/taxonomy")
    stored = spark.read.parquet(f"{out}/records").drop("kind")
    sinks.write_profiles(fuse(with_candidates(stored, membership(stored))), f"{out}/profiles")
    return tables.read_profiles(spark, f"{out}/profiles")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="confluo")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run")
    r.add_argument("--csvs")
    r.add_argument("--resumes")
    r.add_argument("--originals", help="the folder of the files that the resumes were extracted from; their times are the resumes'")
    r.add_argument("--out", required=True)
    r.add_argument("--config", action="append", default=[])
    r.add_argument("--skip-resumes", action="store_true")
    r.add_argument("--taxonomy", help="a JSON file of names and spellings, or of keys and names; skills met for the first time are added to it")
    t = sub.add_parser("taxonomy")
    t.add_argument("--groupings", required=True)
    t.add_argument("--output", required=True)
    j = sub.add_parser("project")
    j.add_argument("--profiles", required=True)
    j.add_argument("--config", required=True)
    j.add_argument("--output")
    j.add_argument("--candidate-id")
    a = p.parse_args(argv)
    try:
        given = getattr(a, "config", [])
        configs = [Config.load(c) for c in (given if isinstance(given, list) else [given])]
    except FileNotFoundError as e:
        print(e, file=sys.stderr)
        return UNREADABLE
    except ProjectionError as e:
        print(e, file=sys.stderr)
        return FAILED
    spark = session()
    try:
        if a.command == "taxonomy":
            taxonomy.save_taxonomy(taxonomy.taxonomy(spark, taxonomy.load_groupings(a.groupings)), a.output)
            return OK
        if a.command == "run":
            known = taxonomy.load_taxonomy(spark, a.taxonomy) if a.taxonomy and Path(a.taxonomy).exists() else None
            profiles = run(spark, a.csvs, None if a.skip_resumes else a.resumes, a.out, known=known, originals=a.originals)
            for bad in spark.read.parquet(f"{a.out}/skipped").orderBy("file").toLocalIterator():
                print(f"skipped {bad['file']}: {bad['reason']}", file=sys.stderr)
            if a.taxonomy:
                taxonomy.save_taxonomy(spark.read.parquet(f"{a.out}/taxonomy"), a.taxonomy)
            for path, config in zip(a.config, configs, strict=True):
                sinks.write_projection(profiles, config, f"{a.out}/{Path(path).stem}.json")
            return OK
        text = sinks.write_projection(tables.read_profiles(spark, a.profiles), configs[0], a.output, a.candidate_id)
        if text:
            sys.stdout.write(text)
        return OK
    except (ProjectionError, PySparkException, Py4JError) as e:
        print(str(e).splitlines()[0], file=sys.stderr)
        return FAILED


if __name__ == "__main__":
    sys.exit(main())
