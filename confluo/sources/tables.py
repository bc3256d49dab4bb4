"""Sources: recruiter CSV files, extracted resumes, positioned text, parsed records, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions import resume
from ..functions.phones import normalize_phones
from ..functions.text import as_list, filled, normalize_emails, normalize_name, strip
from ..operators.lines import anchored_links, grouped_lines
from ..operators.taxonomy import skills_of
from ..plans.sizing import broadcast_if_small
from . import csv_scan, files
from .csv_scan import Scan

CSV_COLUMNS = ("name", "email", "phone", "current_company", "title", "skills")
#: How records of either kind name the way they were made.
CSV_METHOD, RESUME_METHOD = "normalization", "openresume+normalization"
JSON_NAMES = "*.[jJ][sS][oO][nN]"
EPOCH = "1970-01-01T00:00:00Z"


def iso_seconds(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def none_of(kind: T.DataType) -> Column:
    return F.array().cast(kind)


def record(**given: Column) -> list[Column]:
    """The record contract's columns: those given, empty arrays and whole structs of nulls for the others."""

    def default(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.ArrayType):
            return none_of(f.dataType)
        if isinstance(f.dataType, T.StructType):
            return F.struct(*[default(x).alias(x.name) for x in f.dataType])
        return F.lit(None).cast(f.dataType)

    out = []
    for f in schema.RECORD:
        c = given.get(f.name)
        if c is None:
            c = default(f)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.coalesce(c.cast(f.dataType), default(f))
        elif isinstance(f.dataType, T.StructType):
            c = F.coalesce(c.cast(f.dataType), default(f))
        else:
            c = c.cast(f.dataType)
        out.append(c.alias(f.name))
    return out


def scan_csv(spark: SparkSession, folder: str, source_id: str = "file_row") -> Scan:
    """Scan(rows, skipped) of a folder's CSV files: rows have file, row (from 1 in each file), source and procured_at (the file's time); see ``csv_scan``.

    ``source_id``: ``file_row`` tells files apart; ``row`` names rows by number alone, and of
    equal names the last file's counts.
    """
    if source_id not in ("file_row", "row"):
        raise ValueError("source_id must be 'file_row' or 'row'")
    rows, skipped = csv_scan.scan_csv(spark, folder, CSV_COLUMNS)
    label = F.concat(F.lit("csv_"), F.col("row")) if source_id == "row" else F.concat(F.lit("csv_"), F.col("file"), F.lit("_"), F.col("row"))
    rows = rows.select(*CSV_COLUMNS, "file", "row", label.alias("source"), iso_seconds(F.col("time")).alias("procured_at"))
    if source_id == "row":
        last = F.max_by(F.struct(*rows.columns), F.col("file")).alias("r")
        rows = rows.groupBy("source").agg(last).select("r.*")
    return Scan(rows, skipped)


def read_csv(spark: SparkSession, folder: str, source_id: str = "file_row") -> DataFrame:
    """The rows of ``scan_csv``."""
    return scan_csv(spark, folder, source_id).rows


def csv_skills() -> Column:
    """The skills of a CSV row as written: separated by semicolons, without blank ones."""
    return F.filter(F.split(F.coalesce(F.col("skills"), F.lit("")), ";"), lambda s: strip(s) != "")


def resume_skills() -> Column:
    """The skills of an extracted resume as written."""
    sections = F.coalesce(F.col("sections"), F.create_map().cast("map<string,array<string>>"))
    return resume.skill_tokens(resume.section(sections, "TECHNICALSKILLS"))


def csv_mentions(rows: DataFrame) -> DataFrame:
    """(source, kind, file, row, pos, raw) of the skills in CSV rows; kind, file, row and pos are the order in which they are met."""
    return rows.select("source", F.lit(0).alias("kind"), "file", F.col("row").cast("int").alias("row"), F.posexplode(csv_skills()).alias("pos", "raw"))


def resume_mentions(raw: DataFrame) -> DataFrame:
    """Like ``csv_mentions`` for extracted resumes, which come after CSV rows."""
    return raw.select(F.concat(F.lit("resume_"), F.col("source_file")).alias("source"), F.lit(1).alias("kind"), F.col("source_file").alias("file"), F.lit(0).alias("row"), F.posexplode(resume_skills()).alias("pos", "raw"))


def csv_records(rows: DataFrame, skills: dict[str, str] | None = None) -> DataFrame:
    """CSV rows as records. The company is stripped, the title's spacing collapsed.

    Skills are named by ``skills``, if it is given, and left empty otherwise (see ``taxonomy.with_skills``).
    """
    company, title = filled(strip(F.col("current_company"))), normalize_name(F.col("title"))
    position = F.struct(company.alias("company"), title.alias("title"), *[F.lit(None).cast("string").alias(k) for k in ("start", "end", "summary")])
    return rows.select(
        *record(
            source=F.col("source"),
            method=F.lit(CSV_METHOD),
            procured_at=F.col("procured_at"),
            full_name=normalize_name(F.col("name")),
            emails=normalize_emails(as_list(F.col("email"))),
            phones=normalize_phones(as_list(F.col("phone"))),
            skills=None if skills is None else skills_of(csv_skills(), skills, F.col("source")),
            experience=F.when(company.isNotNull() | title.isNotNull(), F.array(position)),
        )
    )


def _documents(spark: SparkSession, folder: str, kind: T.StructType) -> Scan:
    """A folder's JSON documents, one for each file, with ``file``; those that are broken, no objects, or can't be read are skipped. Spark passes empty files over, so these aren't listed."""
    broken = "_broken"
    whole = T.StructType([*kind, T.StructField(broken, T.StringType())])
    own = files.local_folder(spark, folder)
    found, unread = _read_by_tasks(spark, own, whole, broken) if own else _read_by_spark(spark, folder, whole, broken)
    some = F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in kind.names])
    reason = F.when(some, "a JSON document with values of other types").otherwise("not a JSON document")
    bad = found.where(F.col(broken).isNotNull()).select(F.col("path").alias("file"), reason.alias("reason")).distinct()
    unread = unread.select("file", F.lit("holds no document").alias("reason"))
    return Scan(found.where(F.col(broken).isNull()).drop(broken, "path"), bad.unionByName(unread))


def _read_by_spark(spark: SparkSession, folder: str, whole: T.StructType, broken: str) -> tuple[DataFrame, DataFrame]:
    """(documents with file and path, files without one) by Spark's own reader, whose list of files is on the driver."""
    read = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", broken).option("pathGlobFilter", JSON_NAMES).option("ignoreCorruptFiles", True)
    name = F.url_decode(F.regexp_replace("_metadata.file_name", r"\+", "%2B"))
    found = read.schema(whole).json(folder).select("*", name.alias("file"), F.col("_metadata.file_path").alias("path"))
    listed = spark.read.format("binaryFile").option("pathGlobFilter", JSON_NAMES).load(folder).select(F.col("_metadata.file_path").alias("file"), "length")
    read_from = found.select(F.col("path").alias("file"), F.lit(True).alias("read")).distinct()
    return found, listed.join(read_from, "file", "left").where("length = 0 OR read IS NULL")


def _read_by_tasks(spark: SparkSession, folder: str, whole: T.StructType, broken: str) -> tuple[DataFrame, DataFrame]:
    """Like ``_read_by_spark`` for a local folder: an array of objects is a document for each, as there."""
    text, options = F.when(F.col("decoded"), F.col("text")).otherwise(F.concat(F.lit("\ufffd"), "text")), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    alone = F.array(F.from_json(text, whole, options))
    each = F.transform(F.from_json(text, T.ArrayType(T.StringType())), lambda d: F.from_json(d, whole, options))
    objects = F.forall(F.from_json(text, T.ArrayType(T.MapType(T.StringType(), T.StringType()))), lambda d: d.isNotNull())
    wrong = F.slice(F.filter(each, lambda d: d[broken].isNotNull()), 1, 1)
    several = F.when(objects, F.when(F.size(wrong) > 0, wrong).otherwise(each))
    docs = F.when(text.rlike(r"^[ \t\r\n]*\["), F.coalesce(several, alone)).when(text.rlike(r"[^ \t\r\n]"), alone)
    parsed = files.texts(spark, folder, ".json").select(F.col("name").alias("file"), "path", docs.alias("docs"))
    found = parsed.select("file", "path", F.inline("docs")).select(*whole.names, "file", "path")
    return found, parsed.where("coalesce(size(docs), 0) < 1").select(F.col("path").alias("file"))


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(name, text) of a folder's files."""
    own = files.local_folder(spark, folder)
    if own:
        return files.texts(spark, own).select("name", "text")
    return spark.read.option("wholetext", True).text(folder).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def file_times(spark: SparkSession, folder: str) -> DataFrame:
    """(name, time) of a folder's files from their metadata alone: the contents are never read."""
    own = files.local_folder(spark, folder)
    if own:
        return files.times(spark, own).groupBy("name").agg(iso_seconds(F.max("time")).alias("time"))
    listed = spark.read.format("binaryFile").load(folder)
    return listed.groupBy(F.element_at(F.split("path", "/"), -1).alias("name")).agg(iso_seconds(F.max("modificationTime")).alias("time"))


def scan_resumes(spark: SparkSession, folder: str, originals: str | None = None) -> Scan:
    """Scan(rows, skipped) of extracted resumes, one JSON document for each file.

    A document that doesn't say which file it was extracted from (``source_file``) is named
    by its own. ``originals`` is the folder of these files: where it has one of that name, its
    time is the resume's, whatever the document says.
    """
    rows, skipped = _documents(spark, folder, schema.RAW_RESUME)
    rows = rows.withColumn("source_file", F.coalesce("source_file", "file")).drop("file")
    if originals:
        times = broadcast_if_small(file_times(spark, originals)).withColumnRenamed("name", "source_file")
        rows = rows.join(times, "source_file", "left").withColumn("procured_at", F.coalesce("time", "procured_at")).drop("time").select(*schema.RAW_RESUME.names)
    return Scan(rows, skipped)


def read_resumes(spark: SparkSession, folder: str, originals: str | None = None) -> DataFrame:
    """The rows of ``scan_resumes``."""
    return scan_resumes(spark, folder, originals).rows


def resume_records(spark: SparkSession, raw: DataFrame, skills: dict[str, str] | None = None) -> DataFrame:
    """Extracted resumes as records. Without a time of their own they have the epoch; experience is empty; skills as in ``csv_records``."""
    source = F.concat(F.lit("resume_"), F.col("source_file"))
    lines = F.coalesce(F.col("lines"), F.array().cast("array<string>"))
    sections = F.coalesce(F.col("sections"), F.create_map().cast("map<string,array<string>>"))
    school = resume.education(spark, resume.section(sections, "EDUCATION"))
    return raw.select(
        *record(
            source=source,
            method=F.lit(RESUME_METHOD),
            procured_at=F.coalesce("procured_at", F.lit(EPOCH)),
            full_name=normalize_name(F.get(lines, F.lit(0))),
            emails=resume.extract_emails(F.col("raw_text"), F.col("links")),
            phones=resume.extract_phones(F.col("raw_text")),
            location=school["location"],
            links=resume.classify_links(F.col("links")),
            headline=resume.headline(resume.section(sections, "INTRODUCTION")),
            skills=None if skills is None else skills_of(resume_skills(), skills, source),
            education=school["education"],
            projects=resume.projects(resume.section(sections, "PROJECTS")),
        )
    )


def resumes_of_items(items: DataFrame, annotations: DataFrame, by_page: bool = True) -> DataFrame:
    """Extracted resumes from positioned text (doc, page, str, x, y, w, h) and link rectangles (doc, page, url, x1, y1, x2, y2).

    A document's lines are one array in the end: bounded by the file's size.
    """
    each = grouped_lines(items, by_page=by_page).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("all"))
    lines = items.select("doc").distinct().join(each, "doc", "left").select("doc", F.coalesce(F.transform("all", lambda x: x["line"]), F.array().cast("array<string>")).alias("lines"))
    links = anchored_links(items, annotations).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page", "y1", "x1", "url", "anchor"))).alias("links"))
    joined = lines.join(links, "doc", "left")
    none = F.array().cast("array<struct<url:string,anchor:string>>")
    return joined.select(
        F.col("doc").alias("source_file"),
        "lines",
        resume.segment_sections(F.col("lines")).alias("sections"),
        F.coalesce(F.transform("links", lambda x: F.struct(x["url"].alias("url"), x["anchor"].alias("anchor"))), none).alias("links"),
        F.array_join("lines", "\n").alias("raw_text"),
        F.lit(None).cast("string").alias("procured_at"),
    )


def scan_records(spark: SparkSession, folder: str) -> Scan:
    """Scan(rows, skipped) of parsed records, one JSON document for each file, with ``file``; documents without a source are left out."""
    rows, skipped = _documents(spark, folder, schema.RECORD)
    return Scan(rows.where(F.col("source").isNotNull()).select(*record(**{f.name: F.col(f.name) for f in schema.RECORD}), "file"), skipped)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``scan_records``."""
    return scan_records(spark, folder).rows


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.PROFILE).parquet(path)
