"""Sinks: records, profiles and projections."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from .projection import Config, as_json


#: Where each row is a file and Spark writes it: tasks move their files into place themselves, not the driver one by one.
ONE_EACH = {"maxRecordsPerFile": "1", "mapreduce.fileoutputcommitter.algorithm.version": "2"}


def one_each(rows: DataFrame) -> DataFrameWriter:
    """Spark's writer of one file for each row, for what isn't on a local file system."""
    return rows.write.mode("overwrite").options(**ONE_EACH)


def write_records(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Records as Parquet, partitioned by the kind of source (what precedes the underscore)."""
    records.withColumn("kind", F.substring_index("source", "_", 1)).write.mode(mode).partitionBy("kind").parquet(path)


def export_records(records: DataFrame, path: str) -> None:
    """Records as JSON lines."""
    records.write.mode("overwrite").json(path)


def export_documents(records: DataFrame, path: str, nulls: bool = True) -> None:
    """Records as JSON, one document for each file, with ``nulls`` nulls kept: what ``tables.read_records`` reads. A folder that is there is replaced."""
    options, folder = {"ignoreNullFields": str(not nulls).lower()}, files.local(records.sparkSession, path)
    if folder is None:
        one_each(records).options(**options).json(path)
    else:
        files.write_each(records.select(F.to_json(F.struct("*"), options)), folder, ".json")


def export_texts(texts: DataFrame, path: str) -> None:
    """The texts of a table's only column, each a file. A folder that is there is replaced."""
    folder = files.local(texts.sparkSession, path)
    if folder is None:
        one_each(texts).text(path)
    else:
        files.write_each(texts, folder, ".txt")


def write_profiles(profiles: DataFrame, path: str, mode: str = "overwrite") -> None:
    profiles.write.mode(mode).parquet(path)


def delete_profiles(profiles: DataFrame, gone: DataFrame) -> DataFrame:
    """The profiles whose candidate_id isn't in ``gone``; written to a new place, as a table can't replace itself while it is read."""
    return profiles.join(gone.select("candidate_id").distinct(), "candidate_id", "left_anti")


def truncate(spark: SparkSession, path: str, like: DataFrame) -> None:
    spark.createDataFrame([], like.schema).write.mode("overwrite").parquet(path)


def write_projection(profiles: DataFrame, config: Config, path: str | None = None, candidate_id: str | None = None) -> str | None:
    """A JSON array, indented by two, non-ASCII kept, with a final newline; all or nothing.

    Rows reach the driver one partition at a time, in the order of the profiles' smallest
    source. Without a path the text is returned. For large tables see ``write_projection_lines``.
    """
    rows = as_json(profiles, config, candidate_id)
    objects = [json.loads(r["projected"]) for r in rows.toLocalIterator()]
    text = json.dumps(objects, indent=2, ensure_ascii=False) + "\n"
    if path is None:
        return text
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(f"{path}.part", path)
    return None


def write_projection_lines(profiles: DataFrame, config: Config, path: str) -> None:
    """JSON lines, written by the executors."""
    as_json(profiles, config).write.mode("overwrite").text(path)
