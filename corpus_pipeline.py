"""A corpus pipeline: each stage works on what the one before it kept.

Stages take (spark, docs, sf_dir) and give a table with the columns of ``docs``, but for the
last, which adds each text's token ids. What holds for all of them: columns beyond those of
``documents`` come through as they are, whatever their names; texts may be of any length; ids
may be null or repeated, as rows are judged by what they hold; an empty table gives an empty
one. What each does with null and empty texts and with repeated rows is said there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.llm import decontaminate, linededup, oph, quality, sentencepiece, simhash
from confluo.plans.shared import columns_but, settle
from confluo.plans.ship import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base or the learned decision list rejects go.

    Null and empty texts have no words, so they go; repeated rows stay or go alike. Labels of
    documents that aren't there and null labels are passed over; with none, the base alone decides.
    """
    return quality.keep_good(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats of passages are cut and n_chars is counted anew; a document of which no word is left goes.

    The first document by id (null is the smallest) keeps its passage. Near-duplicates (see
    the next stage) count as one document together, so that one of them is still told by its
    whole text there, instead of losing all but its differences here. Null and empty texts
    stay; rows equal in id and text are one document and come out alike.
    """
    removed = columns_but(docs)
    classes = settle(simhash.text_classes(docs, links=oph.similar(docs)), "classes")
    done = linededup.dedup_lines(docs, removed=removed, classes=classes)
    left = done.where((F.size(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    cut = F.size(removed) > 0
    return left.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop(removed)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, that of the smallest id (see ``simhash.drop_near_duplicates``).

    Linked are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or
    more, and those whose SimHash is within 2 bits. Null and empty texts are one group.
    """
    return simhash.drop_near_duplicates(docs, links=oph.similar(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of eight words of a benchmark item go.

    An item of fewer words may stand in any text: its occurrences are cut, and a document goes if no word is left.
    Null and empty texts and items hold no window and stay; repeated rows are treated alike.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    short = F.size(decontaminate.words_of(F.col("text"))) < 8
    clean = decontaminate.decontaminate(docs, items.where(~short))
    few = items.where(short & (F.size(decontaminate.words_of(F.col("text"))) > 0))
    if not few.limit(1).count():
        return clean
    old = columns_but(docs)
    cut = decontaminate.decontaminate(clean.withColumn(old, F.col("text")), few, remove="spans")
    changed = ~F.col("text").eqNullSafe(F.col(old))
    left = cut.where(~changed | (F.size(decontaminate.words_of(F.col("text"))) > 0))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.drop(old)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text's ids (none for a null or empty one), and whether decoding them gives the text back.

    The new columns are ``ids`` and ``round_trip``; columns of docs that have these names are replaced.
    """
    back = columns_but(docs, "ids")
    told = sentencepiece.encode(docs, sentencepiece.Model.load(), into="ids", round_trip=back)
    return told.withColumn("round_trip", F.col(back)).drop(back)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_rules),
    ("lines", line_dedup),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark_decontamination),
    ("tokens", tokens),
]

#: The learned rules, the chunks, the fingerprints and the tokens are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
