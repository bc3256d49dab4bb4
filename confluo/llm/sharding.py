"""Contiguous shards of near equal byte size from global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import settle


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition's number, and the bytes and rows before each row within it."""
    part, size_before, rows_before = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        size = b.column("size").to_numpy()
        upto = np.cumsum(size)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": b.column("doc_id"),
                "size": b.column("size"),
                "text_crc32": b.column("text_crc32"),
                "part": pa.array(np.full(len(size), part, np.int32)),
                "size_before": pa.array(size_before + upto - size),
                "row": pa.array(rows_before + np.arange(len(size))),
            }
        )
        if len(size):
            size_before, rows_before = size_before + int(upto[-1]), rows_before + len(size)


def shard_by_bytes(docs: DataFrame, n_shards: int = 24, overhead: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deals all rows, ordered by id, into ``n_shards`` contiguous shards of near equal bytes.

    A row weighs its text's UTF-8 bytes plus ``overhead``. One range exchange of narrow
    rows orders the table; each partition counts its own running sums; the partitions'
    totals (one row each) give the global offsets, and a row goes to the shard in whose
    equal share of all bytes its middle byte lies. So a shard's size is off the equal
    share by less than one row's size at each end.

    Returns doc_id, size, text_crc32, shard, slot; slot counts from 0 in each shard
    without gaps. Null text: size is the overhead alone and the checksum is null. Null
    ids come first. Rows with equal ids are ordered by checksum and size, and rows equal
    in these too stay in input order; each keeps a place of its own. An empty table gives
    no rows. Further columns are ignored, whatever their names.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    text = F.col(text_col)
    order = ["doc_id", "text_crc32", "size", "tie"]
    # Range partitioning reads its input twice; texts are read once, for this table.
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    ids = narrow.schema["doc_id"].dataType.simpleString()
    ordered = settle(narrow, "narrow").repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    placed = settle(ordered.mapInArrow(_running, f"doc_id {ids}, size long, text_crc32 long, part int, size_before long, row long"), "sharding")

    # One row for each partition: small by construction, and so sent to all.
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    offsets, at, rows = [], 0, 0
    for t in sorted(totals):
        offsets.append((t["part"], at, rows))
        at, rows = at + t["bytes"], rows + t["rows"]
    spark = docs.sparkSession
    offset = F.broadcast(spark.createDataFrame(offsets, "part int, part_at long, part_row long"))
    middle: Column = 2 * (F.col("part_at") + F.col("size_before")) + F.col("size")
    shard = F.floor(middle.cast("decimal(38,0)") * n_shards / F.lit(max(2 * at, 1)).cast("decimal(38,0)")).cast("int")
    dealt = placed.join(offset, "part").select(
        "doc_id", "size", "text_crc32", F.least(shard, F.lit(n_shards - 1)).alias("shard"), (F.col("part_row") + F.col("row")).alias("place")
    )
    first = F.broadcast(dealt.groupBy("shard").agg(F.min("place").alias("first")))  # n_shards rows at most
    return dealt.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
