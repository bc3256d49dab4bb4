"""Records as a stream: each micro-batch is merged into the identities it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema
from ..operators.identity import merge_increment
from ..operators.survivorship import fuse


class IdentityStore:
    """Records and their components in a folder that outlives the driver.

    Records are appended, one subfolder for each batch; components are replaced by a new
    version. A batch counts once its number is in the folder ``done``, which is written last:
    what an interrupted batch left is passed over and written anew when the stream replays
    it. A batch that is done is skipped, and a record that comes twice (by ``rid``) counts once.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("done").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def done(self) -> list[int]:
        """The numbers of the batches that count, in order."""
        files, folder = self._files(), self._path("done")
        if not files.exists(folder):
            return []
        return sorted(int(f.getPath().getName()) for f in files.listStatus(folder))

    @property
    def records(self) -> DataFrame | None:
        known = self.done()
        return self.spark.read.parquet(*[f"{self.folder}/records/{k}" for k in known]) if known else None

    @property
    def components(self) -> DataFrame | None:
        known = self.done()
        return self.spark.read.parquet(f"{self.folder}/components/{known[-1]}") if known else None

    def add(self, batch: DataFrame, number: int | None = None) -> None:
        known = self.done()
        number = (known[-1] + 1 if known else 0) if number is None else number
        if number in known:
            return
        old, components = self.records, self.components
        fresh = batch.dropDuplicates(["rid"])
        if old is not None:
            fresh = fresh.join(old.select("rid"), "rid", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{self.folder}/records/{number}")
        fresh = self.spark.read.schema(fresh.schema).parquet(f"{self.folder}/records/{number}")
        if components is None:
            components = fresh.limit(0).select("rid", F.col("rid").alias("component"))
        every = fresh if old is None else old.unionByName(fresh)
        merge_increment(components, fresh, every).write.mode("overwrite").parquet(f"{self.folder}/components/{number}")
        self._files().create(self._path(f"done/{number}")).close()
        for k in known[:-1]:  # the version before stays for its readers
            self._files().delete(self._path(f"components/{k}"), True)

    def profiles(self) -> DataFrame:
        members = self.records.join(self.components, "rid").withColumn("candidate_id", F.sha2(F.col("component").cast("string"), 256))
        return fuse(members)


def follow(store: IdentityStore, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
    """Starts a query that adds every micro-batch of ``stream`` (record contract and rid) to the store."""
    return stream.writeStream.foreachBatch(lambda batch, k: store.add(batch, k)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def record_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of parsed-record Parquet files; rid is the source, which names a record."""
    return spark.readStream.schema(schema.RECORD).parquet(folder).withColumn("rid", F.col("source"))
