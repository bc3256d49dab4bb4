"""Where intermediate tables live: a folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a folder given to ``setCheckpointDir`` serves; a session
    in local mode gets a temporary one. On a cluster a machine-local folder would lose
    data with its machine, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="confluo-"))
    return shared_dir(spark)


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


#: Has Spark delete a statement's shuffle files when it ends, instead of when the driver's collector meets its plan.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write df to the shared folder (or to ``path``) and read it back: lineage ends here, a lost executor costs nothing.

    The shuffle files of the plan that made it go at once. The table is deleted by
    ``discard``, which a step calls for what its successor no longer reads, by ``sweep``,
    or when the driver's Python ends.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._settled_at = path
    return table


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``settle`` made and nothing reads any more."""
    for t in tables:
        path = t._settled_at
        _delete(t.sparkSession, path)
        _written[:] = [x for x in _written if x[1] != path]


def sweep() -> None:
    """Delete every table that ``settle`` and ``new_path`` made in this process."""
    while _written:
        spark, path = _written.pop()
        try:
            _delete(spark, path)
        except Exception:  # the session has ended; its folder goes with it
            continue


atexit.register(sweep)


def columns_but(df: DataFrame, *taken: str) -> str:
    """A column-name prefix that clashes with no column of df nor with ``taken``."""
    names = {c.lower() for c in [*df.columns, *taken]}
    prefix = "_c"
    while any(n.startswith(prefix) for n in names):
        prefix = "_" + prefix
    return prefix


def map_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(f, schema)`` for columns of any names, dots in them too: they are numbered on the way, and f sees and gives the real ones."""
    given, own = list(df.columns), [f"c{k}" for k in range(len(schema))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in f(x.rename_columns(given) for x in batches):
            yield b.rename_columns(own)

    numbered = T.StructType([T.StructField(c, x.dataType, x.nullable) for c, x in zip(own, schema, strict=True)])
    return df.toDF(*[f"c{k}" for k in range(len(given))]).mapInArrow(run, numbered).toDF(*schema.names)
