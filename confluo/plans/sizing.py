"""Size checks that stand before every broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side of at most so many rows and bytes is sent to all executors; beyond either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20


def _bytes(f: T.StructField) -> Column:
    """What a column takes in a row, roughly: texts by their bytes, nested values by their text."""
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
    return F.lit(8)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if a count (that stops at the bound) proves that it has at most ``rows`` rows and ``size`` bytes."""
    each = sum((_bytes(f) for f in df.schema), F.lit(0)).cast("long")
    n, taken = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(each), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and taken <= size else df
