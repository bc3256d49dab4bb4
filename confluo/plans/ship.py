"""Send this package to the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Zip the package on the driver and hand it to Spark's own file distribution, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    _sent.add(app)
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="confluo-")) / "confluo.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
