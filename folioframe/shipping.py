"""Make this package importable on executors that don't share the driver's Python path."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors once per application, through Spark's own file service."""
    app = spark.sparkContext.applicationId
    if app not in _sent:
        top = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="folioframe-ship-")) / "folioframe.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, f"{top.name}/{p.relative_to(top)}")
        spark.sparkContext.addPyFile(str(archive))
        _sent.add(app)
    return spark
