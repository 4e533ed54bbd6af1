"""Functions that run in Python workers need this package there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors of this application, once."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(__file__).resolve().parents[1]
    # One small file of source code, read by the driver's own file server.
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _SENT.add(context.applicationId)
