"""Make the package importable in Python workers on other machines."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent


def ship_package(spark: SparkSession) -> None:
    """Send the package's own sources to the executors, once for each SparkContext."""
    context = spark.sparkContext
    if getattr(context, "_dialoom_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="spark-dialoom-")) / "dialoom_sources.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent).as_posix())
    context.addPyFile(str(target))
    context._dialoom_shipped = True
