"""Getting this package to the Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark's driver serve this package to all executors, once an application,
    so that it need not be installed there. Executors that start later fetch it too."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="shelfwise-")) / "shelfwise_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
