"""Gives executors the modules that tasks of this subpackage import."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the application as a Python file, once; Spark serves it to executors."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="vigilframe-py-")) / "vigilframe_modules.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
