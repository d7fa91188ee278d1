"""Sends this package to the Python workers, which need not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's sources to the application's executors, once."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    name = f"{tempfile.mkdtemp(prefix='tidemark-')}/{_PACKAGE.name}.zip"
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as file:
        for source in sorted(_PACKAGE.rglob("*.py")):
            file.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(name)
    _sent.add(context.applicationId)
