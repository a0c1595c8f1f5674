"""Sends this package to the executors, for sessions whose workers can't import it by themselves."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Adds a zip of the package to the session's Python files, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SENT:
        root = Path(__file__).resolve().parents[2]
        zipped = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tendril-')}/tendril", "zip", root, "tendril")
        spark.sparkContext.addPyFile(zipped)
        _SENT.add(app)
