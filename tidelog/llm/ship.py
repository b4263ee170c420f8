"""Sends this package to the executors, for sessions whose workers do not have it installed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: the package as a zip on the workers' path."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/tidelog", "zip", package.parent, package.name))
    _SENT.add(context.applicationId)
