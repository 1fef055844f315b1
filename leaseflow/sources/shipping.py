"""Makes this package importable in Python workers that don't have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources with the application, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    handle, name = tempfile.mkstemp(suffix=".zip", prefix=f"{package.name}-")
    os.close(handle)
    with zipfile.ZipFile(name, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(name)
    # The process that plans stateful operators runs beside the driver and reads no shipped files.
    known = context.environment.get("PYTHONPATH")
    context.environment["PYTHONPATH"] = os.pathsep.join([known, name] if known else [name])
    _shipped.add(context.applicationId)
