"""Getting the package to workers that don't have it installed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> str:
    """Zip the package on the driver and let Spark's file server hand it to every worker; returns the zip's path.

    Functions that run in workers are pickled by name, so a worker that cannot import the package fails. Call this once
    a session, or install the package on the workers, or put it on their PYTHONPATH."""
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="cuefold-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/{root.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, f"{root.name}/{file.relative_to(root).as_posix()}")
    spark.sparkContext.addPyFile(path)
    return path
