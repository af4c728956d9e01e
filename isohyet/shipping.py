"""The package's code for executors that don't have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))


def ship(spark: SparkSession) -> None:
    """Adds the package to what Spark sends to its Python workers, once for each application."""
    sc = spark.sparkContext
    if getattr(sc, "_isohyet_shipped", False) or not os.path.isdir(HERE):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="isohyet-code-"), "isohyet.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(HERE):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(HERE)))
    sc.addPyFile(path)
    sc._isohyet_shipped = True
