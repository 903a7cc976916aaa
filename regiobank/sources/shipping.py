"""Make the package importable for Python workers, wherever the driver was started."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to every executor, once per application.

    Spark fetches the archive from the driver, so workers need no shared code folder.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root, name = os.path.split(PACKAGE)
    folder = tempfile.mkdtemp(prefix="package-")
    archive = os.path.join(folder, f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for place, _, files in os.walk(PACKAGE):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(place, file)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
