"""Make this package importable in Python workers.

A function handed to ``mapInPandas`` and the like is sent as a reference to its
module, so every worker must be able to import the package, whatever folder the
driver was started from.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, once per application.

    The archive is written on the driver; Spark copies it to every executor,
    also to those that start later.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tamiz-package-")
    archive = os.path.join(folder, "tamiz_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(Path(package.name) / file.relative_to(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
