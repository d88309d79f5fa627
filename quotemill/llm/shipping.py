"""The package on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's sources to the executors, once an application, and return the session.

    Spark copies the archive from the driver to every executor that runs a task; nothing
    has to be installed there but the libraries.
    """
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        folder = Path(tempfile.mkdtemp(prefix="quotemill-"))
        archive = folder / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(application)
    return spark
