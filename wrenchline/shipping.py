"""Make this package importable on executors, whatever folder the driver runs in."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    if os.path.isdir(package):  # else this already is the shipped archive
        archive = os.path.join(tempfile.mkdtemp(prefix="wrenchline-"), "wrenchline.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in sorted(os.walk(package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, root))
        context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
