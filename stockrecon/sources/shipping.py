"""Python workers get the package from the driver, wherever the job was started."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import stockrecon

_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the workers, once per application.

    Spark's own file server delivers the archive, so no folder has to be shared.
    """
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(stockrecon.__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    target = os.path.join(tempfile.mkdtemp(prefix="stockrecon-"), "stockrecon.zip")
    with open(target, "wb") as out:
        out.write(buffer.getvalue())
    context.addPyFile(target)
    _sent.add(context.applicationId)
