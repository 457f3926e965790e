"""The package on the executors' import path, whatever folder the driver runs in."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import casemill

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the running application a copy of this package, once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(casemill.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="casemill-"), "casemill.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("casemill", os.path.relpath(path, root)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)
