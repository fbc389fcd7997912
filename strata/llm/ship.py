"""Send the package to the Python workers, for sessions whose workers do not have it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: add the package as a zip, as ``spark-submit --py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(), "strata_llm.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("strata", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _sent.add(sc.applicationId)
