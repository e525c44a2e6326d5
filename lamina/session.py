"""Session settings that the operators assume."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "lamina", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS, and whatever else is given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, for a driver that runs it from a folder they don't have."""
    root = os.path.dirname(os.path.abspath(__file__))
    handle, path = tempfile.mkstemp(prefix="lamina-", suffix=".zip")
    with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w") as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    packed.write(whole, os.path.relpath(whole, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)  # Spark serves it; executors read no path of the driver's
