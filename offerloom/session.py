"""SparkSession construction with the settings the engine relies on."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

#: UTC keeps timestamps comparable between engines; AQE re-plans skewed and small partitions.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "offerloom", **conf: str) -> SparkSession:
    """A session with CONF; ``conf`` (underscores for dots) overrides single keys."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (CONF | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def share_package(spark: SparkSession) -> SparkSession:
    """Let Python workers that start from now on import this package from where the driver has it.

    For a cluster whose machines don't share that folder, submit with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = [str(Path(__file__).parents[1]), *environment.get("PYTHONPATH", "").split(os.pathsep)]
    environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(p for p in paths if p))
    return spark
