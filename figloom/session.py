"""What a session needs before the library's Python stages run on its executors."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it. Idempotent."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_HOME, *paths])
    return spark


def warehouse(given: str | None = None) -> str:
    """The folder of the store: as given, else from FIGLOOM_WAREHOUSE; raises if neither names one."""
    folder = given or os.environ.get("FIGLOOM_WAREHOUSE")
    if not folder:
        raise ValueError("name a warehouse folder, or set FIGLOOM_WAREHOUSE")
    return folder
