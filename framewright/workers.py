"""What Python workers need to run this package's functions."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def find_package(spark: SparkSession) -> None:
    """Lets workers find this package where the driver has it, whatever folder the driver was started in.

    Executors on other machines need it installed or sent with ``--py-files``; a
    path that they do not have is passed over.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
