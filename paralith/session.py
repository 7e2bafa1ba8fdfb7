"""Session with the settings that the engine expects; a cluster's own settings are kept."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName("paralith")
    if master:
        builder = builder.master(master)
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for k, v in {**SETTINGS, "spark.executorEnv.PYTHONPATH": here, **more}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
