"""Incremental intake of section files: each micro-batch adds what is new, by content.

An extension: the engine has no other streaming operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_sections(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str):
    """A query that appends new JSON section rows of ``source`` to the Parquet table ``target``, each text of a work and reference once.

    A batch that is run again after a failure writes its own folder again instead of adding to it.
    """

    def add(batch: DataFrame, number: int) -> None:
        key = F.sha2(F.concat_ws("\u0001", "work", "cts_ref", "text"), 256)
        new = batch.withColumn("key", key).dropDuplicates(["key"])
        had = _read(spark, target, number)
        if had is not None:
            new = new.join(had.select("key"), "key", "left_anti")
        new.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return spark.readStream.schema(schema).json(source).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _read(spark: SparkSession, target: str, before: int) -> DataFrame | None:
    """Batches before ``before``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    found = [str(s.getPath()) for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=") and int(s.getPath().getName()[6:]) < before]
    return spark.read.parquet(*found) if found else None
