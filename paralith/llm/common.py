"""Shared helpers of the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; one of our own only where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="paralith-")
        atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
    return _own_dirs[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`shared_root`."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a table in the shared folder and read back: lineage ends here and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positional(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns renamed c0, c1, ... so that no column of the caller clashes with ours, and the new names of ``names``."""
    inner = [f"c{i}" for i in range(len(df.columns))]
    where = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    return df.toDF(*inner), [inner[where[n]] for n in names]


def text_digest(text):
    """Two XXH64 words (seeds 42 and one derived from 1): the identity of a whole text in joins, 128 bits wide."""
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, at most ``rows`` at a time, so that few texts of a batch are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def no_rows(df: DataFrame) -> bool:
    return not df.take(1)
