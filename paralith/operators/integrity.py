"""Checks that an alignment lost, repeated and reordered nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paralith.functions import text as T


def repeated(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    return expected.select(key).distinct().join(found.select(key), key, "left_anti")


def order_violations(rows: DataFrame, by: tuple[str, ...], order: str, index: str) -> DataFrame:
    """Rows whose index is below the one before (``was``); rows without an index are passed over."""
    w = W.partitionBy(*by).orderBy(order)
    return rows.where(F.col(index).isNotNull()).withColumn("was", F.lag(index).over(w)).where(F.col(index) < F.col("was"))


def ordered_hash(rows: DataFrame, by: tuple[str, ...], order: str, text: str, normalised: bool = False) -> DataFrame:
    """hash: SHA-256 over the SHA-256 of the texts in order, a line each."""
    t = T.collapsed(F.col(text)) if normalised else F.col(text)
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.sha2(t, 256).alias("h"))))
    return rows.groupBy(*by).agg(F.sha2(F.array_join(F.transform(listed, lambda x: x.h), "\n"), 256).alias("hash"), F.count("*").alias("n"))


def coverage(source: Column, other: Column, least: int = 4) -> Column:
    """1 - words of ``source`` missing in ``other`` (of ``least`` characters or more) over the words of ``source``; 1 without words."""
    a, b = (F.array_distinct(F.split(F.lower(T.collapsed(x)), " ")) for x in (source, other))
    gone = F.size(F.filter(F.array_except(a, b), lambda w: F.length(w) >= least))
    return F.when(F.size(a) == 0, 1.0).otherwise(1 - gone / F.size(a))


def gate(checks: dict[str, DataFrame]) -> DataFrame:
    """check, failures: one row a check; publishing needs every count to be 0."""
    out = None
    for name, rows in checks.items():
        one = rows.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check"), "failures")
        out = one if out is None else out.unionByName(one)
    return out
