"""Quality figures of scored records, runs of low scores, and comparison with earlier figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HIGH, LOW = 0.5, 0.2
REPORT_HIGH, REPORT_LOW = 0.6, 0.3


def _figures(high: float, low: float, score: Column) -> list[Column]:
    n = F.count("*")
    return [
        n.alias("n"), F.count_if(score >= high).alias("high"), F.count_if((score < high) & (score >= low)).alias("med"), F.count_if(score < low).alias("low"),
        F.round(100.0 * F.count_if(score >= high) / n, 1).alias("high_pct"), F.round(100.0 * F.count_if(score < low) / n, 1).alias("low_pct"),
        F.round(F.avg(score), 6).alias("avg"), F.min(score).alias("min"), F.max(score).alias("max"),
    ]


def by_book(records: DataFrame, by: tuple[str, ...] = ("work", "book"), score: str = "score", high: float = HIGH, low: float = LOW) -> DataFrame:
    return records.groupBy(*by).agg(*_figures(high, low, F.col(score)))


def with_totals(records: DataFrame, by: tuple[str, ...] = ("work", "book"), score: str = "score") -> DataFrame:
    """Figures of books, of works (book is null) and of all (both are null), in one pass."""
    return records.rollup(*by).agg(*_figures(HIGH, LOW, F.col(score)))


def report_bands(records: DataFrame, by: tuple[str, ...], score: str = "score") -> DataFrame:
    return records.groupBy(*by).agg(*_figures(REPORT_HIGH, REPORT_LOW, F.col(score)))


def low_runs(records: DataFrame, by: tuple[str, ...], order: str, score: str = "score", low: float = LOW, least: int = 3) -> DataFrame:
    """first, last, n, avg of the maximal runs of at least ``least`` rows in order whose scores are under ``low``."""
    w = W.partitionBy(*by).orderBy(order)
    rows = records.select(*by, order, F.col(score).alias("s")).withColumn("at", F.row_number().over(w)).where(F.col("s") < low)
    rows = rows.withColumn("island", F.col("at") - F.row_number().over(w))
    runs = rows.groupBy(*by, "island").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n"), F.avg("s").alias("avg"))
    return runs.where(F.col("n") >= least).drop("island")


def regressions(new: DataFrame, old: DataFrame, by: tuple[str, ...] = ("work",), high_drop: float = 5.0, low_rise: float = 5.0, avg_drop: float = 0.05) -> DataFrame:
    """Works whose share of high scores or average fell, or whose share of low ones rose, by more than the limits."""
    both = new.join(old.select(*by, *(F.col(c).alias(f"old_{c}") for c in ("high_pct", "low_pct", "avg"))), list(by))
    worse = (F.col("old_high_pct") - F.col("high_pct") > high_drop) | (F.col("low_pct") - F.col("old_low_pct") > low_rise) | (F.col("old_avg") - F.col("avg") > avg_drop)
    return both.where(worse).select(*by, *(c for x in ("high_pct", "low_pct", "avg") for c in (x, f"old_{x}")))


def quadrants(pairs: DataFrame, metrics: list[str], reference: str, limit: float = 0.5) -> DataFrame:
    """metric and the counts of pairs above or below ``limit`` in it and in ``reference``; one pass for all metrics."""
    long = pairs.select(reference, F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics))))
    a, b = F.col("value") >= limit, F.col(reference) >= limit
    return long.groupBy("metric").agg(F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("metric_only"), F.count_if(~a & b).alias("reference_only"), F.count_if(~a & ~b).alias("neither"), F.percentile("value", F.array(*map(F.lit, (0.25, 0.5, 0.75, 0.95)))).alias("percentiles"))
