"""String similarity beyond the built-in functions: plain Python, and Arrow-batched functions of columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

#: Type objects, as workers import this module where no session can read DDL.
RUN = StructType([StructField(c, IntegerType()) for c in ("length", "at_first", "at_second")])


def common_subsequence(a, b) -> int:
    """The length of the longest common subsequence of two sequences."""
    row = [0] * (len(b) + 1)
    for x in a:
        above = 0
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], above + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def common_substring(a: str, b: str) -> tuple[int, int, int]:
    """Length and places of the longest common run, the first in order of ``a`` and then ``b``."""
    best = (0, 0, 0)
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [0] * (len(b) + 1)
        for j, y in enumerate(b, 1):
            if x == y:
                new[j] = row[j - 1] + 1
                if new[j] > best[0]:
                    best = (new[j], i - new[j], j - new[j])
        row = new
    return best


def ratio(a: str, b: str) -> float:
    """Indel similarity in percent: twice the common subsequence over both lengths; 100 for two empty strings."""
    return 200.0 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """The best :func:`ratio` of the shorter string with a window of the longer, shorter windows at both ends included."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0
    n, m = len(short), len(long)
    ends = [(0, k) for k in range(1, n)] + [(i, i + n) for i in range(m - n + 1)] + [(i, m) for i in range(m - n + 1, m)]
    best = max(ratio(short, long[i:j]) for i, j in ends)
    return max(best, max(ratio(long, short[i:j]) for i, j in [(0, k) for k in range(1, m)] + [(i, m) for i in range(1, m)]) if n == m and n > 1 else 0.0)


def sequence_score(a, b) -> float:
    """Twice the common subsequence over both lengths; 0 if both are empty."""
    return 2 * common_subsequence(a, b) / (len(a) + len(b)) if len(a) + len(b) else 0.0


@pandas_udf(RUN)
def common_substring_of(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    found = [common_substring(x or "", y or "") for x, y in zip(a, b, strict=True)]
    return pd.DataFrame(found, columns=["length", "at_first", "at_second"], dtype="int32")


@pandas_udf(DoubleType())
def partial_ratio_of(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([partial_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


@pandas_udf(DoubleType())
def ratio_of(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


@pandas_udf(DoubleType())
def common_subsequence_ratio_of(a: pd.Series, b: pd.Series) -> pd.Series:
    """The longest common subsequence over the shorter length; 0 if one is empty."""
    return pd.Series([common_subsequence(x, y) / min(len(x), len(y)) if x and y else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")


@pandas_udf(DoubleType())
def sequence_score_of(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([sequence_score(list(x) if x is not None else [], list(y) if y is not None else []) for x, y in zip(a, b, strict=True)], dtype="float64")
