"""Quality rules: plain counts of a document, and a hashed n-gram log-likelihood ratio between trusted texts and the raw corpus.

Words and word pairs are hashed into ``BUCKETS`` counts, once over all documents (raw) and once over the trusted ones (target).
Both multinomials are smoothed, the target towards the raw one.  A document's value is the mean over its features of
log(target / raw), so long and short documents compare; at or above a fixed threshold a document is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from paralith.llm.common import positional, written

BUCKETS = 1 << 14
THRESHOLD = -0.35
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MOST_TOKENS = 400_000
MOST_IDS = 2_000_000
_token = re.compile(r"\w+|[^\w\s]+")
_hashes: dict[str, bytes] = {}


def _word_features(word: str) -> bytes:
    """The 32-bit hashes of a word's tokens end to end."""
    return b"".join(map(xxhash.xxh32_digest, _token.findall(word)))


def features(text: str) -> np.ndarray:
    """Buckets of the tokens (runs of word characters, runs of signs) and of the pairs of neighbours.

    White space ends tokens, so the tokens of each different word are hashed once and kept in a bounded table.
    """
    words = text.split()
    try:
        raw = b"".join(map(_hashes.__getitem__, words))
    except KeyError:
        new = [w for w in dict.fromkeys(words) if w not in _hashes]
        if len(_hashes) + len(new) > MOST_TOKENS:
            _hashes.clear()
            new = list(dict.fromkeys(words))
        _hashes.update((w, _word_features(w)) for w in new)
        raw = b"".join(map(_hashes.__getitem__, words))
    h = np.frombuffer(raw, "<u4").astype(np.uint64)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)
    return np.concatenate([h, pairs]).astype(np.int64) & (BUCKETS - 1)


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words found twice or more in the text, the first occurrence included; exact.

    Equal windows have equal hashes, so a text whose window hashes all differ has none.  Otherwise windows are compared by
    rank: words get ranks, pairs of neighbouring ranks get ranks, and so on up to the window.
    """
    n = len(words)
    if n <= window:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    rank = np.fromiter(map(number.__getitem__, words), np.int64, n)
    mixed = (rank.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(n - window + 1, np.uint64)
    for k in range(window):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + (mixed[k : n - window + 1 + k] ^ (mixed[k : n - window + 1 + k] >> np.uint64(31)))
    rolled.sort()
    if not (rolled[1:] == rolled[:-1]).any():
        return 0
    span = 1
    while span < window:
        step = min(span, window - span)
        pair = rank[:-step] * np.int64(n + 1) + rank[step:]
        span += step
        rank, count = np.unique(pair, return_inverse=True, return_counts=True)[1:]
    often = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(count[rank] > 1)
    np.add.at(often, starts, 1)
    np.add.at(often, starts + window, -1)
    return int((np.cumsum(often)[:n] > 0).sum())


SPACE = " \t\n\x0b\x0c\r"


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; words end at ASCII white space only."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def ngram_counts(docs: DataFrame, trusted_col: str, text_col: str) -> DataFrame:
    """bucket, raw, target: counts over all rows and over those where ``trusted_col`` is true; ``BUCKETS`` rows at most."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for t, good in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t:
                    n = np.bincount(features(t), minlength=BUCKETS)
                    raw += n
                    if good:
                        target += n
        at = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    counted = docs.select(F.col(text_col).alias("t"), F.col(trusted_col).alias("good")).mapInArrow(tally, "bucket bigint, raw bigint, target bigint")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log(target / raw) of each bucket.  The target is smoothed towards the raw corpus by one count a bucket on average; without trusted rows all are 0."""
    p = (raw + 0.5) / (raw.sum() + 0.5 * len(raw))
    strength = len(raw)
    return np.log((target + strength * p) / (target.sum() + strength)) - np.log(p)


def quality_rules(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Counts, verdict of the rules and verdict of the ratio for every row of ``docs``.

    ``trusted``: a table of ids (column ``id_col``) whose documents are the target.  The columns of ``docs`` come back, then
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (under 20 words, or over 30 % of the words in
    repeated windows), llr and kept; these replace columns of the same names.  kept is false if base_failed, else
    llr >= ``threshold``.  Null texts have no words; a document without features has llr 0.  Repeated rows are documents of their
    own with equal results; trusted ids that repeat count once, null ones not at all.  An empty table gives an empty table.
    """
    inner, (doc_id, text) = positional(docs, id_col, text_col)
    good = written(trusted.select(F.col(id_col).alias("good_id")).where("good_id is not null").distinct(), "trusted")
    few = good.count() <= MOST_IDS  # ids alone are sent to the tasks, and only so many; beyond, texts are joined by their ids
    marked = inner.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    both = marked.join(F.broadcast(good) if few else good, F.col("id") == F.col("good_id"), "left").withColumn("good", F.col("good_id").isNotNull())
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for r in ngram_counts(both, "good", "t").collect():  # BUCKETS rows at most
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    ratio = log_ratios(raw, target)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    new = [*(StructField(n, LongType()) for n in names), StructField("base_failed", BooleanType()), StructField("llr", DoubleType()), StructField("kept", BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(text).to_pylist():
                t = t or ""
                counts = base_counts(t)
                failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
                f = features(t)
                llr = float(ratio[f].mean()) if len(f) else 0.0
                rows.append((*counts, failed, llr, not failed and llr >= threshold))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in new]
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.record_batch([*batch.columns, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[*batch.schema.names, *(f.name for f in new)])

    done = inner.mapInArrow(run, StructType([*inner.schema.fields, *new]))
    taken = [f.name for f in new]
    return done.select(*(F.col(c).alias(name) for c, name in zip(inner.columns, docs.columns, strict=True) if name not in taken), *taken)
