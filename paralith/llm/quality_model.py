"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network with calibrated probabilities.

Random indexing: each word has a sparse random *index vector* drawn from its hash, and a *context vector*, the sum of the
index vectors of its neighbours in all documents.  Context vectors are rows of a table of fixed size that words reach by
their hash: every word of the corpus counts, words of one row share it, and rows met too seldom stay zero.  A word's vector
is the sum of both, each of length one.  The *shape* of a word (letters and digits as classes, runs shortened) gets an index
vector of its own.  A document is the mean of its words' vectors, beside the mean of its shapes' vectors and three plain ratios.

The network (tanh hidden layer, logistic output) is trained on a bounded sample of labelled rows; its temperature is then set
on a part of the sample that training did not see.  Language, source, ids and labels are never inputs of a score.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from paralith.llm.common import positional, slices

DIM = 32
NONZERO = 4
RATIOS = 3
MOST_WORDS = 300_000
#: A prime, and small enough for row numbers of 16 bits, which sort fastest.
CONTEXT_ROWS = 65_521
WINDOW = 2
#: Words whose neighbours are added to the sums at a time.
HELD_WORDS = 200_000
#: Rows of sums that leave a task at a time.
SENT_ROWS = 8_192


class _Classes(dict):
    """Translation of a character to its class, learned as characters are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return self[code]


_classes = _Classes()
_run = re.compile(r"(.)\1+", re.DOTALL)


def shape_of(word: str) -> str:
    """The word with runs of capitals as A, of other letters as a, of digits as 0 and of one sign as that sign."""
    return _run.sub(r"\1", word.translate(_classes))


def index_signs(hashes: np.ndarray) -> np.ndarray:
    """Vectors with ``NONZERO`` signed ones at places drawn from each 64-bit hash; ones of the same place add up."""
    out = np.zeros((len(hashes), DIM), np.int8)
    x = hashes.astype(np.uint64)
    rows = np.arange(len(hashes))
    for _ in range(NONZERO):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        out[rows, (x % np.uint64(DIM)).astype(np.int64)] += np.where((x >> np.uint64(40)) & np.uint64(1), 1, -1).astype(np.int8)
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float32)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """:func:`index_signs` of length one."""
    return _unit(index_signs(hashes))


def _hashes(words: list[str], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)


@dataclass(frozen=True)
class HashedRows:
    """The row of each word's context vector."""

    rows: int = CONTEXT_ROWS

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes % np.uint64(self.rows)).astype(np.int64)

    def get(self, word: str) -> int:
        return int(self.of(_hashes([word], 1))[0])


class ContextSums:
    """For each row of the context table the sum of its words' neighbours (at most ``WINDOW`` words away) and the number of its words.

    Sums are of whole numbers, so the order and the split of the texts do not matter.
    """

    def __init__(self, contexts: HashedRows):
        self.contexts = contexts
        self.total = np.zeros((contexts.rows + 1, DIM + 1), np.int64)
        self._clear()

    def _clear(self) -> None:
        # Entry 0 stands between texts: it adds nothing, and what it gathers is in a row of its own that is left out.
        self.at: dict[str, int] = defaultdict(count(1).__next__)
        self.rows, self.signs = np.array([self.contexts.rows], np.uint16), np.zeros((1, DIM), np.int8)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, text: str) -> None:
        words = text.split()
        self.held += [np.fromiter(map(self.at.__getitem__, words), np.int32, len(words)), np.zeros(WINDOW, np.int32)]
        self.n_held += len(words)
        if self.n_held >= HELD_WORDS or len(self.at) > MOST_WORDS:
            self._flush()
        if len(self.at) > MOST_WORDS:
            self._clear()

    def _flush(self) -> None:
        if not self.held:
            return
        hashes = _hashes([w.lower() for w in islice(self.at, len(self.rows) - 1, None)], 1)
        self.rows, self.signs = np.concatenate([self.rows, self.contexts.of(hashes).astype(np.uint16)]), np.vstack([self.signs, index_signs(hashes)])
        ids = np.concatenate(self.held)
        self.held, self.n_held = [], 0
        for start in range(0, len(ids), HELD_WORDS):
            self._count(ids, start, min(start + HELD_WORDS, len(ids)))

    def _count(self, ids: np.ndarray, start: int, end: int) -> None:
        """Adds the neighbours of the words from ``start`` to ``end``."""
        first, last = max(0, start - WINDOW), min(len(ids), end + WINDOW)
        signs = self.signs.take(ids[first:last], axis=0)
        near = np.zeros((last - first, DIM), np.int8)  # 2 * WINDOW * NONZERO is the most that a place can hold
        for k in range(1, WINDOW + 1):
            near[k:] += signs[:-k]
            near[:-k] += signs[k:]
        rows = self.rows.take(ids[start:end])
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        at = np.flatnonzero(np.diff(rows.astype(np.int32), prepend=-1))
        self.total[rows[at], :DIM] += np.add.reduceat(near[start - first : end - first].take(order, axis=0), at, axis=0, dtype=np.int32)
        self.total[rows[at], DIM] += np.diff(at, append=len(rows))

    def sums(self) -> np.ndarray:
        """Rows by ``DIM`` sums and the number of words."""
        self._flush()
        return self.total[:-1]


def context_sums(texts: Iterable[str], contexts: HashedRows) -> np.ndarray:
    held = ContextSums(contexts)
    for t in texts:
        held.add(t)
    return held.sums()


def context_matrix(sums: np.ndarray, least: int = 3) -> np.ndarray:
    """Context vectors of length one; zero where fewer than ``least`` words were met."""
    return np.where(sums[:, DIM:] >= least, _unit(sums[:, :DIM].astype(np.float32)), np.float32(0))


def corpus_context_sums(docs: DataFrame, text_col: str, contexts: HashedRows) -> np.ndarray:
    """The sums over the whole texts of all ``docs``: each task adds its own texts and gives a row for each row of the table at most.

    The table's size is fixed, and so is what reaches the driver: ``contexts.rows`` rows whatever the corpus.
    """
    names = [f"s{k}" for k in range(DIM + 1)]
    schema = StructType([StructField("row", IntegerType()), *(StructField(c, LongType()) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = context_sums((t for batch in slices(batches) for t in batch.column(0).to_pylist() if t), contexts)
        met = np.flatnonzero(found[:, DIM])
        for at in range(0, len(met), SENT_ROWS):
            part = met[at : at + SENT_ROWS]
            yield pa.record_batch([pa.array(part.astype(np.int32)), *(pa.array(found[part, k]) for k in range(DIM + 1))], names=schema.names)

    parts = docs.select(F.col(text_col).alias("t")).mapInArrow(run, schema)
    rows = parts.groupBy("row").agg(*(F.sum(c).alias(c) for c in names)).toArrow()
    out = np.zeros((contexts.rows, DIM + 1), np.int64)
    if rows.num_rows:
        out[rows.column("row").to_numpy()] = np.column_stack([rows.column(c).to_numpy() for c in names])
    return out


def _longer(table: np.ndarray, n: int) -> np.ndarray:
    """``table`` with room for ``n`` rows at least."""
    if n <= len(table):
        return table
    out = np.zeros((max(n, 2 * len(table)), *table.shape[1:]), table.dtype)
    out[: len(table)] = table
    return out


class WordVectors:
    """Vectors of words and of their shapes side by side, made as words are met.

    A bounded table holds what they are made of: a word's signs, its row of the context table and its shape's number, and each
    shape's signs, of a byte a place.  The vectors themselves, eight times as large, are made for one document at a time.
    """

    def __init__(self, contexts: HashedRows, matrix: np.ndarray):
        self.contexts, self.matrix = contexts, matrix
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.signs, self.at = np.zeros((1024, DIM), np.int8), np.zeros((1024, 2), np.int32)
        self.shapes: dict[str, int] = {}
        self.shape_signs = np.zeros((1024, DIM), np.int8)

    def _add(self, words: list[str]) -> None:
        hashes = _hashes([w.lower() for w in words], 1)
        shapes = [shape_of(w) for w in words]
        new = list(dict.fromkeys(s for s in shapes if s not in self.shapes))
        n, k = len(self.shapes), len(self.rows)
        self.shapes.update(zip(new, range(n, n + len(new)), strict=True))
        self.shape_signs = _longer(self.shape_signs, n + len(new))
        self.shape_signs[n : n + len(new)] = index_signs(_hashes(new, 2))
        self.rows.update(zip(words, range(k, k + len(words)), strict=True))
        self.signs, self.at = _longer(self.signs, k + len(words)), _longer(self.at, k + len(words))
        self.signs[k : k + len(words)] = index_signs(hashes)
        self.at[k : k + len(words), 0] = self.contexts.of(hashes)
        self.at[k : k + len(words), 1] = [self.shapes[s] for s in shapes]

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        """The vectors of the words of these rows."""
        context, shape = self.at[rows].T
        return np.hstack([_unit(self.signs[rows]) + self.matrix[context], _unit(self.shape_signs[shape])])

    def pooled(self, text: str) -> np.ndarray:
        """The document's vector; of a text without words all zeros."""
        words = text.split()
        n = len(words)
        if not n:
            return np.zeros(2 * DIM + RATIOS, np.float32)
        different = set(words)
        if new := different.difference(self.rows):
            if len(self.rows) + len(new) > MOST_WORDS:
                self._clear()
                new = different
            self._add(list(new))
        at = np.fromiter(map(self.rows.__getitem__, words), np.int64, n)
        same = int((at[1:] == at[:-1]).sum()) / n
        rows, count = np.unique(at, return_counts=True)
        mean = count.astype(np.float32) @ self.vectors(rows) / n
        return np.concatenate([mean, np.array([same, len(different) / n, np.log1p(n) / 10], np.float32)])


@dataclass
class QualityModel:
    contexts: HashedRows
    matrix: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(texts: list[str], labels: list[int], sums: np.ndarray | None = None, hidden: int = 24, epochs: int = 250, seed: int = 7) -> QualityModel:
    """Fit the network and the temperature over the context ``sums`` of a corpus (none: of these texts).

    With no rows or one class only, the score is the smoothed share of label 1.
    """
    contexts = HashedRows(CONTEXT_ROWS if sums is None else len(sums))
    matrix = context_matrix(context_sums(texts, contexts) if sums is None else sums)
    rng = np.random.default_rng(seed)
    width = 2 * DIM + RATIOS
    y = np.array(labels, np.float64)
    model = QualityModel(contexts, matrix, np.zeros(width), np.ones(width), rng.normal(0, 0.2, (width, hidden)), np.zeros(hidden), np.zeros(hidden), 0.0, 1.0)
    share = (y.sum() + 1) / (len(y) + 2)
    model.b2 = float(np.log(share / (1 - share)))
    if len(set(labels)) < 2:
        return model
    vectors = WordVectors(contexts, matrix)
    x = np.array([vectors.pooled(t) for t in texts], np.float64)
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-3
    model.w2 = rng.normal(0, 0.2, hidden)
    order = rng.permutation(len(y))
    fit, rest = np.split(order, [max(1, int(0.8 * len(y)))])
    xs = (x - model.mean) / model.scale
    params = [model.w1, model.b1, model.w2, np.array([model.b2])]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, epochs + 1):
        a, t = xs[fit], y[fit]
        h = np.tanh(a @ params[0] + params[1])
        g = (1 / (1 + np.exp(-(h @ params[2] + params[3]))) - t) / len(t)
        back = np.outer(g, params[2]) * (1 - h * h)
        grads = [a.T @ back + 1e-4 * params[0], back.sum(0), h.T @ g + 1e-4 * params[2], np.array([g.sum()])]
        for p, d, u, v in zip(params, grads, m1, m2, strict=True):
            u += 0.1 * (d - u)
            v += 0.001 * (d * d - v)
            p -= 0.02 * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.b2 = float(params[3][0])
    if len(rest):
        z, t = model.logits(x[rest]), y[rest]
        loss = lambda k: np.mean(np.logaddexp(0, -np.where(t > 0, 1, -1) * z / k))
        model.temperature = float(min(np.geomspace(0.5, 8, 60), key=loss))
    return model


def held_out(doc_id):
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most_rows: int, most_chars: int) -> list:
    """At most ``most_rows`` (text, label) rows, in the order of their ids' hashes, without held-out ids, null labels and texts of over ``most_chars``."""
    ids = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("id").isNotNull())
    ids = ids.where(~held_out(F.col("id"))).distinct().orderBy(F.xxhash64("id"), "id", "y").limit(most_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).where(F.length("t") <= most_chars)
    rows = texts.join(F.broadcast(ids), "id").select("id", "t", "y").distinct().limit(2 * most_rows).collect()  # the broadcast has most_rows rows at most
    return sorted(rows, key=lambda r: (xxhash.xxh64_intdigest(str(r["id"])), r["t"], r["y"]))[:most_rows]


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_rows: int = 3000, most_chars: int = 20_000) -> QualityModel:
    """A model whose context vectors come from all of ``docs`` and whose network is fitted on a bounded sample (``most_rows`` rows of at most
    ``most_chars`` characters) of the labelled rows that are not held out.

    A sample of one class, or none, needs no context vectors: its scores are all alike.
    """
    rows = labelled_sample(docs, labels, id_col, text_col, label_col, most_rows, most_chars)
    sums = corpus_context_sums(docs, text_col, HashedRows()) if len({r["y"] for r in rows}) > 1 else None
    return train([r["t"] for r in rows], [r["y"] for r in rows], sums)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.7) -> DataFrame:
    """The columns of ``docs`` with ``held_out``, ``score`` and ``predicted`` (1 if the score is at least ``accept``), which replace columns of these names.

    Every row gets a score from its whole text; null and empty texts are texts without words.  Repeated rows score alike;
    a null id is not held out; an empty table gives an empty table.
    """
    inner, (doc_id, text) = positional(docs, id_col, text_col)
    new = [StructField("held_out", BooleanType()), StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    shared = inner.sparkSession.sparkContext.broadcast(model)  # CONTEXT_ROWS vectors, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        vectors = WordVectors(m.contexts, m.matrix)
        for batch in slices(batches):
            texts = batch.column(text).to_pylist()
            x = np.array([vectors.pooled(t or "") for t in texts], np.float64).reshape(len(texts), -1)
            score = m.scores(x) if len(texts) else np.zeros(0)
            yield pa.record_batch([*batch.columns, pa.array(score, pa.float64()), pa.array((score >= accept).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    done = inner.mapInArrow(run, StructType([*inner.schema.fields, *new[1:]])).withColumn("held_out", held_out(F.col(doc_id)))
    names = [f.name for f in new]
    return done.select(*(F.col(c).alias(name) for c, name in zip(inner.columns, docs.columns, strict=True) if name not in names), *names)
