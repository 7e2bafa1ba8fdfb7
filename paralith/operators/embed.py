"""Text embeddings behind one interface, with a cache by content.

The built-in embedder hashes character n-grams into signed buckets, which needs no model.  Another embedder is any picklable
object with ``version`` and ``encode(list of texts) -> array``; it is made once a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = "version string, text_hash string, emb array<float>"


@dataclass(frozen=True)
class HashingEmbedder:
    dims: int = 256
    sizes: tuple[int, ...] = (3, 4, 5)

    @property
    def version(self) -> str:
        return f"hash-{self.dims}-{'-'.join(map(str, self.sizes))}"

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dims), np.float32)
        for row, text in zip(out, texts, strict=True):
            t = f" {' '.join(text.lower().split())} "
            h = np.array([xxhash.xxh32_intdigest(t[i : i + n]) for n in self.sizes for i in range(len(t) - n + 1)], np.int64)
            if len(h):
                np.add.at(row, h % self.dims, np.where(h >> 31 & 1, 1, -1))
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-10)


def embed(texts: DataFrame, embedder=None, cache: DataFrame | None = None, column: str = "text", batch: int = 256) -> DataFrame:
    """version, text_hash, emb of the different texts that ``cache`` has not."""
    embedder = embedder or HashingEmbedder()
    rows = texts.select(F.sha2(column, 256).alias("text_hash"), F.col(column).alias("t")).where("t is not null").dropDuplicates(["text_hash"])
    if cache is not None:
        rows = rows.join(cache.where(F.col("version") == embedder.version).select("text_hash"), "text_hash", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                yield pd.DataFrame({"version": embedder.version, "text_hash": part["text_hash"], "emb": list(embedder.encode(part["t"].tolist()))})

    return rows.mapInPandas(run, CACHE)


def with_embeddings(rows: DataFrame, vectors: DataFrame, column: str = "text") -> DataFrame:
    return rows.withColumn("text_hash", F.sha2(column, 256)).join(vectors.select("text_hash", "emb"), "text_hash", "left").drop("text_hash")


def fragmentation(words: DataFrame, encode) -> DataFrame:
    """tokens, words, ratio of a corpus (column text) under a tokenizer: ``encode(text) -> list`` of ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"tokens": [sum(len(encode(t)) for t in pdf["text"])], "words": [sum(len(t.split()) for t in pdf["text"])]})

    return words.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "tokens bigint, words bigint").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).withColumn("ratio", F.col("tokens") / F.nullif("words", F.lit(0)))
