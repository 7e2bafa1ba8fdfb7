"""Distributional word vectors: windowed co-occurrence, PPMI, truncated SVD, neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paralith.functions import text as T
from paralith.functions import vectors as V


def token_rows(docs: DataFrame, id_col: str, text_col: str, pattern: str = T.ENGLISH_WORD, stop: DataFrame | None = None) -> DataFrame:
    """doc, pos, word: filtered words in order; positions count the words that stay."""
    words = docs.select(F.col(id_col).alias("doc"), F.posexplode(T.word_sequence(F.col(text_col), pattern)).alias("pos", "word"))
    if stop is None:
        return words
    kept = words.join(stop.select("word"), "word", "left_anti")
    return kept.select("doc", (F.row_number().over(W.partitionBy("doc").orderBy("pos")) - 1).alias("pos"), "word")


def vocabulary(rows: DataFrame, least: int = 5) -> DataFrame:
    return rows.groupBy("word").agg(F.count("*").alias("freq")).where(F.col("freq") >= least)


def window_counts(docs: DataFrame, id_col: str, text_col: str, window: int = 5, least: int = 5, pattern: str = T.ENGLISH_WORD) -> DataFrame:
    """w, c, n: directed counts of words at most ``window`` places apart, both in the vocabulary.

    Neighbours are slices of the document's own word array, so nothing is shuffled before the counts, which are combined
    on the map side.
    """
    words = docs.select(T.word_sequence(F.col(text_col), pattern).alias("ws"))
    known = vocabulary(words.select(F.explode("ws").alias("word")), least).select("word")
    near = words.select("ws", F.posexplode("ws").alias("pos", "w")).select(
        "w", F.explode(F.concat(F.slice("ws", F.greatest(F.col("pos") - window + 1, F.lit(1)), F.least(F.col("pos"), F.lit(window))), F.slice("ws", F.col("pos") + 2, F.lit(window)))).alias("c"))
    counts = near.groupBy("w", "c").agg(F.count("*").alias("n"))
    return counts.join(known.withColumnRenamed("word", "w"), "w").join(known.withColumnRenamed("word", "c"), "c").select("w", "c", "n")


def ppmi(counts: DataFrame) -> DataFrame:
    """w, c, ppmi: positive pointwise mutual information of the counts."""
    row, col = counts.groupBy("w").agg(F.sum("n").alias("n_w")), counts.groupBy("c").agg(F.sum("n").alias("n_c"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    value = F.log(F.col("n").cast("double") * F.col("total") / (F.col("n_w").cast("double") * F.col("n_c")))
    return counts.join(row, "w").join(col, "c").crossJoin(F.broadcast(total)).select("w", "c", value.alias("ppmi")).where("ppmi > 0")


def svd_vectors(cells: DataFrame, dims: int = 200) -> DataFrame:
    """word, vec: unit rows of U * sqrt(S) of the matrix (w, c, ppmi) by a distributed truncated SVD."""
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.linalg.distributed import IndexedRow, IndexedRowMatrix

    words = cells.select("w").distinct().withColumn("i", F.row_number().over(W.orderBy("w")) - 1)  # the vocabulary only
    columns = cells.select("c").distinct().withColumn("j", F.row_number().over(W.orderBy("c")) - 1)
    width = columns.count()
    rows = cells.join(words, "w").join(columns, "c").groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "ppmi"))).alias("cells"))
    matrix = IndexedRowMatrix(rows.rdd.map(lambda r: IndexedRow(r["i"], Vectors.sparse(width, [x["j"] for x in r["cells"]], [x["ppmi"] for x in r["cells"]]))))
    k = min(dims, width, words.count())
    found = matrix.computeSVD(k, computeU=True)
    roots = [float(s) ** 0.5 for s in found.s]
    vectors = found.U.rows.map(lambda r: (r.index, [float(x) * s for x, s in zip(r.vector.toArray(), roots)])).toDF(["i", "raw"])
    size = F.greatest(V.norm(F.col("raw")), F.lit(1e-10))
    return vectors.join(words, "i").select(F.col("w").alias("word"), F.transform("raw", lambda x: x / size).alias("vec"))


def neighbours(vectors: DataFrame, queries: DataFrame, top: int = 7) -> DataFrame:
    """word, neighbour, sim, rank: the ``top`` nearest others of each query word (column word; a short list)."""
    q = queries.join(vectors, "word").select("word", F.col("vec").alias("q"))
    sims = F.broadcast(q).crossJoin(vectors.select(F.col("word").alias("neighbour"), "vec")).where("word <> neighbour").withColumn("sim", V.dot(F.col("q"), F.col("vec")))
    return sims.withColumn("rank", F.row_number().over(W.partitionBy("word").orderBy(F.desc("sim"), "neighbour"))).where(F.col("rank") <= top).select("word", "neighbour", "sim", "rank")


def discriminators(vectors: DataFrame, frequency: DataFrame, first: str, second: str, top: int = 20) -> DataFrame:
    """word, difference: the words whose similarity to two words differs most; with their mean frequency over the median's as ``ratio``."""
    pair = vectors.where(F.col("word").isin(first, second)).agg(F.max_by("vec", F.col("word") == first).alias("a"), F.max_by("vec", F.col("word") == second).alias("b"))
    diff = vectors.where(~F.col("word").isin(first, second)).crossJoin(F.broadcast(pair)).select("word", F.abs(V.dot(F.col("vec"), F.col("a")) - V.dot(F.col("vec"), F.col("b"))).alias("difference"))
    best = diff.orderBy(F.desc("difference"), "word").limit(top)
    median = frequency.agg(F.median("freq").alias("median"))
    mean = best.join(frequency, "word").agg(F.avg("freq").alias("mean"))
    return best.crossJoin(F.broadcast(mean.crossJoin(median).select((F.col("mean") / F.col("median")).alias("ratio"))))
