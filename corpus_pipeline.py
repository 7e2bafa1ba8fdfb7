"""A corpus pipeline of five stages: what each keeps is the next one's documents.

Every stage but the last returns the columns of its documents as they were given, columns of the same names as an operator's
own results included.  Null texts are empty texts; repeated rows are rows of their own up to ``near_duplicates``, which keeps
one row of them; an empty table stays one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paralith.llm import decontam, line_dedup, pieces, quality_model, simhash
from paralith.llm.common import positional, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, accepts.  Null and empty texts are scored like others."""
    model = quality_model.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    inner, (doc_id, text) = positional(docs, "doc_id", "text")
    scored = quality_model.score_quality(inner, model, doc_id, text)
    return scored.where("predicted = 1").select(*inner.columns).toDF(*docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines found in ten or more of them; n_chars follows the text.  A null text becomes the empty text; no document goes."""
    inner, (text, n_chars) = positional(docs, "text", "n_chars")
    cut = line_dedup.dedup_lines(inner, text, threshold=10, min_chars=1)
    return cut.withColumn(n_chars, F.length(text).cast(docs.schema["n_chars"].dataType)).select(*inner.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id.  Null and empty texts are one group."""
    return simhash.keep_one_of_each_group(docs, words_each=4, most=4, seed=42)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item: one window is enough to drop a document.  Null and empty texts hold none."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=8, least_items=1)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, as digests.  Null and empty texts have the begin and the end id."""
    return pieces.encode_pieces(docs.select("doc_id", "text")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", drop_common_lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", encode),
]

#: The classifier, the fingerprints and the encoding are beyond SQL; a plain Python version is compared in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
