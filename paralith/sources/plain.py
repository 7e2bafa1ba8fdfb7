"""Plain text, JSON, JSONL and CSV sources, and frames made of several of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SECTION = """book string, section string, cts_ref string, edition string, work string, work_id string, chapter string, text string, text_for_embedding string,
notes array<struct<marker:string,text:string>>, char_count int, is_heading boolean, heading_text string, split_from string, speakers array<string>, speaker string, title string, head string"""
ALIGNMENT = """book string, greek_cts_ref string, greek_edition string, english_cts_ref string, english_section string, similarity double, greek_preview string, english_preview string,
english_refined_text string, refined_part int, group_id int, group_size_gr int, group_size_en int, match_type string, runner_up_similarity double, english_title string, combined_score double"""
CATALOGUE = ("volume", "author", "title", "language", "source_text", "translation", "tlg_id", "notes")


def gutenberg_body(text: Column) -> Column:
    """The text between the start and the end line of a book file, line ends as newlines; all of it without such lines."""
    plain = F.regexp_replace(F.regexp_replace(text, "^﻿", ""), "\r\n?", "\n")
    begun = F.regexp_replace(plain, r"(?s)^.*?\*\*\* ?START OF[^\n]*(?:\n|$)", "")
    return F.regexp_replace(begun, r"(?s)\*\*\* ?END OF.*$", "")


def books(spark: SparkSession, path: str) -> DataFrame:
    """path, text: the bodies of whole text files."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), gutenberg_body(F.col("value")).alias("text"))


def blocks(text: Column, blank_lines: int = 1, least: int = 0) -> Column:
    """Stretches between at least ``blank_lines`` blank lines, trimmed, of at least ``least`` characters."""
    cut = F.transform(F.split(text, rf"\n(?:[ \t]*\n){{{blank_lines},}}"), lambda b: F.regexp_replace(b, r"^\s+|\s+$", ""))
    return F.filter(cut, lambda b: (b != "") & (F.length(b) >= least))


def headed_lines(books_: DataFrame, heading: str, text: str = "text") -> DataFrame:
    """path, part, label, ord, line: lines numbered by the heading lines (pattern with one group, the label) before them; part 0 is the front matter."""
    rows = books_.select("path", F.posexplode(F.split(text, "\n")).alias("ord", "line"))
    rows = rows.withColumn("label_", F.nullif(F.regexp_extract("line", heading, 1), F.lit("")))
    w = W.partitionBy("path").orderBy("ord").rowsBetween(W.unboundedPreceding, 0)
    out = rows.withColumns({"part": F.count("label_").over(w), "label": F.last("label_", ignorenulls=True).over(w)})
    return out.where("label_ is null").select("path", "part", "label", "ord", "line")


def headed_sections(books_: DataFrame, heading: str, text: str = "text") -> DataFrame:
    """path, part, label, text: the lines under each heading."""
    lines = headed_lines(books_, heading, text)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x.line), "\n")
    return lines.groupBy("path", "part", "label").agg(F.regexp_replace(listed, r"^\s+|\s+$", "").alias("text")).where("text <> ''")


def json_sections(spark: SparkSession, path: str, schema: str = SECTION, key: str = "sections") -> DataFrame:
    """Rows of JSON files that hold a list, or an object with the list under ``key``; with their path and ``ord``."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    wrapped = F.from_json("value", f"struct<{key}:array<struct<{_struct(schema)}>>>")[key]
    bare = F.from_json("value", f"array<struct<{_struct(schema)}>>")
    rows = F.when(F.ltrim("value").startswith("["), bare).otherwise(wrapped)
    return raw.select("path", F.posexplode(rows).alias("ord", "x")).select("path", "ord", "x.*")


def _struct(schema: str) -> str:
    import re

    return ", ".join(re.sub(r"^(\w+)\s+", r"\1:", c.strip()) for c in re.split(r",(?![^<]*>)", schema))


def alignments(spark: SparkSession, path: str) -> DataFrame:
    return json_sections(spark, path, ALIGNMENT, "alignments")


def configurations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def concordance_map(spark: SparkSession, path: str) -> DataFrame:
    """source_section, target_section of a JSON object."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("source_section", "target_section"))


def pairs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines."""
    return spark.read.schema(schema).json(path)


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Volumes of a catalogue with quoted fields."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path).toDF(*CATALOGUE)


def aligned_pairs(records: DataFrame, source: DataFrame, target: DataFrame, least: float = 0.2) -> DataFrame:
    """Texts of records with a score of at least ``least`` and both texts; records have src_ref, tgt_ref and combined, sections ref and text."""
    s, t = (x.select(F.col("ref").alias(f"{n}_ref"), F.col("text").alias(n)) for n, x in (("src", source), ("tgt", target)))
    both = records.where(F.col("combined") >= least).join(s, "src_ref").join(t, "tgt_ref")
    return both.where("src <> '' and tgt <> ''").select("src_ref", "tgt_ref", F.col("src").alias("source"), F.col("tgt").alias("target"))


def monolingual(parts: dict[str, DataFrame], least: int = 30) -> DataFrame:
    """source, text: texts of over ``least`` characters of several collections."""
    out = None
    for name, df in parts.items():
        one = df.where(F.length("text") > least).select(F.lit(name).alias("source"), "text")
        out = one if out is None else out.unionByName(one)
    return out


def length_filtered(rows: DataFrame, first: str, second: str, least: int = 20, most: tuple[int, int] = (2000, 2000)) -> DataFrame:
    return rows.where(F.length(first).between(least, most[0]) & F.length(second).between(least, most[1]))


def seeded_split(rows: DataFrame, key: str, share: float = 0.9, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Two parts by the hash of a key: the same rows whatever the partitioning."""
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(10_000))
    return rows.where(place < int(share * 10_000)), rows.where(place >= int(share * 10_000))


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of their keys' hashes."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)
