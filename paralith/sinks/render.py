"""Sinks and reports: TEI, TSV, CSV, JSON, HTML, heat maps, publishing behind a gate.

Rows are rendered to strings by expressions, so files are written by Spark's own writers; a book is one row of text only where a
format needs it whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paralith.functions.text import escaped, with_notes


def ordered(rows: DataFrame, by: tuple[str, ...], order: str, piece: Column, between: str = "\n") -> DataFrame:
    """``by`` and body: the pieces of each key in order."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("p"))))
    return rows.groupBy(*by).agg(F.array_join(F.transform(listed, lambda x: x.p), between).alias("body"))


def attribute(name: str, value: Column | str) -> Column:
    return F.coalesce(F.concat(F.lit(f' {name}="'), escaped((F.col(value) if isinstance(value, str) else value).cast("string")), F.lit('"')), F.lit(""))


def stand_off(records: DataFrame) -> DataFrame:
    """work, body: a link group of each work's matched records (src_ref, tgt_ref, combined, match_type, ord)."""
    link = F.concat(F.lit("  <link"), attribute("target", F.concat_ws(" ", F.concat(F.lit("#"), "src_ref"), F.concat(F.lit("#"), "tgt_ref"))), attribute("cert", F.format_number("combined", 4)), attribute("type", "match_type"), F.lit("/>"))
    linked = records.where("src_ref is not null and tgt_ref is not null")
    return ordered(linked, ("work",), "ord", link).select("work", F.concat(F.lit('<linkGrp xmlns="http://www.tei-c.org/ns/1.0" type="alignment">\n'), "body", F.lit("\n</linkGrp>")).alias("body"))


def tsv_rows(records: DataFrame) -> DataFrame:
    return records.select("work", "book", "src_ref", "tgt_ref", F.format_number("similarity", 4).alias("embedding_sim"), F.format_number("entity_score", 3).alias("entity_score"), F.format_number("combined", 4).alias("combined_score"), "match_type")


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).csv(path)


def translation_tei(sections: DataFrame) -> DataFrame:
    """work, body: books of milestones, heads, paragraphs and notes; ``sections`` has work, book, ord, src_refs (array), tgt_ref, heading_text, text, notes."""
    stones = F.array_join(F.transform(F.coalesce("src_refs", F.array().cast("array<string>")), lambda r: F.concat(F.lit('<milestone unit="section"'), attribute("n", r), F.lit("/>"))), "")
    head = F.coalesce(F.concat(F.lit("<head>"), escaped(F.nullif("heading_text", F.lit(""))), F.lit("</head>")), F.lit(""))
    notes = F.array_join(F.transform(F.coalesce("notes", F.array().cast("array<struct<marker:string,text:string>>")), lambda n: F.concat(F.lit("<note"), attribute("n", n.marker), F.lit(">"), escaped(n.text), F.lit("</note>"))), "")
    piece = F.concat(stones, head, F.lit("<p"), attribute("n", "tgt_ref"), F.lit(">"), escaped(F.col("text")), F.lit("</p>"), notes)
    books = ordered(sections, ("work", "book"), "ord", piece).withColumn("body", F.concat(F.lit('<div type="textpart" subtype="book"'), attribute("n", "book"), F.lit(">\n"), "body", F.lit("\n</div>")))
    whole = ordered(books, ("work",), "book", F.col("body"))
    return whole.select("work", F.concat(F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div type="translation">\n'), "body", F.lit("\n</div></body></text></TEI>")).alias("body"))


def catalogue_fragment(works: DataFrame) -> DataFrame:
    """work, body: one catalogue entry of each work (urn, title, translator)."""
    entry = F.concat(F.lit("<ti:translation"), attribute("urn", "urn"), F.lit('><ti:label xml:lang="eng">'), escaped(F.col("title")), F.lit('</ti:label><ti:description xml:lang="eng">'), escaped(F.col("translator")), F.lit("</ti:description></ti:translation>"))
    return works.select("work", entry.alias("body"))


def parallel_html(rows: DataFrame, high: float = 0.5, low: float = 0.2) -> DataFrame:
    """work, book, body: a table row for each record, with its band and the words in common marked."""
    band = F.when(F.col("combined") >= high, "high").when(F.col("combined") >= low, "med").otherwise("low")
    row = F.concat(F.lit('<tr class="'), band, F.lit('"><td class="source">'), marked_words(escaped(F.col("source")), F.col("source_words")), F.lit('</td><td class="english">'), with_notes(marked_words(escaped(F.col("target")), F.col("target_words")), F.col("notes")),
                   F.lit('</td><td><span class="score" style="width:'), F.round(100 * F.col("combined"), 0).cast("int").cast("string"), F.lit('%"></span></td></tr>'))
    return ordered(rows, ("work", "book"), "ord", row).select("work", "book", F.concat(F.lit("<table>\n"), "body", F.lit("\n</table>")).alias("body"))


def marked_words(text: Column, words: Column, name: str = "hit") -> Column:
    """``text`` with each of the words (letters only, an array) in a span, in whatever case; all words by one replacement."""
    pattern = F.concat(F.lit(r"(?iU)\b("), F.array_join(words, "|"), F.lit(r")\b"))
    return F.when(F.size(F.coalesce(words, F.array().cast("array<string>"))) > 0, F.regexp_replace(text, pattern, F.lit(f'<span class="{name}">$1</span>'))).otherwise(text)


SHADES = " .:-=+*#%@"


def heat_lines(records: DataFrame, by: tuple[str, ...] = ("work", "book"), order: str = "ord", score: str = "score", width: int = 80) -> DataFrame:
    """``by``, line, cells: a sign for each record by its score, ``width`` signs a line."""
    place = F.row_number().over(W.partitionBy(*by).orderBy(order)) - 1
    shade = F.substring(F.lit(SHADES), (F.least(F.greatest(F.col(score), F.lit(0.0)), F.lit(0.999)) * len(SHADES)).cast("int") + 1, F.lit(1))
    rows = records.select(*by, place.alias("at_"), shade.alias("s_")).withColumn("line", F.floor(F.col("at_") / width).cast("int"))
    return ordered(rows, (*by, "line"), "at_", F.col("s_"), "").withColumnRenamed("body", "cells")


def heat_svg(records: DataFrame, by: tuple[str, ...] = ("work",), order: str = "ord", score: str = "score", width: int = 200, size: int = 4) -> DataFrame:
    """``by``, body: an SVG with a square for each record, green for high and red for low scores."""
    place = F.row_number().over(W.partitionBy(*by).orderBy(order)) - 1
    hue = (120 * F.least(F.greatest(F.col(score), F.lit(0.0)), F.lit(1.0))).cast("int").cast("string")
    rows = records.select(*by, place.alias("at_"), hue.alias("hue_"))
    x, y = ((F.col("at_") % width) * size).cast("string"), (F.floor(F.col("at_") / width) * size).cast("string")
    cell = F.concat(F.lit('<rect x="'), x, F.lit('" y="'), y, F.lit(f'" width="{size}" height="{size}" fill="hsl('), F.col("hue_"), F.lit(',70%,50%)"/>'))
    return ordered(rows, by, "at_", cell, "").withColumn("body", F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg">'), "body", F.lit("</svg>")))


def markdown(df: DataFrame, columns: list[str]) -> DataFrame:
    """line: table rows in Markdown, without the header."""
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit(" |")).alias("line"))


def write_concordance(rows: DataFrame, path: str, about: dict[str, str]) -> None:
    """CSV sorted by the Unicode order of the source words, with its description beside it."""
    sorted_rows = rows.orderBy(F.collate("src", "UNICODE"), "rank")
    sorted_rows.write.option("header", True).csv(f"{path}/rows")
    rows.sparkSession.createDataFrame([(f"# {k}: {v}",) for k, v in about.items()], "line string").coalesce(1).write.text(f"{path}/about")


def write_pairs(rows: DataFrame, path: str) -> None:
    rows.write.json(path)


def write_sentences(rows: DataFrame, path: str, text: str = "text") -> None:
    rows.select(text).write.text(path)


def publish(df: DataFrame, checks: DataFrame, path: str) -> bool:
    """Write ``df`` to ``path`` only if no check (check, failures) failed: Spark's commit makes the folder appear whole."""
    if checks.where("failures > 0").take(1):
        return False
    df.write.mode("overwrite").parquet(path)
    return True
