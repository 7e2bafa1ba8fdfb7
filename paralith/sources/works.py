"""Section tables of single works: a registry of how each work's two sides are cut, over a few general extractors.

A source side is TEI: divs of one subtype, or verse lines grouped into passages.  A target side is a book file or TEI cut at headings,
paragraphs of a translation, or anchored HTML.  ``extract`` gives ``work, ord, book, ref, text`` for either side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paralith.functions import text as T
from paralith.operators import sections
from paralith.sources import html, plain, tei

ROMAN_BOOK = r"^\s*(?:THE\s+)?BOOK\s+([IVXLC]+)\.?\s*$"
ROMAN_CHAPTER = r"^\s*CHAP(?:TER|\.)?\s+([IVXLC]+)\.?\s*$"


@dataclass(frozen=True)
class Side:
    """``kind``: divs, verse, headed, paragraphs or anchored; ``key``: the divs' subtype or the headings' pattern; ``least``: shortest paragraph kept."""

    kind: str
    key: str = "section"
    least: int = 0


def _verse(least: int = 20, heading: str = r"^\s*IDYLL\s+([IVXLC]+)\.?\s*$") -> tuple[Side, Side]:
    return Side("verse"), Side("headed", heading, least)


# The parts by which each work is cut.
WORKS: dict[str, tuple[Side, Side]] = {
    "achilles_tatius": (Side("divs"), Side("headed", ROMAN_BOOK, 30)),
    "aesop": (Side("divs", "fabula"), Side("paragraphs", "4", 20)),
    "alciphron": (Side("divs"), Side("paragraphs", "1", 15)),
    "apollonius": (Side("verse"), Side("headed", ROMAN_BOOK, 20)),
    **{f"aristophanes_{p}": (Side("verse"), Side("paragraphs", "1", 20)) for p in ("acharnians", "ecclesiazusae", "frogs", "knights", "lysistrata", "peace", "plutus", "thesmophoriazusae", "wasps")},
    "aristotle_const_athens": (Side("divs", "subsection"), Side("headed", r"^\s*Part (\d+)\s*$")),
    "arrian_anabasis": (Side("divs"), Side("headed", ROMAN_CHAPTER)),
    "arrian_cynegeticus": (Side("divs"), Side("headed", r"^\[Sidenote: \+?Chap\. ([IVXLC]+)\.")),
    "bion": _verse(), "moschus": _verse(),
    "library_of_history": (Side("divs"), Side("paragraphs", "1", 0)),
    "dionysius": (Side("divs"), Side("headed", ROMAN_CHAPTER)),
    "dionysius_ant": (Side("divs"), Side("anchored")),
    "heliodorus": (Side("divs", "chapter"), Side("paragraphs", "1", 0)),
    "hippolytus": (Side("divs"), Side("headed", ROMAN_BOOK, 30)),
    "iamblichus": (Side("divs"), Side("headed", ROMAN_CHAPTER, 50)),
    "julian_helios": (Side("divs"), Side("paragraphs", "1", 20)),
    "julian_mother": (Side("divs"), Side("paragraphs", "1", 20)),
    "longus": (Side("divs"), Side("headed", ROMAN_BOOK)),
    "marcus": (Side("divs"), Side("headed", r"^\s*(\d+)\.\s")),
    "plotinus": (Side("divs"), Side("headed", r"^\s*(\d+)\.\s")),
    "procopius_secret": (Side("divs"), Side("headed", ROMAN_CHAPTER)),
    "procopius_wars": (Side("divs"), Side("headed", r"^\s*([IVXLC]+)\s*$")),
    "statius": (Side("verse"), Side("paragraphs", "1", 100)),
    "theocritus_epigrams": (Side("divs", "poem"), Side("headed", r"^\s*([IVXLC]+)\.?\s*$")),
    "theocritus_idylls": _verse(10),
    "theophrastus": (Side("divs"), Side("headed", r"^\s*([IVXLC]+)\.?\s.*$")),
}


def extract(work: str, files: DataFrame, side: Side) -> DataFrame:
    """work, ord, book, ref, text of one side; ``files`` are (path, xml) for TEI and (path, text) for books and pages."""
    if side.kind == "divs":
        rows = tei.read_sections(files, side.key).select("path", "ord", "book", "ref", "text")
    elif side.kind == "verse":
        lines = tei.read_verse(files)
        rows = sections.group_lines(lines, ("path", "poem")).select("path", F.col("first").alias("ord"), F.col("poem").alias("book"), F.concat_ws(".", "poem", F.col("passage") + 1).alias("ref"), "text")
    elif side.kind == "anchored":
        found = files.select("path", F.posexplode(html.anchored_sections("text")).alias("ord", "x"))
        rows = found.select("path", "ord", F.col("x.chapter").alias("book"), F.concat_ws(".", "x.chapter", "x.section").alias("ref"), "x.text")
    elif side.kind == "headed":
        parts = plain.headed_sections(files, side.key).where("part > 0")
        number = F.coalesce(T.roman(F.col("label")).cast("string"), "label")
        rows = parts.select("path", F.col("part").alias("book"), number.alias("label"), F.posexplode(plain.blocks(F.col("text"), 1, side.least)).alias("k", "text"))
        rows = rows.select("path", (F.row_number().over(W.partitionBy("path").orderBy("book", "k")) - 1).alias("ord"), F.col("label").alias("book"), F.concat_ws(".", "label", F.col("k") + 1).alias("ref"), T.collapsed(F.col("text")).alias("text"))
    else:
        rows = files.select("path", F.posexplode(plain.blocks(F.col("text"), int(side.key), side.least)).alias("ord", "text"))
        rows = rows.select("path", "ord", F.lit("1").alias("book"), F.concat_ws(".", F.lit("1"), F.col("ord") + 1).alias("ref"), T.collapsed(F.col("text")).alias("text"))
    return rows.select(F.lit(work).alias("work"), F.col("ord").cast("int").alias("ord"), F.col("book").cast("string").alias("book"), "ref", "text")
