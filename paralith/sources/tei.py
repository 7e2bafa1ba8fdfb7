"""TEI XML sources: sections of whole documents, one document at a time, namespaces ignored.

Readers take a frame (path, xml) as :func:`documents` gives it and return rows with an explicit ``ord``.  A document that cannot be
parsed gives no rows.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHAPTERS = ("chapter", "section", "card")
SKIPPED = frozenset("note app bibl ref fw gap figure".split())
FLATTENED = frozenset("note figure pb foreign".split())


def documents(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """path, xml: whole files below ``path``."""
    read = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    return read.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("xml"))


def tag(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def parsed(xml: str | None) -> ET.Element | None:
    try:
        return ET.fromstring(xml.lstrip("﻿").encode() if xml else b"")
    except ET.ParseError:
        return None


def collapse(text: str) -> str:
    return " ".join(text.split())


def walk(e: ET.Element, above: tuple = ()) -> Iterator[tuple[ET.Element, tuple]]:
    """Elements in document order with their ancestors, outermost first."""
    stack = [(e, above)]
    while stack:
        e, above = stack.pop()
        yield e, above
        stack += [(c, (*above, e)) for c in reversed(e)]


def kind(e: ET.Element) -> str:
    return e.get("subtype") or e.get("type") or ""


def chapters(root: ET.Element, most: int = 2000, least: int = 30) -> Iterator[tuple[str, str]]:
    """(ref, text) of divs with a number: book.n below a book; at most ``most`` characters, over ``least``."""
    for e, above in walk(root):
        if tag(e) == "div" and e.get("n") and e.get("subtype") in CHAPTERS:
            book = next((a.get("n") for a in above if tag(a) == "div" and a.get("subtype") == "book"), None)
            text = collapse(" ".join(e.itertext()))[:most]
            if len(text) > least:
                yield (f"{book}.{e.get('n')}" if book else e.get("n")), text


def _textpart(e: ET.Element) -> bool:
    return tag(e) in ("div", "div1", "div2", "div3", "div4") and (e.get("type") == "textpart" or e.get("subtype") is not None) and e.get("n") is not None


def _reference(e: ET.Element, above: tuple) -> str:
    parts: list[str] = []
    for a in reversed((*above, e)):
        if a.get("type") in ("edition", "translation") or (a.get("n") or "").startswith("urn:"):
            break
        if _textpart(a):
            parts.append(a.get("n"))
    return ".".join(reversed(parts))


def leaves(root: ET.Element) -> Iterator[tuple[str, str]]:
    """(ref, text) of text parts that hold no other."""
    for e, above in walk(root):
        if _textpart(e) and not any(_textpart(d) for d, _ in walk(e) if d is not e):
            if text := collapse(" ".join(e.itertext())):
                yield _reference(e, above), text


def levels(root: ET.Element) -> Iterator[tuple[str, str, int]]:
    """(ref, text, depth) of text parts of every depth, old and new markup."""
    for e, above in walk(root):
        if tag(e).startswith("div") and e.get("n") and e.get("type") not in ("edition", "translation") and not e.get("n").startswith("urn:"):
            numbers = [a.get("n") for a in above if tag(a).startswith("div") and a.get("n") and a.get("type") not in ("edition", "translation") and not a.get("n").startswith("urn:")]
            if text := collapse(" ".join(e.itertext())):
                yield ".".join([*numbers, e.get("n")]), text, len(numbers) + 1


def flat(root: ET.Element, skipped: frozenset = SKIPPED) -> str:
    """The body's text without the own text and tail of skipped elements; their children are read."""
    body = next((e for e, _ in walk(root) if tag(e) == "body"), root)
    out: list[str] = []

    def visit(e: ET.Element) -> None:
        shown = tag(e) not in skipped
        if shown and e.text:
            out.append(e.text)
        for c in e:
            visit(c)
        if shown and e.tail and e is not body:
            out.append(e.tail)

    visit(body)
    return collapse(" ".join(out))


def paragraph(e: ET.Element) -> str:
    """A paragraph's text: notes, figures and the like without their text but with what follows, line breaks as spaces, soft hyphens gone."""
    out: list[str] = []

    def visit(x: ET.Element) -> None:
        if tag(x) not in FLATTENED:
            out.append(x.text or "")
            for c in x:
                visit(c)
                out.append(c.tail or "")
        if tag(x) == "lb":
            out.append(" ")

    visit(e)
    return collapse("".join(out).replace("­", ""))


def verse_lines(root: ET.Element) -> Iterator[tuple[str, str, str, str | None]]:
    """(poem, line number, text, speaker) of verse; the poem is the reference of the divs above."""
    for e, above in walk(root):
        if tag(e) == "l":
            speech = next((a for a in reversed(above) if tag(a) == "sp"), None)
            name = next((collapse("".join(c.itertext())) for c in speech if tag(c) == "speaker"), None) if speech is not None else None
            poem = ".".join(a.get("n") for a in above if tag(a) == "div" and a.get("n") and not a.get("n").startswith("urn:"))
            yield poem, e.get("n") or "", paragraph(e), name


def sections(root: ET.Element, leaf: str = "section") -> Iterator[tuple[str, str, str | None, str]]:
    """(book, ref, head, text) of divs of the subtype ``leaf``; the book is the outermost number, or 1."""
    for e, above in walk(root):
        if tag(e) == "div" and kind(e) == leaf and e.get("n"):
            numbers = [a.get("n") for a in above if tag(a) == "div" and a.get("n") and kind(a) not in ("edition", "translation") and not a.get("n").startswith("urn:")]
            head = next((paragraph(c) for c in e if tag(c) == "head"), None)
            text = collapse(" ".join(paragraph(c) for c in e if tag(c) != "head") or paragraph(e))
            if text:
                yield (numbers[0] if numbers else "1"), ".".join([*numbers, e.get("n")]), head, text


def read(docs: DataFrame, extract: Callable[[ET.Element], Iterator[tuple]], columns: str) -> DataFrame:
    """path, ord and ``columns`` of what ``extract`` yields from each document."""
    names = [c.strip().split()[0] for c in columns.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(path, n, *r) for path, xml in zip(pdf["path"], pdf["xml"], strict=True) if (root := parsed(xml)) is not None for n, r in enumerate(extract(root))]
            yield pd.DataFrame(rows, columns=["path", "ord", *names])

    return docs.select("path", "xml").mapInPandas(run, f"path string, ord int, {columns}")


def read_chapters(docs: DataFrame) -> DataFrame:
    """path, ref, text: of equal references the last counts."""
    rows = read(docs, chapters, "ref string, text string")
    return rows.groupBy("path", "ref").agg(F.max_by("text", "ord").alias("text"))


def read_leaves(docs: DataFrame) -> DataFrame:
    return read(docs, leaves, "ref string, text string")


def read_levels(docs: DataFrame) -> DataFrame:
    return read(docs, levels, "ref string, text string, depth int")


def read_flat(docs: DataFrame) -> DataFrame:
    return read(docs, lambda root: [(flat(root),)], "text string")


def read_verse(docs: DataFrame) -> DataFrame:
    return read(docs, verse_lines, "poem string, line string, text string, speaker string")


def read_sections(docs: DataFrame, leaf: str = "section") -> DataFrame:
    return read(docs, lambda root: sections(root, leaf), "book string, ref string, head string, text string")


def parallel_editions(docs: DataFrame, source: str = "grc", target: str = "eng", least: int = 3) -> DataFrame:
    """work, ref, source, target: common references of the first file of each language in a folder, if there are ``least`` of them."""
    name, work = F.element_at(F.split("path", "/"), -1), F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    files = docs.where(~F.contains(name, F.lit("__cts__"))).withColumn("work", work)

    def side(language: str, column: str) -> DataFrame:
        first = files.where(F.contains(name, F.lit(language))).groupBy("work").agg(F.min("path").alias("path"))
        return read_chapters(docs.join(first.select("path"), "path", "left_semi")).join(first, "path").select("work", "ref", F.col("text").alias(column))

    both = side(source, "source").join(side(target, "target"), ["work", "ref"])
    return both.withColumn("n_", F.count("*").over(W.partitionBy("work"))).where(F.col("n_") >= least).drop("n_")


def catalogue_names(docs: DataFrame) -> DataFrame:
    """path, author, title of catalogue files (path, xml); Spark's readers leave out files whose names begin with an underscore."""
    found = lambda e: F.nullif(F.trim(F.regexp_extract("xml", rf"<(?:\w+:)?{e}[^>]*>([^<]+)<", 1)), F.lit(""))
    return docs.select("path", found("groupname").alias("author"), found("title").alias("title"))


_entity = re.compile(r"&(?!(?:amp|lt|gt|quot|apos|#))")


def escape_stray(text: str) -> str:
    """Ampersands that begin no known reference, escaped."""
    return _entity.sub("&amp;", text)
