"""Section preparation: headings, notes, oversize sections, passages of verse, paragraph quotas, numeral repair."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from paralith.functions import text as T

#: Characters for each token by language.
CHARS_PER_TOKEN = {"greek": 3.5, "latin": 4.5, "english": 5.0}


def merge_headings(rows: DataFrame, by: tuple[str, ...], order: str = "ord", text: str = "text", heading: str = "is_heading") -> DataFrame:
    """part, text, n, heading_text of each content row with the headings before it; headings at the end belong to the last.

    Keys with headings only give no row here: their rows are kept as they are by the caller.
    """
    w = W.partitionBy(*by).orderBy(order)
    content = (~F.col(heading)).cast("int")
    counted = rows.withColumns({
        "before_": F.coalesce(F.sum(content).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "content_": F.sum(content).over(W.partitionBy(*by)),
    }).where("content_ > 0")
    part = F.least("before_", F.col("content_") - 1)
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"), F.col(heading).alias("h"))))
    merged = counted.withColumn("part", part.cast("bigint")).groupBy(*by, "part").agg(listed.alias("x"), F.count("*").alias("n"))
    join = lambda x: F.array_join(F.transform(x, lambda r: r.t), " ")
    return merged.select(*by, "part", join(F.col("x")).alias("text"), "n", join(F.filter("x", lambda r: r.h)).alias("heading_text"))


def split_threshold(rows: DataFrame, by: tuple[str, ...], chars: str, tokens: int = 512, chars_per_token: float = 5.0) -> DataFrame:
    """n, median (the upper one) and most: the length from which sections are split."""
    listed = F.array_sort(F.collect_list(chars))
    found = rows.groupBy(*by).agg(F.count("*").alias("n"), F.element_at(listed, F.floor(F.count("*") / 2).cast("int") + 1).alias("median"))
    return found.withColumn("most", F.greatest(4 * F.col("median"), F.lit(2 * int(tokens * chars_per_token * 0.9))).cast("bigint"))


# ---- notes ---------------------------------------------------------------------------------------------------------

_headings = {"FOOTNOTES", "FOOTNOTES:", "NOTES", "NOTES:"}
_block = re.compile(r" {4,}\[([A-Za-z]|\d+)\]\s*(.*)")
_footnote = re.compile(r"\[Footnote\s+(\d+):\s*(.*)")
_number = re.compile(r"\[(\d+)\]\s*$")


class _Notes:
    """Notes found so far, and the one that is open."""

    def __init__(self) -> None:
        self.found: list[dict] = []
        self.marker: str | None = None
        self.lines: list[str] = []

    def open(self, name: str | None, first: str = "") -> None:
        body = " ".join(x.strip() for x in self.lines if x.strip())
        if self.marker and body:
            self.found.append({"marker": self.marker, "text": body})
        self.marker, self.lines = (f"[{name}]" if name else None), [first] if first else []


def without_notes(text: str) -> tuple[str, list[dict]]:
    """The text without its notes, and the notes (marker, text).

    Notes are indented blocks that begin with a marker, and all that follows a line FOOTNOTES or NOTES; side notes and
    markers in the text are removed.
    """
    notes, clean, at_end, indented = _Notes(), [], False, False
    for line in text.split("\n"):
        bare = line.strip()
        if bare in _headings:
            at_end = True
            notes.open(None)
        elif at_end:
            if m := _footnote.match(bare):
                notes.open(m[1], m[2].removesuffix("]"))
                if m[2].endswith("]"):
                    notes.open(None)
            elif m := _number.match(bare):
                notes.open(m[1])
            elif notes.marker:
                closing = bare.startswith("[") and bare.endswith("]")
                notes.lines.append(bare[:-1] if closing else bare)
                if closing:
                    notes.open(None)
        elif m := _block.match(line):
            notes.open(m[1], m[2])
            indented = True
        elif indented and (not bare or line.startswith("    ")):
            notes.lines.append(bare)
        else:
            if indented:
                notes.open(None)
                indented = False
            clean.append(re.sub(r"\[Sidenote:[^\]]*\]", "", line))
    notes.open(None)
    return re.sub(r"\[(?:[A-Z]|\d+)\]", "", "\n".join(clean)), notes.found


@F.pandas_udf(StructType([StructField("clean", StringType()), StructField("notes", ArrayType(StructType([StructField(c, StringType()) for c in ("marker", "text")])))]))
def strip_notes(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([without_notes(t or "") for t in texts], columns=["clean", "notes"])


def apply_note_policy(sections: DataFrame) -> DataFrame:
    """text_for_embedding where it is missing: the text without notes, or if none are found without markers; ``text`` stays."""
    out = sections.withColumn("s_", F.when(F.col("text_for_embedding").isNull(), strip_notes("text")))
    found = F.size("s_.notes") > 0
    return out.withColumns({
        "notes": F.when(F.col("s_").isNotNull() & found, F.col("s_.notes")).otherwise(F.col("notes")),
        "text_for_embedding": F.when(F.col("s_").isNull(), F.col("text_for_embedding")).when(found, F.col("s_.clean")).otherwise(T.without_markers(F.col("text"))),
    }).drop("s_")


# ---- splitting -----------------------------------------------------------------------------------------------------


def cut_at_sentences(text: str, most: int) -> list[str]:
    """Chunks of about ``most`` characters that end at a sentence, else at a space, else anywhere."""
    chunks = []
    while len(text) > most:
        ends = [at + 2 for sign in (". ", "? ", "! ", "; ", "· ") if (at := text.rfind(sign, most // 2, most + 200)) >= 0]
        cut = max(ends) if ends else text.rfind(" ", most // 2, most + 200)
        cut = cut if cut > 0 else most
        chunks.append(text[:cut].strip())
        text = text[cut:].strip()
    return [*chunks, text] if text else chunks


def split_section(text: str, clean: str | None, most: int) -> list[tuple[str, str]]:
    """(part of the text, part of its clean form): the clean form is cut, and the text after the last three words of each part, or in proportion."""
    clean = text if clean is None else clean
    if len(text) <= most:
        return [(text, clean)]
    parts, rest, out = cut_at_sentences(clean, most), text, []
    for part in parts[:-1]:
        tail = " ".join(part.split()[-3:])
        at = rest.find(tail)
        cut = at + len(tail) if at >= 0 else int(len(part) / max(len(clean), 1) * len(text))
        out.append((rest[:cut].strip(), part))
        rest = rest[cut:].strip()
    return [*out, (rest, parts[-1] if parts else rest)]


def split_large(sections: DataFrame, most: str = "most") -> DataFrame:
    """``sections`` (cts_ref, text, text_for_embedding, notes, ..., and a column ``most``) with oversize ones in parts.

    Parts are numbered from 0 after the reference, know where they come from, and the first keeps the notes.
    """

    @F.pandas_udf("array<struct<text:string,clean:string>>")
    def parts(text: pd.Series, clean: pd.Series, limit: pd.Series) -> pd.Series:
        return pd.Series([[{"text": a, "clean": b} for a, b in split_section(t or "", c, int(m))] for t, c, m in zip(text, clean, limit, strict=True)])

    rows = sections.withColumn("p_", parts("text", "text_for_embedding", most)).withColumn("n_", F.size("p_"))
    rows = rows.select("*", F.posexplode("p_").alias("k_", "x_"))
    many = F.col("n_") > 1
    return rows.withColumns({
        "split_from": F.when(many, F.col("cts_ref")).otherwise(F.col("split_from")), "cts_ref": F.when(many, F.concat_ws(".", "cts_ref", "k_")).otherwise(F.col("cts_ref")),
        "notes": F.when(F.col("k_") == 0, F.col("notes")), "text": F.col("x_.text"), "text_for_embedding": F.when(many, F.col("x_.clean")).otherwise(F.col("text_for_embedding")),
        "char_count": F.length("x_.text"),
    }).drop("p_", "n_", "k_", "x_")


# ---- passages and quotas -------------------------------------------------------------------------------------------


def passage_bounds(lines: list[str], least: int = 8, most: int = 15, tail: int = 4, ends: str = ".?!;·") -> list[tuple[int, int]]:
    """Half-open passages: cut after a line that ends a sentence from ``least`` lines on, or at ``most``; a short tail joins the passage before."""
    out: list[tuple[int, int]] = []
    start = 0
    for i, line in enumerate(lines, 1):
        n = i - start
        if n >= most or (n >= least and line.rstrip()[-1:] in set(ends)):
            out.append((start, i))
            start = i
    if start < len(lines):
        if out and len(lines) - start < tail:
            out[-1] = (out[-1][0], len(lines))
        else:
            out.append((start, len(lines)))
    return out


def group_lines(lines: DataFrame, by: tuple[str, ...], order: str = "ord", text: str = "text") -> DataFrame:
    """passage, first, last (values of ``order``), n, text of the verse passages of each poem or book, which is read whole."""
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema if f.name in by)
    kind = lines.schema[order].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        texts, at, key = pdf[text].fillna("").tolist(), pdf[order].tolist(), [pdf[k].iloc[0] for k in by]
        return pd.DataFrame([(*key, n, at[a], at[b - 1], b - a, "\n".join(texts[a:b])) for n, (a, b) in enumerate(passage_bounds(texts))], columns=[*by, "passage", "first", "last", "n", "text"])

    return lines.groupBy(*by).applyInPandas(run, f"{keys}, passage int, first {kind}, last {kind}, n int, text string")


def quota(total: Column, groups: Column, place: Column) -> Column:
    """The group of each place when ``total`` paragraphs are dealt to ``groups``: each takes the floor of what is left, at least one, the last the rest."""
    small = F.floor(total / groups)
    edge = small * (groups - total % groups)
    group = F.when(small < 1, place).when(place < edge, F.floor(place / F.greatest(small, F.lit(1)))).otherwise(groups - total % groups + F.floor((place - edge) / (small + 1)))
    return F.least(group, groups - 1).cast("int")


def repaired_numerals(rows: DataFrame, by: tuple[str, ...], order: str, number: str) -> DataFrame:
    """``number`` made to increase: one that does not exceed the corrected one before becomes its successor."""
    w = W.partitionBy(*by).orderBy(order)
    ranked = rows.withColumn("rn_", F.row_number().over(w))
    return ranked.withColumn(number, F.max(F.col(number) - F.col("rn_")).over(w.rowsBetween(W.unboundedPreceding, 0)) + F.col("rn_")).drop("rn_")


def marker_spans(marks: DataFrame, by: tuple[str, ...], start: str = "start", end: str = "end") -> DataFrame:
    """from, to of the stretch after each marker up to the next."""
    w = W.partitionBy(*by).orderBy(start)
    return marks.withColumns({"from": F.col(end), "to": F.lead(start).over(w)})


def speakers_in_order(rows: DataFrame, by: tuple[str, ...], order: str = "ord", speaker: str = "speaker") -> DataFrame:
    """speakers: in order, without those equal to the one before."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(speaker).alias("s")))), lambda x: x.s)
    new = lambda a, s: F.when(s.isNull() | (s == "") | (F.element_at(a, -1) == s), a).otherwise(F.concat(a, F.array(s)))
    step = lambda a, s: F.when(F.size(a) == 0, F.when(s.isNull() | (s == ""), a).otherwise(F.array(s))).otherwise(new(a, s))
    return rows.groupBy(*by).agg(F.aggregate(listed, F.array().cast("array<string>"), step).alias("speakers"))


def dialogue_only(rows: DataFrame, by: tuple[str, ...], text: str = "text", share: float = 0.5, least: int = 200) -> DataFrame:
    """Rows that begin with a speaker, where over ``share`` of over ``least`` rows do not; else all rows."""
    spoken = T.speaker(F.col(text)).isNotNull()
    w = W.partitionBy(*by)
    out = rows.withColumns({"d_": spoken, "other_": F.avg((~spoken).cast("double")).over(w), "n_": F.count("*").over(w)})
    return out.where(F.col("d_") | (F.col("other_") <= share) | (F.col("n_") <= least)).drop("d_", "other_", "n_")


def batches_of(rows: Iterator, n: int) -> Iterator[list]:
    """Lists of up to ``n`` rows."""
    held: list = []
    for r in rows:
        held.append(r)
        if len(held) == n:
            yield held
            held = []
    if held:
        yield held
