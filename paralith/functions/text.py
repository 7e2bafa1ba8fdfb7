"""Text functions of columns: white space, sentences, words, scripts, names, numerals, references.

White space is that of Unicode; lengths are code points.  All are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paralith.functions.chars import GREEK, LATIN, MARKED

GREEK_WORD = f"[{GREEK}]+"
ENGLISH_WORD = "[a-zA-Z]+"


def collapsed(t: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def without_markers(t: Column) -> Column:
    """Note markers such as [A] and [12] removed, white space collapsed."""
    return collapsed(F.regexp_replace(F.regexp_replace(t, r"\[[A-Z]\]", ""), r"\[\d+\]", ""))


def preview(t: Column, n: int = 80) -> Column:
    return F.substring(t, 1, n)


# ---- sentences -----------------------------------------------------------------------------------------------------


def sentence_pieces(t: Column, language: str = "english") -> Column:
    """Pieces of a text between sentence ends and white space."""
    ends = ".;·!?" if language == "greek" else ".!?;"
    return F.filter(F.split(F.trim(t), rf"(?<=[{ends}])(?U)\s+", -1), lambda x: F.trim(x) != "")


def sentences(t: Column, language: str = "english", least: int = 20) -> Column:
    """Sentences; a piece of under ``least`` characters is part of the sentence before it (the first stands alone)."""
    join = lambda a, x: F.when((F.size(a) == 0) | (F.length(x) >= least), F.concat(a, F.array(x))).otherwise(
        F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.concat_ws(" ", F.element_at(a, -1), x))))
    return F.aggregate(sentence_pieces(t, language), F.array().cast("array<string>"), join)


def corpus_sentences(t: Column, language: str = "greek", least: int = 10) -> Column:
    """Trimmed pieces between sentence signs of over ``least`` characters."""
    signs = "[.·;]" if language == "greek" else "[.?!]"
    return F.filter(F.transform(F.split(t, signs, -1), lambda x: collapsed(x)), lambda x: F.length(x) > least)


# ---- scripts -------------------------------------------------------------------------------------------------------


def greek_chars(t: Column) -> Column:
    return F.length(F.regexp_replace(t, f"[^{GREEK}]", ""))


def latin_chars(t: Column) -> Column:
    return F.length(F.regexp_replace(t, "[^A-Za-z]", ""))


def letters(t: Column) -> Column:
    return F.length(F.regexp_replace(t, r"[^\p{L}]", ""))


def is_greek(t: Column) -> Column:
    """Greek characters are over 0.3 of all."""
    return greek_chars(t) > F.lit(0.3) * F.length(t)


def is_latin(t: Column) -> Column:
    """Latin letters are over half of the letters, Greek ones under a fifth."""
    return (latin_chars(t) > 0.5 * letters(t)) & (greek_chars(t) < 0.2 * letters(t))


def is_mostly_latin_line(t: Column) -> Column:
    """Of Greek characters and signs from A to z the Greek are under 0.3; lines without either are kept."""
    latin = F.length(F.regexp_replace(t, "[^A-z]", ""))
    both = greek_chars(t) + latin
    return (both == 0) | (greek_chars(t) < 0.3 * both)


# ---- words ---------------------------------------------------------------------------------------------------------


def runs_of(t: Column, pattern: str) -> Column:
    """The matches of ``pattern`` in order.  Runs of a class of characters are what stands between the others: splitting takes a fraction of the time of extraction."""
    if pattern[0] == "[" and pattern[-2:] == "]+" and "]" not in pattern[1:-2] and pattern[1] != "^":
        return F.array_remove(F.split(t, f"[^{pattern[1:-2]}]+"), "")
    return F.regexp_extract_all(t, F.lit(pattern), F.lit(0))


def word_sequence(t: Column, pattern: str = ENGLISH_WORD, least: int = 3, stop: Column | None = None) -> Column:
    """Lower-case words of at least ``least`` characters in order, repeats included, without those in the array ``stop``."""
    words = F.filter(F.transform(runs_of(t, pattern), F.lower), lambda w: F.length(w) >= least)
    return words if stop is None else F.filter(words, lambda w: ~F.array_contains(stop, w))


def word_set(t: Column, pattern: str = ENGLISH_WORD, least: int = 3, stop: Column | None = None) -> Column:
    return F.array_distinct(word_sequence(t, pattern, least, stop))


def word_count(t: Column) -> Column:
    return F.size(F.filter(F.split(t, r"(?U)\s+", -1), lambda x: x != "")).cast("bigint")


# ---- Greek letters and names ---------------------------------------------------------------------------------------


def stripped(t: Column) -> Column:
    """Letters without accents and breathings."""
    return F.translate(F.regexp_replace(t, r"\p{Mn}", ""), "".join(MARKED), "".join(MARKED.values()))


def transliterated(t: Column) -> Column:
    """Greek as lower-case Latin letters; signs other than word characters and white space are dropped."""
    one = {c: v for c, v in LATIN.items() if len(v) == 1}
    out = F.translate(F.regexp_replace(t, r"\p{Mn}", ""), "".join(one), "".join(one.values()))
    for two in sorted({v for v in LATIN.values() if len(v) > 1}):
        out = F.regexp_replace(out, "[" + "".join(c for c, v in LATIN.items() if v == two) + "]", two)
    return F.lower(stripped(F.regexp_replace(out, r"(?U)[^\w\s]", "")))


def greek_names(t: Column) -> Column:
    """Words of a Greek capital and two or more small letters."""
    upper = r"[\u0391-\u03A9[\u1F00-\u1FFF&&[\p{Lu}\p{Lt}]]]"
    return F.regexp_extract_all(t, F.lit(rf"(?U)\b{upper}[\u03B1-\u03C9\u03AC-\u03CE\u1F00-\u1FFF]{{2,}}\b"), F.lit(0))


def english_names(t: Column, stop: Column | None = None, ascii_edges: bool = False) -> Column:
    """Capitalised words of five or more letters, lower-cased, repeats included.

    A letter of any script beside a name makes it part of another word; with ``ascii_edges`` only ASCII letters, digits and _ do.
    """
    pattern = r"(?<![0-9A-Za-z_])[A-Z][a-z]{4,}(?![0-9A-Za-z_])" if ascii_edges else r"\b[A-Z][a-z]{4,}\b"
    names = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.lower)
    return names if stop is None else F.filter(names, lambda w: ~F.array_contains(stop, w))


# ---- numerals, references, spelling --------------------------------------------------------------------------------


def roman(t: Column) -> Column:
    """The value of a Roman numeral; null if a sign is none of IVXLCDM."""
    values = F.transform(F.split(F.upper(F.trim(t)), ""), lambda c: F.when(c == "I", 1).when(c == "V", 5).when(c == "X", 10).when(c == "L", 50).when(c == "C", 100).when(c == "D", 500).when(c == "M", 1000))
    step = lambda a, v: F.struct((a.total + v - F.when(a.last < v, 2 * a.last).otherwise(0)).alias("total"), v.alias("last"))
    total = F.aggregate(values, F.struct(F.lit(0).alias("total"), F.lit(10_000).alias("last")), step, lambda a: a.total)
    return F.when(F.upper(F.trim(t)).rlike("^[IVXLCDM]+$"), total)


def reference(t: Column) -> Column:
    """A dotted reference with preface parts as 0 and without leading zeros."""
    return F.regexp_replace(F.regexp_replace(t, r"\.pr\b", ".0"), r"(^|\.)0+(?=\d)", "$1")


def reference_key(t: Column) -> Column:
    """The numeric parts of a dotted reference, which sort as numbers."""
    return F.transform(F.filter(F.split(t, r"\."), lambda x: x.rlike(r"^\d+$")), lambda x: x.cast("int"))


def line_key(t: Column) -> Column:
    """(number, suffix) of a line number such as 184a; (0, the text) without a number."""
    number = F.regexp_extract(t, r"^(\d+)(.*)$", 1)
    return F.when(number != "", F.struct(number.cast("int").alias("n"), F.regexp_extract(t, r"^(\d+)(.*)$", 2).alias("s"))).otherwise(F.struct(F.lit(0).alias("n"), t.alias("s")))


# Early-modern spellings and what stands for them, applied in this order, in either case.
SPELLINGS = (
    (r"\bdoth\b", "does"), (r"\bhath\b", "has"), (r"\bthou\b", "you"), (r"\bthee\b", "you"), (r"\bthy\b", "your"), (r"\bthine\b", "yours"),
    (r"\bwhereof\b", "of which"), (r"\bthereof\b", "of that"), (r"\bhereof\b", "of this"), (r"\bhereafter\b", "after this"),
    (r"\bwherefore\b", "therefore"), (r"\bwhilst\b", "while"), (r"\bamongst\b", "among"), (r"\btill\b", "until"),
    (r"(?U)\b(\w+)eth\b", "$1es"), (r"(?U)\b(\w+)est\b", "$1"),
)


def modern_spelling(t: Column, rules: tuple = SPELLINGS) -> Column:
    """The long s, page marks and early-modern spellings in their modern form, white space collapsed."""
    out = F.regexp_replace(F.translate(t, "ſ\u2223", "s"), "\u3008.*?\u3009", "")
    for pattern, by in rules:
        out = F.regexp_replace(out, f"(?i){pattern}", by)
    return collapsed(out)


# Short words and endings that stand alone.
SHORT_WORDS = tuple(
    "a an as at be by do go he if in is it me my no of oh on or so to up us we am an ar be da de di do el en er es go ha he hi ho id il in io is it la le li lo ma me mi mo mu my na ne ni no nu od of oh ok on op or os ow ox pa pi po re si so st su ta te ti to un up us ut we wo ye".split()
)


def dehyphenated(t: Column, short_words: tuple[str, ...] = SHORT_WORDS) -> Column:
    """A fragment of one to three small letters between two words joined to the first, unless it is one of ``short_words``.

    From left to right: what a match holds, up to the next word's first letter, is not looked at again, kept fragments included.
    """
    return F.regexp_replace(t, rf"([a-zA-Z]{{2,}})(?:( (?:{'|'.join(short_words)})) | ([a-z]{{1,3}}) )([a-zA-Z])", "$1$2$3 $4")


def plain_punctuation(t: Column) -> Column:
    """Typographic quotes, dashes and the ellipsis as ASCII; tags and [n] markers removed."""
    out = F.translate(t, "“”‘’—–", "\"\"''--")
    return collapsed(F.regexp_replace(F.regexp_replace(F.regexp_replace(out, "…", "..."), "<[^>]+>", ""), r"\[\s*\d+\s*\]", ""))


def speaker(t: Column) -> Column:
    """The speaker's name before a line of drama: capitals with a full stop, or an abbreviation with a full stop or before a parenthesis."""
    found = [F.regexp_extract(t, p, 1) for p in (r"^([A-Z]{2,}(?:\s+[A-Z]{2,})?)\.\s+", r"^([A-Z][a-z]{1,10})\.\s+", r"^([A-Z][a-z]{1,10})\s+\(")]
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in found))


def escaped(t: Column) -> Column:
    """Text as XML character data, quotes included."""
    for sign, by in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        t = F.replace(t, F.lit(sign), F.lit(by))
    return t


def with_notes(t: Column, notes: Column) -> Column:
    """Markers of ``notes`` (marker, text) in superscript, and the notes' texts after the text."""
    marked = F.regexp_replace(t, r"\[([A-Z]|\d+)\]", "<sup>$1</sup>")
    return F.concat(marked, F.aggregate(F.coalesce(notes, F.array().cast("array<struct<marker:string,text:string>>")), F.lit(""), lambda a, n: F.concat(a, F.lit('<span class="note">'), n.marker, F.lit(" "), n.text, F.lit("</span>"))))


def title_subject(t: Column) -> Column:
    """A title without parentheses, leading numbers and the word variant, in lower case."""
    return F.lower(collapsed(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\([^)]*\)", " "), r"^\s*\d+[.:]?\s*", ""), r"(?i)\bvariant\b", " ")))
