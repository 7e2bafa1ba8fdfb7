from __future__ import annotations

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paralith.functions import fuzzy
from paralith.functions import text as T
from paralith.functions import vectors as V


def value(spark, column, **cells):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in cells.items())).select(column.alias("x")).head()["x"]


def test_white_space_and_markers(spark):
    assert value(spark, T.collapsed(F.col("t")), t=" a \n b ") == "a b"
    assert value(spark, T.without_markers(F.col("t")), t="He ran.[A] Then [12] stopped.") == "He ran. Then stopped."


def test_roman_numerals(spark):
    assert [value(spark, T.roman(F.col("t")), t=x) for x in ("XIV", "IX", "Q", "mcmxc")] == [14, 9, None, 1990]


def test_references(spark):
    assert value(spark, T.reference(F.col("t")), t="1.pr") == "1.0"
    assert value(spark, T.reference(F.col("t")), t="01.002") == "1.2"
    assert value(spark, T.reference_key(F.col("t")), t="11.8.2a.3") == [11, 8, 3]
    assert tuple(value(spark, T.line_key(F.col("t")), t="184a")) == (184, "a")


def test_sentences_merge_short_ones_backwards(spark):
    t = "This is the first sentence. Short. Another long sentence follows here! End."
    assert value(spark, T.sentences(F.col("t")), t=t) == ["This is the first sentence. Short.", "Another long sentence follows here! End."]


def test_greek(spark):
    assert value(spark, T.stripped(F.col("t")), t="ἄνθρωπος") == "ανθρωπος"
    assert value(spark, T.transliterated(F.col("t")), t="Ἀχιλλεύς") == "akhilleys"
    assert value(spark, T.greek_names(F.col("t")), t="ὁ Σωκράτης καὶ Πλάτων εἶπον") == ["Σωκράτης", "Πλάτων"]
    assert value(spark, T.is_greek(F.col("t")), t="λόγος abc")
    assert value(spark, T.word_sequence(F.col("t"), T.GREEK_WORD), t="ὁ Λόγος λόγος") == ["λόγος", "λόγος"]


def test_names_speakers_spelling(spark):
    assert value(spark, T.english_names(F.col("t")), t="Then Socrates met Plato and Socrates") == ["socrates", "plato", "socrates"]
    assert [value(spark, T.speaker(F.col("t")), t=x) for x in ("FIRST WOMAN. Go!", "Sos. What?", "Sos (aside) no", "no one. x")] == ["FIRST WOMAN", "Sos", "Sos", None]
    assert value(spark, T.modern_spelling(F.col("t")), t="he hath ſaid that it goeth") == "he has said that it goes"
    assert value(spark, T.dehyphenated(F.col("t")), t="the Lacedae mon ians se cret") == "the Lacedaemon iansse cret"
    assert value(spark, T.dehyphenated(F.col("t")), t="foo bar ab cd ef") == "foobar ab cd ef"
    assert value(spark, T.dehyphenated(F.col("t")), t="sailed to the ri ver of gold") == "sailed to theri ver of gold"
    assert value(spark, T.title_subject(F.col("t")), t="12. The Fox (variant) Variant and Crow") == "the fox and crow"


def test_escaping_and_notes(spark):
    assert value(spark, T.escaped(F.col("t")), t='a<b & "c"') == "a&lt;b &amp; &quot;c&quot;"
    notes = F.array(F.struct(F.lit("[A]").alias("marker"), F.lit("n").alias("text")))
    assert value(spark, T.with_notes(F.col("t"), notes), t="x[A]") == 'x<sup>A</sup><span class="note">[A] n</span>'


def test_vectors(spark):
    a, b = F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))
    assert math.isclose(value(spark, V.cosine(a, b), t=1), 2**-0.5)
    assert value(spark, V.cosine(a, F.array(F.lit(0.0), F.lit(0.0))), t=1) == 0
    assert math.isclose(value(spark, V.length_penalty(F.lit(2.0), F.lit(1.0)), t=1), math.exp(-0.5))
    assert value(spark, V.ngrams(F.col("t")), t="ab") == ["ab"]
    m, n = F.create_map(F.lit("x"), F.lit(3.0), F.lit("y"), F.lit(4.0)), F.create_map(F.lit("x"), F.lit(1.0))
    assert math.isclose(value(spark, V.map_cosine(m, n), t=1), 0.6)


def test_common_runs():
    assert fuzzy.common_substring("abcde", "xbcdy") == (3, 1, 1)
    assert fuzzy.sequence_score(["A", "B", "A"], ["A", "A"]) == 0.8
    assert fuzzy.partial_ratio("socrates", "the socrates of") == 100
    assert fuzzy.ratio("", "") == 100 and fuzzy.partial_ratio("", "x") == 0


@settings(max_examples=60, deadline=None)
@given(st.text("abc", max_size=8), st.text("abc", max_size=8))
def test_fuzzy_properties(a, b):
    assert fuzzy.ratio(a, b) == fuzzy.ratio(b, a)
    assert fuzzy.partial_ratio(a, b) >= fuzzy.ratio(a, b) or len(a) != len(b)
    n, i, j = fuzzy.common_substring(a, b)
    assert a[i : i + n] == b[j : j + n] and n <= fuzzy.common_subsequence(a, b)
