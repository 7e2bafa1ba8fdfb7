"""Stem groups by translations, and lemmas completed by vectors."""

from __future__ import annotations

from paralith.operators import lemmas
from paralith.plans import concordance

LEXICON = "src string, en string, weight double"


def test_stem_groups_by_translations(spark):
    said = [("aa", "x", 1.0), ("ab", "x", 2.0), ("ba", "x", 1.0), ("bb", "y", 1.0), ("ca", "x", 1.0), ("cb", "x", 1.0), ("cc", "z", 0.1), ("d", "x", 1.0)]
    groups = spark.createDataFrame([("a", "aa"), ("a", "ab"), ("b", "ba"), ("b", "bb"), ("c", "ca"), ("c", "cb"), ("c", "cc"), ("c", "cd"), ("d", "d"), ("e", "ea"), ("e", "eb")], "stem string, word string")
    got = {r["word"]: r["sim"] for r in lemmas.near_translations(groups, spark.createDataFrame(said, LEXICON)).collect()}
    assert set(got) == {"aa", "ab", "ca", "cb", "cd"} and got["cd"] is None
    assert abs(got["aa"] - 1) < 1e-9 and abs(got["ca"] - 2 / (4 + 0.01) ** 0.5) < 1e-9
    assert lemmas.near_translations(groups.limit(0), spark.createDataFrame(said, LEXICON)).count() == 0


def test_words_alone_and_small_groups(spark):
    large, small = [f"polemos{c}" for c in "abcdef"], ["polemizo", "polemize"]
    found = spark.createDataFrame([(w, "polemosa", 0.9) for w in large] + [(w, "polemizo", 0.6) for w in small], "word string, rep string, confidence double")
    words = [*large, *small, "polemikon", "thalassa"]
    said = spark.createDataFrame([(w, "sea" if w == "thalassa" else "war", 1.0) for w in words], LEXICON)
    unit = {"polemosa": [1.0, 0.0], "polemizo": [0.8, 0.6], "polemikon": [0.96, 0.28], "thalassa": [0.96, -0.28]}
    vectors = spark.createDataFrame(list(unit.items()), "word string, vec array<double>")
    suffixes = spark.createDataFrame([("on",)], "affix string")
    rows = {r["word"]: (r["rep"], round(r["confidence"], 6)) for r in concordance.completed(found, said, vectors, suffixes).collect()}
    assert rows == {w: ("polemosa", 0.9) for w in large} | {w: ("polemosa", 0.8) for w in small} | {"polemikon": ("polemosa", 0.96)}
    full = {r["word"]: r["rep"] for r in concordance.completed(found, said, vectors, suffixes, most=8).collect()}
    assert full["polemizo"] == full["polemize"] == "polemizo" and full["polemikon"] == "polemosa"
