from __future__ import annotations

import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paralith.operators import contexts, dp, integrity, lemmas, lexicon, pairwise, quality, refs, score, sections


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_lexicon_of_four_pairs(spark):
    pairs = spark.createDataFrame([("1", "aaa", "xxx yyy"), ("2", "aaa", "xxx yyy"), ("3", "bbb", "yyy"), ("4", "bbb", "yyy")], "pair_id string, source string, target string")
    s, t = lexicon.tokens(pairs, "source"), lexicon.tokens(pairs, "target")
    total = lexicon.pair_total(pairs)
    assert rows(lexicon.translations(s, t, total, least=2).select("src", "en", "weight")) == [("aaa", "xxx", 1.0)]
    idf = dict(rows(lexicon.idf(s, total)))
    assert math.isclose(idf["aaa"], math.log(2))
    assert dict(rows(lexicon.idf(t, total)))["yyy"] == 0
    assert rows(lexicon.stopwords(t, total, 0.9).select("word")) == [("yyy",)]


def test_lexicon_of_no_pairs(spark):
    pairs = spark.createDataFrame([], "pair_id string, source string, target string")
    s, t = lexicon.tokens(pairs, "source"), lexicon.tokens(pairs, "target")
    assert rows(lexicon.translations(s, t, lexicon.pair_total(pairs))) == []


def test_weights_sum_to_one(spark):
    r = random.Random(3)
    pairs = spark.createDataFrame([(str(i), " ".join(r.choices(["aaa", "bbb", "ccc", "ddd"], k=3)), " ".join(r.choices(["xxx", "yyy", "zzz"], k=2))) for i in range(60)], "pair_id string, source string, target string")
    lex = lexicon.translations(lexicon.tokens(pairs, "source"), lexicon.tokens(pairs, "target"), lexicon.pair_total(pairs), least=1)
    for _, total in rows(lex.groupBy("src").agg(F.sum("weight"))):
        assert math.isclose(total, 1)


def test_window_counts(spark):
    docs = spark.createDataFrame([(1, "aaa bbb ccc")], "id int, text string")
    assert rows(contexts.window_counts(docs, "id", "text", window=1, least=1), "w", "c") == [("aaa", "bbb", 1), ("bbb", "aaa", 1), ("bbb", "ccc", 1), ("ccc", "bbb", 1)]


def test_vectors_of_equal_contexts_agree(spark):
    text = " ".join(f"{x} {y}" for x in ("red", "blue") for y in ("ball", "coat", "door") for _ in range(4))
    docs = spark.createDataFrame([(1, text)], "id int, text string")
    v = contexts.svd_vectors(contexts.ppmi(contexts.window_counts(docs, "id", "text", window=1, least=1)), 3)
    for r in v.collect():
        assert math.isclose(sum(x * x for x in r["vec"]), 1, rel_tol=1e-6)


def matrix(spark, m):
    return spark.createDataFrame([(i, j, float(x)) for i, r in enumerate(m) for j, x in enumerate(r)], "i bigint, j bigint, sim double")


def test_pairwise_matches(spark):
    sims = matrix(spark, [[0.9, 0.8], [0.85, 0.1]])
    assert rows(pairwise.best_matches(sims), "i") == [(0, 0, 0.9, 0.8), (1, 0, 0.85, 0.1)]
    assert rows(pairwise.greedy_matches(sims), "i") == [(0, 0, 0.9, 0.8), (1, None, 0.85, 0.1)]


def test_greedy_equals_plain_greedy(spark):
    r = random.Random(5)
    m = [[r.choice([0.2, 0.4, 0.5, 0.6, 0.9]) for _ in range(7)] for _ in range(6)]
    used_i, used_j, want = set(), set(), {}
    for s, i, j in sorted(((s, i, j) for i, x in enumerate(m) for j, s in enumerate(x)), reverse=True):
        if s >= 0.3 and i not in used_i and j not in used_j:
            used_i.add(i)
            used_j.add(j)
            want[i] = j
    assert {i: j for i, j, *_ in rows(pairwise.greedy_matches(matrix(spark, m))) if j is not None} == want


def test_reference_matching(spark):
    source = spark.createDataFrame(list(enumerate(["1.1.1", "1.1.2", "1.2.1", "1.3.1", "2.1"])), "gi bigint, ref string").withColumn("split_from", F.lit(None).cast("string"))
    target = spark.createDataFrame([(0, "1.1", None), (1, "1.2.1", None), (2, "1.3.2", None), (3, "2.1.0", "2.1"), (4, "2.1.1", "2.1")], "ei bigint, ref string, split_from string")
    assert [r[2] for r in rows(refs.match_references(source, target), "gi")] == [0, 0, 1, 2, 3]


def test_crossings_groups_and_gaps(spark):
    m = spark.createDataFrame(list(enumerate([0, 2, 1, 3, None, None, 6])), "gi bigint, ei bigint")
    fixed = refs.repair_crossings(m)
    assert [r[1] for r in rows(fixed, "gi")] == [0, 2, 2, 3, None, None, 6]
    assert [r["group_id"] for r in refs.match_groups(fixed).orderBy("gi").collect()] == [1, 2, 2, 3, 4]
    ends = spark.createDataFrame([(8, 8)], "n_source bigint, n_target bigint")
    assert rows(refs.gaps(fixed, ends), "src_start") == [(4, 6, 4, 6), (7, 8, 7, 8)]


def test_completion(spark):
    target = spark.createDataFrame([("1", None), ("2.0", "2"), ("2.1", "2"), ("3", None)], "ref string, split_from string")
    out = spark.createDataFrame([("a", "1"), ("b", "2.0")], "src_ref string, tgt_ref string").withColumn("match_type", F.lit("dp_aligned"))
    assert rows(refs.split_continuations(out, target)) == [("b", "2.1", "split_continuation")]
    assert ("3" in [r["tgt_ref"] for r in refs.append_unmatched(out, target).where("match_type = 'unmatched_target'").collect()])


def test_as_of(spark):
    r = spark.createDataFrame([("a", 1), ("a", 5), ("a", 9), ("b", 4)], "k string, o int")
    marks = spark.createDataFrame([("a", 2, "x"), ("a", 9, "y")], "k string, o int, v string")
    assert rows(refs.nearest_before(r, marks, "o", ("k",), "v").select("k", "o", "mark"), "k", "o") == [("a", 1, None), ("a", 5, "x"), ("a", 9, "y"), ("b", 4, None)]


def test_low_runs(spark):
    s = [0.1, 0.1, 0.1, 0.5, 0, 0.1, 0.9, 0.1, 0.1, 0.1, 0.1]
    df = spark.createDataFrame([("w", i, float(x)) for i, x in enumerate(s)], "work string, ord int, score double")
    assert [r[1:4] for r in rows(quality.low_runs(df, ("work",), "ord"), "first")] == [(1, 3, 3), (8, 11, 4)]


def test_order_and_repeats(spark):
    df = spark.createDataFrame([("b", i, x) for i, x in enumerate([0, 2, None, 1, 3])], "book string, pos int, idx int")
    assert [r["idx"] for r in integrity.order_violations(df, ("book",), "pos", "idx").collect()] == [1]
    gate = integrity.gate({"twice": integrity.repeated(df, "book"), "order": integrity.order_violations(df, ("book",), "pos", "idx")})
    assert dict(rows(gate)) == {"twice": 1, "order": 1}


def test_numerals_and_quota(spark):
    df = spark.createDataFrame([("w", i, n) for i, n in enumerate([1, 2, 18, 11, 20])], "work string, ord int, n int")
    assert [r["n"] for r in sections.repaired_numerals(df, ("work",), "ord", "n").orderBy("ord").collect()] == [1, 2, 18, 19, 20]
    got = spark.range(7).select(sections.quota(F.lit(7), F.lit(3), F.col("id")).alias("g")).groupBy("g").count()
    assert rows(got, "g") == [(0, 2), (1, 2), (2, 3)]


def test_notes():
    text = "He ran.[A] Then stopped.\n    [A] A note here.\n    more of it.\nEnd."
    assert sections.without_notes(text) == ("He ran. Then stopped.\nEnd.", [{"marker": "[A]", "text": "A note here. more of it."}])
    assert sections.without_notes("x\nFOOTNOTES:\n[Footnote 1: one]\n[2]\ntwo\nlines")[1] == [{"marker": "[1]", "text": "one"}, {"marker": "[2]", "text": "two lines"}]


def test_heading_merge(spark):
    df = spark.createDataFrame([(1, i, t, t.startswith("H")) for i, t in enumerate(["H1", "C1", "H2", "H3", "C2", "H4"])], "doc int, ord int, text string, is_heading boolean")
    assert [r["text"] for r in sections.merge_headings(df, ("doc",)).orderBy("part").collect()] == ["H1 C1", "H2 H3 C2 H4"]


def test_verse_passages():
    lines = ["x"] * 20
    lines[8], lines[17] = "y.", "z."
    assert sections.passage_bounds(lines) == [(0, 9), (9, 20)]
    assert sections.passage_bounds([]) == []


@settings(max_examples=50, deadline=None)
@given(st.text("ab .", max_size=400), st.integers(20, 80))
def test_split_keeps_all_words(text, most):
    assert "".join("".join(sections.cut_at_sentences(text, most)).split()) == "".join(text.split())


def test_speakers_and_split(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(["A", "A", None, "B", "A"])], "doc int, ord int, speaker string")
    assert sections.speakers_in_order(df, ("doc",)).head()["speakers"] == ["A", "B", "A"]
    big = spark.createDataFrame([("1.1", "One two three. Four five six. Seven eight nine.", None, [("[A]", "n")], 20)], "cts_ref string, text string, text_for_embedding string, notes array<struct<marker:string,text:string>>, most int").withColumn("split_from", F.lit(None).cast("string"))
    parts = sections.split_large(big).orderBy("cts_ref").collect()
    assert [p["cts_ref"] for p in parts] == ["1.1.0", "1.1.1"] and parts[0]["notes"] and parts[1]["notes"] is None and parts[0]["split_from"] == "1.1"


def slow_segmental(s, t, cs, ct, expected, gmax, emax):
    """The recurrence cell by cell."""
    n, m = len(s), len(t)
    w = max(20, int(0.15 * m))
    best, back = {(0, 0): 0.0}, {}
    for i in range(n + 1):
        for j in range(m + 1):
            if (i, j) not in best or not max(0, int(i * m / n - w)) <= j <= min(m, int(i * m / n + w)):
                continue
            for g in range(1, gmax + 1):
                for e in range(1, emax + 1):
                    if i + g > n or j + e > m or abs(j + e - (i + g) * m / n) > w:
                        continue
                    a, b = s[i : i + g].mean(0), t[j : j + e].mean(0)
                    c = float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
                    r = sum(cs[i : i + g]) / sum(ct[j : j + e]) / expected
                    k = max(0.5, 1 / math.sqrt(g * e))
                    total = best[i, j] + k * c + (1 - k) * math.exp(-0.5 * (r - 1) ** 2)
                    if total > best.get((i + g, j + e), -1e18):
                        best[i + g, j + e], back[i + g, j + e] = total, (i, j)
    i, j, out = n, m, []
    while (i, j) in back:
        a, b = back[i, j]
        out.append((a, i, b, j))
        i, j = a, b
    return out[::-1]


def test_segmental_equals_the_recurrence():
    rng = np.random.default_rng(1)
    for _ in range(8):
        n, m = rng.integers(3, 9), rng.integers(3, 9)
        s, t = rng.normal(size=(n, 5)), rng.normal(size=(m, 5))
        cs, ct = rng.integers(20, 90, n), rng.integers(20, 90, m)
        got = dp.segmental(s, t, cs, ct, 1.1, 3, 3)
        assert [g[:4] for g in got] == slow_segmental(s, t, cs, ct, 1.1, 3, 3)
        assert got[0][0] == got[0][2] == 0 and got[-1][1] == n and got[-1][3] == m
        assert all(a[1] == b[0] and a[3] == b[2] for a, b in zip(got, got[1:]))


def test_align_sections(spark):
    eye = np.eye(4).tolist()
    rows_ = lambda k: spark.createDataFrame([("w", "1", i, eye[i % 4], 50) for i in range(k)], "work string, align_key string, ord int, emb array<double>, n_chars int")
    got = dp.align_sections(rows_(4), rows_(4)).orderBy("group_id").collect()
    assert [(r["src_start"], r["src_end"], r["tgt_start"], r["tgt_end"]) for r in got] == [(i, i + 1, i, i + 1) for i in range(4)]


def test_chains_and_splits():
    chain = dp.increasing_chain([(0, 3, 2.0), (1, 1, 2.5), (2, 2, 2.0), (3, 5, 2.0)])
    assert [c[0] for c in chain] == [1, 2, 3]
    assert dp.best_split(np.array([[1, 0], [1, 0], [0, 1]]), np.array([[1, 0], [0, 1]])) == [0, 2, 3]
    assert dp.assign_slots(np.array([[0.1, 0.9, 0.2], [0.3, 0.4, 0.8]])) == [1, 2]
    parts = dp.proportional_cuts("one two three four five six seven eight nine ten", [1, 1])
    assert " ".join(p for p in parts if p) == "one two three four five six seven eight nine ten"


def record(**kw):
    return {"match_type": "dp_aligned", "src_ref": "a", "similarity": 0.8, "lexical": 0.0, "p95": 0.2, "matches": 0, "names": 0, "speaker": 0, "src_chars": 100.0, "tgt_chars": 100.0, "expected": 1.0, "sharing": 1, **kw}


def test_combined_scores(spark):
    half = 100 / (1 + math.sqrt(2 * math.log(2)))  # a ratio whose bell is one half
    cases = [
        (record(lexical=0.1), 0.5),
        (record(match_type="cts_aligned", similarity=0.2, tgt_chars=half), 0.5),
        (record(sharing=4), 0.4),
        (record(match_type="dp_refined", similarity=0.64, tgt_chars=100 / (1 + math.sqrt(2 * math.log(4)))), 0.32),
        (record(match_type="split_continuation"), 0.5), (record(match_type="unmatched_english"), 0.0), (record(tgt_chars=10.0), 0.0),
    ]
    df = spark.createDataFrame([{"k": i, **c} for i, (c, _) in enumerate(cases)])
    got = [r["combined"] for r in score.combined_score(df).orderBy("k").collect()]
    assert got == [w for _, w in cases]


def test_names(spark):
    pairs = spark.createDataFrame([("1", ["sokrates", "sokrates", "zeus"], ["socrates", "plato"]), ("2", [], ["x"])], "pair_id string, source_names array<string>, target_names array<string>")
    assert rows(score.name_overlap(pairs), "pair_id") == [("1", 2, 3, 2 / 3), ("2", 0, 0, None)]
    speakers = spark.createDataFrame([("SOS", "SOSIAS", 0), ("SOS", "XANTHIAS", 1), ("ZZZ", "AAA", 2)], "source string, target string, ord int")
    assert rows(score.same_speaker(speakers)) == [("SOS", "SOSIAS")]


def test_clusters_affixes_stems(spark):
    assert lemmas.cliques([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")]) == [["c", "a", "b"], ["d"]]
    groups = spark.createDataFrame([("logos", "logos"), ("logos", "logou")], "rep string, word string")
    assert rows(lemmas.affix_rows(groups).where("kind = 'suffix'"), "affix") == [("suffix", "s", 1), ("suffix", "u", 1)]
    words = spark.createDataFrame([("anthropos",), ("logos",), ("prologos",)], "word string")
    affixes = spark.createDataFrame([("suffix", "os"), ("prefix", "pro")], "kind string, affix string")
    assert rows(lemmas.stems(words, affixes), "word") == [("anthropos", "anthrop", "", "os"), ("logos", "logos", "", ""), ("prologos", "prolog", "", "os")]
    assert lemmas.fill_groups([("x", 5, 0.9), ("y", 4, 0.8), ("z", 1, 0.7)], 18) == ["x", "z"]


def test_components(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("d", "c")], "a string, b string")
    assert rows(lemmas.components(edges, pairwise._cut), "node") == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "a"), ("x", "x"), ("y", "x")]


def test_subjects(spark):
    s = spark.createDataFrame([(1, ["fox", "crow"]), (2, ["lion", "ass", "fox"]), (3, [])], "src int, subjects array<string>")
    t = spark.createDataFrame([(9, ["crow", "fox"]), (8, ["lion", "ass"])], "tgt int, subjects array<string>")
    assert [(a, b, round(j, 3)) for a, b, j in rows(lemmas.subject_matches(s, t), "src")] == [(1, 9, 1.0), (2, 8, 0.667)]


def test_regressions_and_quadrants(spark):
    old = spark.createDataFrame([("w", 50.0, 10.0, 0.6), ("v", 50.0, 10.0, 0.6)], "work string, high_pct double, low_pct double, avg double")
    new = spark.createDataFrame([("w", 40.0, 10.0, 0.6), ("v", 50.0, 12.0, 0.6)], "work string, high_pct double, low_pct double, avg double")
    assert [r["work"] for r in quality.regressions(new, old).collect()] == ["w"]
    p = spark.createDataFrame([(0.9, 0.1), (0.9, 0.8), (0.1, 0.1)], "m double, r double")
    assert rows(quality.quadrants(p, ["m"], "r").drop("percentiles")) == [("m", 1, 1, 0, 1)]


def test_anchor_candidates(spark):
    from paralith.operators import dp

    names = lambda place, *r: spark.createDataFrame(r, f"k int, {place} int, name string")
    words = lambda place, *r: spark.createDataFrame(r, f"k int, {place} int, word string")
    s, t = names("gi", (1, 0, "ab"), (1, 0, "ab"), (1, 1, "sokrates"), (1, 2, ""), (1, 3, None), (2, 0, "ab")), names("ei", (1, 5, "abydos"), (1, 6, "ab"), (1, 7, "a"), (1, 8, "sokr"), (1, 9, "soft"), (1, 9, ""))
    found = dp.anchor_candidates(s, t, words("gi", (1, 0, "war"), (1, 0, "war"), (1, 2, None)), words("ei", (1, 5, "war"), (1, 9, "sea")), ("k",))
    assert sorted(map(tuple, found.collect())) == [(1, 0, 5, 2.5), (1, 0, 6, 2.0), (1, 0, 7, 2.0), (1, 1, 8, 2.0)]
    assert dp.anchor_candidates(s.limit(0), t, words("gi", (1, 0, "x")).limit(0), words("ei", (1, 0, "x")), ("k",)).count() == 0
