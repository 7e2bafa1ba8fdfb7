"""The alignment of works from references, stretches between them, and shared translations."""

from __future__ import annotations

from paralith.plans import align_works

SCHEMA = "work string, align_key string, ord int, cts_ref string, text string, split_from string"
SAYS = ["The king came to the river and Alexander wept", "Then Socrates spoke about virtue to Plato", "The ships sailed at dawn from Athens", "After the battle the Persians fled homewards", "Winter fell upon the mountains of the north"]


def sides(spark, source, target):
    make = lambda rows: align_works.prepared(spark.createDataFrame(rows, SCHEMA))
    return make(source), make(target)


def test_references_first_then_stretches(spark):
    source = [("w", "1", i, f"1.{i}", t, None) for i, t in enumerate(SAYS)] + [("v", "1", i, f"a.{i}", t, None) for i, t in enumerate(SAYS)]
    target = [("w", "1", i, r, t + " again", None) for i, (r, t) in enumerate(zip(("1.0", "x", "y", "z", "1.4"), SAYS, strict=True))] + [("w", "1", 9, "9.9", "An unrelated end", None)]
    target += [("v", "1", i, f"b.{i}", t + " again", None) for i, t in enumerate(SAYS)]
    rows = align_works.assembled(*sides(spark, source, target)).collect()
    got = sorted((r["work"], r["i"], r["j"], r["match_type"]) for r in rows if r["i"] is not None)
    by_dp = [("v", i, i, "dp_aligned") for i in range(5)]
    assert [x for x in got if x[0] == "v"] == by_dp
    assert ("w", 0, 0, "cts_aligned") in got and ("w", 4, 4, "cts_aligned") in got
    assert sorted(r["i"] for r in rows if r["work"] == "w" and r["i"] is not None) == list(range(5))  # no source row is lost
    assert ("w", 5) in {(r["work"], r["j"]) for r in rows if r["match_type"] == "unmatched_target"}


def test_shared_translations_are_dealt_out(spark):
    source = [("w", "1", i, f"1.1.{i}", t, None) for i, t in enumerate(SAYS[:3])]
    target = [("w", "1", 0, "1.1", ". ".join(SAYS[:3]) + ".", None)]
    rows = sorted(align_works.assembled(*sides(spark, source, target)).collect(), key=lambda r: r["i"])
    assert [(r["i"], r["j"], r["match_type"]) for r in rows] == [(i, 0, "dp_refined") for i in range(3)]
    assert [r["part"].rstrip(".") for r in rows] == SAYS[:3]
    plain = align_works.assembled(*sides(spark, source, target), refine=False).collect()
    assert {(r["match_type"], r["part"]) for r in plain} == {("cts_aligned", None)}


def test_pieces_of_matched_targets_continue(spark):
    source = [("w", "1", 0, "1.1", SAYS[0], None)]
    target = [("w", "1", 0, "1.1.0", SAYS[0], "1.1"), ("w", "1", 1, "1.1.1", SAYS[1], "1.1")]
    rows = {(r["i"], r["j"], r["match_type"]) for r in align_works.assembled(*sides(spark, source, target)).collect()}
    assert rows == {(0, 0, "cts_aligned"), (0, 1, "split_continuation")}


def test_concordance_overrides(spark):
    source, target = sides(spark, [("w", "1", i, f"{i}", t, None) for i, t in enumerate(SAYS)], [("w", "1", i, f"{i}", t, None) for i, t in enumerate(SAYS)])
    pairs = spark.createDataFrame([("w", "1", i, i, 0.9, "dp_aligned") for i in range(5)], "work string, align_key string, i int, j int, similarity double, match_type string")
    said = spark.createDataFrame([("w", "1", "3"), ("w", "2", "none"), ("u", "0", "4")], "work string, source_section string, target_section string")
    got = sorted((r["i"], r["j"], r["match_type"]) for r in align_works.overridden(pairs, source, target, said).collect())
    assert got == [(0, 0, "dp_aligned"), (1, 3, "concordance"), (2, 2, "dp_aligned"), (3, 3, "dp_aligned"), (4, 4, "dp_aligned")]
