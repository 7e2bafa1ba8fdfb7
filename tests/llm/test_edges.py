"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns: every operator has a defined result."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from paralith.llm import decontam, html_text, line_dedup, pieces, pii, quality_model, quality_rules, secret_scan, simhash, warc
from tests.llm import brute

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
SCHEMA = "doc_id bigint, text string, c0 string, t1 string, keys string, score string, n_words string"


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with every oddity, and columns that clash with the operators' own."""
    texts = [
        (1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, "same line\nown five"), (6, "SAME line \nown six"), (7, "same line\nown six"), (7, "same line\nown six"),
        (None, "no id here, mail a.b@c.de and 10.0.0.1"), (8, "token = 'abcdefgh1'\x00\n+1 (555) 010-9999"), (9, "é😀 ünï\nsame line"),
    ]
    return spark.createDataFrame([(i, t, "c", "t", "k", "s", "n") for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return sorted(((r["doc_id"] or -1, r["text"]) for r in df.select("doc_id", "text").collect()), key=str)


def test_line_dedup(odd, nothing):
    out = line_dedup.dedup_lines(odd, threshold=5, min_chars=1)
    assert out.columns == [*SCHEMA.replace(" bigint", "").replace(" string", "").split(", "), "n_lines", "n_dropped", "kept_sha256"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == odd.count()
    assert got[5]["text"] == "own five" and got[6]["text"] == "own six" and got[9]["text"] == "é😀 ünï"
    assert got[1]["text"] == "" and got[1]["n_lines"] == 1 and got[4]["n_dropped"] == 0
    assert got[5]["kept_sha256"] == hashlib.sha256(b"own five").hexdigest() and got[5]["c0"] == "c"
    assert line_dedup.dedup_lines(nothing).count() == 0
    exactly = line_dedup.dedup_lines(odd, threshold=6, min_chars=1)
    assert exactly.agg(F.sum("n_dropped")).head()[0] == 0


def test_simhash(odd, nothing):
    out = {(r["id"], r["fp"]): r["component_id"] for r in simhash.simhash_groups(odd).collect()}
    assert out[1, 0] == out[2, 0] == out[3, 0] == 1
    assert simhash.simhash_groups(odd).count() == odd.count()
    kept = simhash.keep_one_of_each_group(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(7) <= 1 and 1 in ids and 2 not in ids and 4 in ids
    assert simhash.simhash_groups(nothing).count() == 0 and simhash.keep_one_of_each_group(nothing).count() == 0


def test_main_text(spark):
    pages = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "just text &amp; more", "x"), (4, "<p>Unclosed <b>bold<p>next&nbsp;one", "x"), (5, "<div" * 2000, "x"), (6, "<article>" * 3000 + "<p>deep", "x")], "page_id int, html string, text string")
    got = {r["page_id"]: r for r in html_text.extract_main_text(pages).collect()}
    assert got[1]["text"] == got[2]["text"] == "" and got[3]["text"] == "just text & more" and got[4]["text"] == "Unclosed bold next one"
    assert got[6]["text"] == "deep" and got[3]["n_chars"] == len(got[3]["text"])
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def test_pieces(odd, nothing):
    out = pieces.encode_pieces(odd, ids=True).collect()
    e = pieces.encoder("piece_bpe_32k.model")
    for r, (text,) in zip(out, [(x["text"],) for x in odd.collect()], strict=True):
        assert r["ids"] == [1, *e.model.encode(text or ""), 2] and r["decoded"] == e.model.decode(r["ids"])
    assert pieces.encode_pieces(nothing).count() == 0


def test_personal_data(odd, nothing):
    for r, text in zip(*(sorted(x, key=lambda v: str(v)) for x in ([(x["id"] or -1, x["base_sha256"]) for x in pii.find_personal_data(odd).collect()], [(x["doc_id"] or -1, brute.sha(brute.listed(brute.personal_base(x["text"])))) for x in odd.collect()])), strict=True):
        assert r == text
    assert pii.find_personal_data(nothing).count() == 0


def test_decontamination(spark, odd, nothing):
    items = spark.createDataFrame([(1, "own five"), (2, "same"), (2, "SAME"), (None, "own"), (3, ""), (4, None)], "item_id bigint, text string")
    got = {r["id"]: r for r in decontam.decontaminate(odd, items).collect()}
    assert (got[5]["n_words"], got[5]["n_hit"], got[5]["n_items"], got[5]["contaminated"]) == (4, 3, 3, True)
    assert got[5]["items_sha256"] == brute.sha(",1,2")
    assert got[1]["n_words"] == 0 and not got[1]["contaminated"] and got[1]["items_sha256"] == brute.sha("")
    assert got[4]["n_words"] == 30_000
    assert sorted(map(str, decontam.decontaminate(odd, items, most_bits=64).collect())) == sorted(map(str, got_all := decontam.decontaminate(odd, items).collect())) and got_all
    kept = decontam.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and 5 not in [r["doc_id"] for r in kept.collect()]
    assert decontam.decontaminate(nothing, items).count() == 0 and decontam.decontaminate(odd, items.limit(0)).where("contaminated").count() == 0


def test_secrets(odd, nothing):
    got = sorted((r["id"] or -1, r["base_sha256"]) for r in secret_scan.secret_report(odd).collect())
    assert got == sorted((x["doc_id"] or -1, brute.sha(brute.listed(brute.secret_base(x["text"])))) for x in odd.collect())
    assert secret_scan.secret_report(nothing).count() == 0


def test_warc(spark):
    rows = [(1, "u", "<p>a"), (2, None, "<p>a"), (2, None, "<p>a"), (None, "u\r\nX: y", "<p>a"), (5, "u", None), (6, "u", ""), (7, "u", "x\r\n"), (8, "u", "\r\n\r\ny\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", "only")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    got = warc.deduplicate_archives(pages).collect()
    assert len(got) == len(rows)
    kind = sorted(((r["page_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got), key=str)
    want = [(-1, "response", None, 4), (-1, "revisit", 2, 4), (1, "revisit", 2, 4), (2, "response", None, 4), (2, "response", None, 4), (5, "revisit", 6, 0), (6, "response", None, 0), (7, "response", None, 3), (8, "response", None, len(rows[7][2]))]
    assert kind == sorted(want, key=str)
    assert warc.deduplicate_archives(pages, min_bytes=4).where("page_id = 5").head()["record_type"] == "response"
    assert warc.deduplicate_archives(pages.limit(0)).count() == 0


def test_quality_model(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, None), (None, 1)], "doc_id bigint, quality int")
    model = quality_model.fit_quality(odd, labels)
    out = quality_model.score_quality(odd, model)
    assert out.columns[-3:] == ["held_out", "score", "predicted"] and out.count() == odd.count() and out.columns.count("score") == 1
    for r in out.collect():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    none = quality_model.fit_quality(odd, labels.limit(0))
    assert quality_model.score_quality(odd, none).select("score").distinct().count() == 1
    assert quality_model.score_quality(nothing, model).count() == 0


def test_quality_rules(spark, odd, nothing):
    trusted = spark.createDataFrame([(4,), (None,)], "doc_id bigint")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(odd, trusted).collect()}
    assert got[1]["n_words"] == 0 and got[1]["base_failed"] and not got[1]["kept"] and got[4]["kept"] and got[4]["n_words"] == 30_000
    assert quality_rules.quality_rules(nothing, trusted).count() == 0
    assert quality_rules.quality_rules(odd, trusted.limit(0)).where("llr <> 0").count() == 0
