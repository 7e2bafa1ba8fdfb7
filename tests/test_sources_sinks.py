from __future__ import annotations

import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from paralith.operators import embed
from paralith.plans import align_works, concordance
from paralith.sinks import render
from paralith.sources import html, plain, tei, works
from paralith.streaming.ingest import ingest_sections

BODY = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div type="edition" n="urn:x">
<div type="textpart" subtype="book" n="1"><div type="textpart" subtype="chapter" n="1"><p>First chapter of the book<note>skip me</note> goes on for long.</p></div>
<div type="textpart" subtype="chapter" n="2"><head>A head</head><p>Second chapter<lb/>of the book that is quite long.</p></div></div>
<div type="textpart" subtype="book" n="2"><div type="textpart" subtype="chapter" n="1"><p>Short.</p></div></div></div></body></text></TEI>"""


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("tei")
    for language in ("grc", "eng"):
        (top / "w").mkdir(exist_ok=True)
        (top / "w" / f"w.{language}1.xml").write_text(BODY)
    (top / "w" / "broken.xml").write_text("<TEI><div>")
    return tei.documents(spark, str(top))


def test_tei_readers(files):
    one = files.where("path like '%grc1%' or path like '%broken%'")
    assert {r["ref"]: r["text"] for r in tei.read_chapters(one).collect()}.keys() == {"1.1", "1.2"}
    assert [r["ref"] for r in tei.read_leaves(one).orderBy("ord").collect()] == ["1.1", "1.2", "2.1"]
    assert sorted((r["ref"], r["depth"]) for r in tei.read_levels(one).collect()) == [("1", 1), ("1.1", 2), ("1.2", 2), ("2", 1), ("2.1", 2)]
    assert "skip me" not in tei.read_flat(one).head()["text"]
    s = tei.read_sections(one, "chapter").orderBy("ord").collect()
    assert [(r["book"], r["ref"], r["head"]) for r in s] == [("1", "1.1", None), ("1", "1.2", "A head"), ("2", "2.1", None)]
    assert s[1]["text"] == "Second chapter of the book that is quite long."


def test_parallel_editions_and_catalogue(files):
    assert tei.parallel_editions(files, least=3).count() == 0
    assert sorted(r["ref"] for r in tei.parallel_editions(files, least=2).collect()) == ["1.1", "1.2"]
    named = files.limit(1).select(F.lit("__cts__.xml").alias("path"), F.lit("<ti:work><ti:groupname>An Author</ti:groupname><ti:title>A Title</ti:title></ti:work>").alias("xml"))
    assert [tuple(r)[1:] for r in tei.catalogue_names(named).collect()] == [("An Author", "A Title")]


def test_verse(spark):
    xml = '<TEI><div n="1">' + "<sp><speaker>A</speaker>" + "".join(f'<l n="{i}">line {i}{"." if i % 9 == 0 else ""}</l>' for i in range(1, 21)) + "</sp></div></TEI>"
    docs = spark.createDataFrame([("p", xml)], "path string, xml string")
    assert tei.read_verse(docs).where("speaker = 'A'").count() == 20
    got = works.extract("bion", docs, works.WORKS["bion"][0]).orderBy("ord").collect()
    assert [r["ref"] for r in got] == ["1.1", "1.2"] and len(works.WORKS) == 35


def test_books(spark, tmp_path):
    (tmp_path / "b.txt").write_text("preface\r\n*** START OF THIS BOOK ***\r\nfront\nBOOK I\n\nFirst paragraph of one.\n\nSecond one.\nBOOK II\n\nThird.\n*** END OF THIS BOOK ***\nlicence")
    books = plain.books(spark, str(tmp_path))
    assert books.head()["text"].startswith("front") and "licence" not in books.head()["text"]
    got = works.extract("x", books, works.Side("headed", works.ROMAN_BOOK)).orderBy("ord").collect()
    assert [(r["ref"], r["text"]) for r in got] == [("1.1", "First paragraph of one."), ("1.2", "Second one."), ("2.1", "Third.")]


def test_html_sources(spark):
    page = '<nav><p>' + "n" * 200 + '</p></nav><p>' + "x y " * 40 + '[ 3 ]</p><p>short</p><a class="chapter" name="1"></a>Begin <span class="pagenum">[9]</span>here<a class="sec" name="1.2"></a> and on<hr class="endnotes">notes<table><td class="source">a b c<span class="fn">x y</span> d</td><td class="english">e f</td></table>'
    df = spark.createDataFrame([(page,), (None,)], "t string")
    assert df.select(html.paragraphs(F.col("t")).alias("p")).head()["p"] == [("x y " * 40).strip()]
    assert [tuple(x) for x in df.select(html.anchored_sections("t").alias("s")).head()["s"]] == [("1", "1", "Begin here"), ("1", "2", "and on")]
    assert tuple(df.select(html.column_words("t").alias("w")).head()["w"]) == (3, 2)


def test_json_and_csv(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"sections": [{"cts_ref": "1.1", "text": "x", "notes": [{"marker": "[A]", "text": "n"}]}]}')
    (tmp_path / "b.json").write_text('[{"cts_ref": "2.1", "text": "y"}, {"cts_ref": "2.2", "text": "z"}]')
    assert sorted(r["cts_ref"] for r in plain.json_sections(spark, str(tmp_path)).collect()) == ["1.1", "2.1", "2.2"]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "m.json").write_text('{"21c": "4", "1": "2"}')
    assert sorted(map(tuple, plain.concordance_map(spark, str(tmp_path / "c")).collect())) == [("1", "2"), ("21c", "4")]
    (tmp_path / "v.csv").write_text('L,A,T,G,O,E,I,N\n1,"Homer, poet",Iliad,G,Y,N,tlg1,\n')
    assert plain.catalogue(spark, str(tmp_path / "v.csv")).head()["author"] == "Homer, poet"


def test_samples_do_not_depend_on_partitions(spark):
    rows = spark.range(500).withColumn("k", F.col("id").cast("string"))
    a, b = plain.seeded_split(rows, "k")
    assert a.count() + b.count() == 500 and 400 < a.count() < 490
    assert sorted(plain.seeded_sample(rows, "k", 9).collect()) == sorted(plain.seeded_sample(rows.repartition(7), "k", 9).collect())


@pytest.fixture(scope="module")
def sides(spark):
    texts = ["The king came to the river and Alexander wept", "Then Socrates spoke about virtue to Plato", "The ships sailed at dawn from Athens", "After the battle the Persians fled homewards"]
    rows = [("w", "1", i, f"1.{i}", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "work string, align_key string, ord int, cts_ref string, text string")
    return align_works.prepared(df), align_works.prepared(df.withColumn("text", F.concat(F.col("text"), F.lit(" again"))))


def test_alignment_end_to_end(sides):
    source, target = sides
    pairs = align_works.aligned(source, target)
    records = align_works.scored(pairs.drop("group_id"), source, target)
    got = records.orderBy("i").collect()
    assert [(r["src_ref"], r["tgt_ref"]) for r in got] == [(f"1.{i}", f"1.{i}") for i in range(4)] and all(r["combined"] > 0.7 for r in got)
    checks = align_works.checked(records, source, target)
    assert checks.where("failures > 0").count() == 0
    by_ref = align_works.aligned_by_reference(source, target)
    assert sorted((r["i"], r["j"]) for r in by_ref.collect()) == [(i, i) for i in range(4)]


def test_rendering(spark, sides, tmp_path):
    source, target = sides
    s = target.select("work", F.lit("1").alias("book"), "ord", F.array(F.lit("1.1")).alias("src_refs"), F.col("cts_ref").alias("tgt_ref"), F.lit("A & B").alias("heading_text"), "text", F.array(F.struct(F.lit("[A]").alias("marker"), F.lit("n<").alias("text"))).alias("notes"))
    root = ET.fromstring(render.translation_tei(s).head()["body"])
    assert len([e for e in root.iter() if e.tag.endswith("}p")]) == 4
    records = spark.createDataFrame([("w", "b", i, f"s{i}", f"t{i}", i / 10, "dp", i / 10) for i in range(10)], "work string, book string, ord int, src_ref string, tgt_ref string, combined double, match_type string, score double")
    assert render.stand_off(records).head()["body"].count("<link ") == 10
    assert [r["cells"] for r in render.heat_lines(records, width=6).orderBy("line").collect()] == [" .:-=+", "*#%@"]
    ET.fromstring(render.heat_svg(records).head()["body"])
    html_rows = spark.createDataFrame([("w", "b", 1, "ὁ λόγος", "the word[A]", 0.7, ["λόγος"], ["word"])], "work string, book string, ord int, source string, target string, combined double, source_words array<string>, target_words array<string>").withColumn("notes", F.lit(None).cast("array<struct<marker:string,text:string>>"))
    body = render.parallel_html(html_rows).head()["body"]
    assert '<span class="hit">λόγος</span>' in body and '<span class="hit">word</span><sup>A</sup>' in body
    bad = spark.createDataFrame([("x", 1)], "check string, failures long")
    assert not render.publish(records, bad, f"{tmp_path}/out") and render.publish(records, bad.where("failures = 0"), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 10


def test_embedding_cache(spark):
    df = spark.createDataFrame([("same text",), ("same text",), ("other",), (None,)], "text string")
    first = embed.embed(df)
    assert first.count() == 2
    assert embed.embed(df, cache=first).count() == 0
    assert embed.with_embeddings(df, first).where("emb is null").count() == 1


def test_concordance_end_to_end(spark):
    pairs = spark.createDataFrame([(str(i), s, t) for i, (s, t) in enumerate([("λόγος ἄνθρωπος", "word man"), ("λόγος θάλασσα", "word sea"), ("ἄνθρωπος θάλασσα", "man sea"), ("λόγου ποταμός", "word river")] * 4)], "pair_id string, source string, target string")
    out = concordance.concordance(pairs)
    top = {r["src"]: r["en"] for r in out.where("rank = 1").collect()}
    assert top["λόγος"] == "word" and top["θάλασσα"] == "sea"


def test_ingest_adds_each_text_once(spark, tmp_path):
    schema = "work string, cts_ref string, text string"
    for n, rows in enumerate([[("w", "1", "a"), ("w", "1", "a")], [("w", "1", "a"), ("w", "2", "b")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        ingest_sections(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination(120)
        assert spark.read.parquet(f"{tmp_path}/out").count() == n + 1
