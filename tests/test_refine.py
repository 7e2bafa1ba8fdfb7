from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from paralith.operators import embed, refine

TEXT = "The king of Persia crossed the wide river with all of his army. Socrates taught the young men of Athens about virtue and courage. The merchants sailed their ships to distant islands in the spring."


def test_pieces_keep_the_words():
    for wanted in (1, 3, 9):
        assert " ".join(refine.pieces(TEXT, wanted)).split() == TEXT.split()
    assert len(refine.pieces(TEXT, 3)) == 3
    assert len(refine.pieces("word " * 20 * 200, 1)) <= refine.MOST


def test_names_draw_sentences():
    zero = np.ones(4)
    sentences = [(s, zero) for s in refine.pieces(TEXT, 3)]
    got = refine.deal(sentences, [(10, zero, []), (10, zero, ["sokrates"])])
    assert "Socrates" in got[1][0] and got[0][0].startswith("The king")
    assert refine.deal([], [(1, zero, [])]) == [("", None)]


def test_fewer_sentences_than_sections():
    e = embed.HashingEmbedder()
    one = [(TEXT, e.encode([TEXT])[0])]
    got = refine.deal(one, [(50, e.encode(["x"])[0], [])] * 3)
    assert " ".join(t for t, _ in got if t).split() == TEXT.split() and len(got) == 3


def test_refine_groups(spark):
    e = embed.HashingEmbedder()
    parts = refine.pieces(TEXT, 3)
    sections = [(len(p), [float(x) for x in v], []) for p, v in zip(parts, e.encode(parts), strict=True)]
    df = spark.createDataFrame([(1, TEXT, sections), (2, "short", sections[:2]), (3, None, sections[:1])], "group_id int, text string, sections array<struct<n_chars:int,emb:array<double>,names:array<string>>>")
    got = refine.refine_groups(df, e).orderBy("group_id", "offset").collect()
    assert [r["text"] for r in got] == [*parts, "short", "", ""]
    assert all(r["similarity"] > 0.99 for r in got[:3])
    assert refine.refine_groups(df.where(F.lit(False)), e).count() == 0
