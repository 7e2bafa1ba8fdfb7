"""Queries with SQL against DuckDB, and the pipeline against a plain version."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from paralith.llm import pieces, quality_model
from paralith.llm import queries as llm_queries
from tests.llm.test_methods import plain_components, plain_fingerprint


def test_sql(spark, data):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    for name, sql in llm_queries.oracle_sql().items():
        df = entry.queries()[name](spark, data)
        want = con.execute(sql)
        columns = [c[0] for c in want.description]
        assert sorted(df.columns) == sorted(columns)
        assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, want.fetchall())), name


def test_pipeline(spark, data):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    kept = [r["doc_id"] for r in corpus_pipeline.quality_classifier(spark, spark.read.parquet(f"{data}/documents.parquet"), data).collect()]
    model = quality_model.fit_quality(spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet"))
    v = quality_model.WordVectors(model.contexts, model.matrix)
    assert sorted(kept) == sorted(d for d, r in docs.items() if model.scores(np.array([v.pooled(r["text"] or "")], float))[0] >= 0.7)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    often = Counter(k for d in kept for k in {key(x) for x in docs[d]["text"].split("\n")})
    text = {d: "\n".join(x for x in docs[d]["text"].split("\n") if not key(x) or often[key(x)] < 10) for d in kept}
    fps = {d: plain_fingerprint(t) for d, t in text.items()}
    root = plain_components(sorted(set(fps.values())))
    least: dict[int, int] = {}
    for d in sorted(text, reverse=True):
        least[root[fps[d]]] = d
    text = {d: text[d] for d in least.values()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in word.findall(t)]
    windows: dict[tuple, set] = {}
    for i, t in duckdb.sql(f"SELECT item_id, text FROM '{data}/benchmark.parquet'").fetchall():
        w = lower(t)
        for k in range(max(1, len(w) - 7)):
            windows.setdefault(tuple(w[k : k + 8]), set()).add(i)
    held = lambda t: any(tuple(w[k : k + 8]) in windows for w in [lower(t)] for k in range(len(w)))
    clean = {d: t for d, t in text.items() if not held(t)}
    assert any(held(t) for t in text.values())
    e = pieces.encoder("piece_bpe_32k.model")
    want = {d: hashlib.sha256(np.array([1, *e.model.encode(t), 2], "<u4").tobytes()).hexdigest() for d, t in clean.items()}
    assert {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, data).collect()} == want
