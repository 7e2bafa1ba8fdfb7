"""Queries without SQL against plain versions over the same tables."""

from __future__ import annotations

import re

import duckdb
import numpy as np

from paralith.functions.fuzzy import partial_ratio
from paralith.operators.embed import HashingEmbedder
from paralith.plans import catalogue


def test_greedy_matches(spark, data):
    rows = duckdb.sql(f"SELECT vec_id, embedding::DOUBLE[] FROM '{data}/embeddings.parquet' ORDER BY vec_id").fetchall()
    unit = {k: np.array(v) / (np.linalg.norm(v) + 1e-10) for k, v in rows}
    sims = sorted(((float(unit[i] @ unit[j]), i, j) for i in unit if i % 2 == 0 for j in unit if j % 2 == 1), reverse=True)
    taken: dict[int, int] = {}
    for s, i, j in sims:
        if s >= 0.3 and i not in taken and j not in taken.values():
            taken[i] = j
    got = {r["i"]: r["j"] for r in catalogue.queries()["q_pairwise_greedy"](spark, data).collect()}
    assert {i: j for i, j in got.items() if j is not None} == taken and len(got) == sum(i % 2 == 0 for i in unit)


def test_entity_overlap(spark, data):
    pairs = duckdb.sql(f"SELECT u.conv_id || ':' || u.turn, u.text, a.text FROM '{data}/conversations.parquet' u JOIN '{data}/conversations.parquet' a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'").fetchall()
    names = lambda t: [w.lower() for w in re.findall(r"\b[A-Z][a-z]{4,}\b", t, re.ASCII)]
    got = {r["pair_id"]: (r["matches"], r["names"]) for r in catalogue.queries()["q_entity_overlap"](spark, data).collect()}
    want = {}
    for key, s, t in pairs:
        there = set(names(t))
        own = names(s)
        want[key] = (sum(any(partial_ratio(a, b) > 75 for b in there) for a in own), len(own))
    assert got == want


def test_segmental_groups(spark, data):
    """No tiling of a conversation's turns scores more than the one that is found."""
    rows = duckdb.sql(f"SELECT conv_id, role, text FROM '{data}/conversations.parquet' WHERE text IS NOT NULL ORDER BY conv_id, turn").fetchall()
    said: dict = {}
    for conv, role, text in rows:
        said.setdefault(conv, {"user": [], "assistant": []}).setdefault(role, []).append(text)
    found: dict = {}
    for r in catalogue.queries()["q_segmental_dp"](spark, data).collect():
        found.setdefault(r["conv_id"], []).append((r["group_id"], r["src_start"], r["src_end"], r["tgt_start"], r["tgt_end"]))
    encode = HashingEmbedder().encode
    tried = 0
    for conv, c in said.items():
        n, m = len(c["user"]), len(c["assistant"])
        if not n or not m:
            assert conv not in found
            continue
        if n > 7 or m > 7:
            continue
        a, b = encode(c["user"]).astype(float), encode(c["assistant"]).astype(float)
        ca, cb = [len(x) for x in c["user"]], [len(x) for x in c["assistant"]]
        most_s, most_t = max(5, int(2 * n / m)), max(2, int(2 * m / n))

        def worth(i, j, k, q):
            x, y = a[i:j].mean(axis=0), b[k:q].mean(axis=0)
            sizes = np.linalg.norm(x), np.linalg.norm(y)
            cosine = 0.0 if min(sizes) < 1e-10 else x @ y / (sizes[0] * sizes[1])
            expected = sum(ca) / sum(cb) if sum(cb) else 1.0
            there = sum(cb[k:q]) > 0 and expected > 0
            bell = np.exp(-0.5 * (sum(ca[i:j]) / (sum(cb[k:q]) * expected) - 1) ** 2) if there else 0.5
            w = max(0.5, 1 / ((j - i) * (q - k)) ** 0.5)
            return w * cosine + (1 - w) * bell

        def best(i, k):
            if i == n and k == m:
                return 0.0
            return max((worth(i, j, k, q) + best(j, q) for j in range(i + 1, min(n, i + most_s) + 1) for q in range(k + 1, min(m, k + most_t) + 1)), default=-np.inf)

        top = best(0, 0)
        if top == -np.inf:
            continue
        groups = [g[1:] for g in sorted(found[conv])]
        assert groups[0][0] == groups[0][2] == 0 and groups[-1][1] == n and groups[-1][3] == m
        assert all(x[1] == y[0] and x[3] == y[2] for x, y in zip(groups, groups[1:]))
        assert abs(sum(worth(*g) for g in groups) - top) < 1e-6
        tried += 1
    assert tried


def test_anchor_chains(spark, data):
    """No choice of anchors that goes forward on both sides weighs more than the chain."""
    best: dict = {}
    for r in sorted(catalogue.queries()["q_anchor_candidates"](spark, data).collect(), key=lambda r: (-r["score"], r["ei"])):
        if r["score"] >= 2:
            best.setdefault(r["conv_id"], {}).setdefault(r["gi"], (r["ei"], r["score"]))
    got: dict = {}
    for r in catalogue.queries()["q_anchor_chains"](spark, data).collect():
        got.setdefault(r["conv_id"], []).append((r["gi"], r["ei"], r["score"]))
    assert set(got) == set(best) and best
    for conv, anchors in best.items():
        rows = [(g, *x) for g, x in sorted(anchors.items())]
        weight = lambda last, at: max((rows[k][2] + weight(rows[k][1], k + 1) for k in range(at, len(rows)) if rows[k][1] > last), default=0.0)
        chain = sorted(got[conv])
        assert set(chain) <= set(rows) and all(a[1] < b[1] for a, b in zip(chain, chain[1:]))
        assert abs(sum(c[2] for c in chain) - weight(-1, 0)) < 1e-9
