"""Refinement of groups in which several source sections share one translation: its sentences are dealt to the sections.

With at least as many sentences as sections, a dynamic program finds contiguous groups of sentences by the cosine of their mean
embedding with the section, plus the share of the section's names found in them.  With fewer, sentences are anchored at sections in
order, and each is cut in proportion to the sections that it has to cover.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from paralith.functions.fuzzy import partial_ratio
from paralith.operators.dp import assign_slots, best_split, proportional_cuts

# Ever finer ends of pieces, shortest piece, and most pieces of a text.
ENDS = (r"(?<=[.!?])\s+", r"(?<=[.!?;])\s+", r"(?<=[.!?;:])\s+", r"(?<=[.!?;:,])\s+")
SHORTEST, MOST, LEAST_TEXT = 60, 80, 50


def pieces(text: str, wanted: int) -> list[str]:
    """The coarsest split with at least ``wanted`` pieces, else the finest; short pieces join the one before, and beyond ``MOST`` the shortest its neighbour."""
    out = [text.strip()]
    for pattern in ENDS:
        out = []
        for p in filter(None, (x.strip() for x in re.split(pattern, text))):
            if out and len(p) < SHORTEST:
                out[-1] = f"{out[-1]} {p}"
            else:
                out.append(p)
        if len(out) >= wanted:
            break
    while len(out) > MOST:
        k = min(range(len(out)), key=lambda i: (len(out[i]), i))
        a = max(k - 1, 0)
        out[a : a + 2] = [" ".join(out[a : a + 2])]
    return out


def name_share(names: list[str], text: str, limit: float = 75.0) -> float:
    """The share of (Latin) names that the text holds, as a whole or nearly."""
    if not names:
        return 0.0
    found = {w.lower() for w in re.findall(r"\b[A-Z][a-z]{4,}\b", text)}
    return sum(any(partial_ratio(n, w) > limit for w in found) for n in names) / len(names)


def deal(sentences: list[tuple[str, np.ndarray]], sections: list[tuple[int, np.ndarray, list[str]]]) -> list[tuple[str, float | None]]:
    """(text, cosine) for each section (characters, embedding, names); the cosine is null where nothing is left for one."""
    n, m = len(sentences), len(sections)
    if not n:
        return [("", None)] * m
    emb = np.array([e for _, e in sentences], np.float64)
    goal = np.array([e for _, e, _ in sections], np.float64)
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-10)
    if n >= m:
        bonus = np.zeros((m, n + 1, n + 1))
        for k, (_, _, names) in enumerate(sections):
            if names:
                for a in range(k, n - (m - k) + 1):
                    for b in range(a + 1, n - (m - k - 1) + 1):
                        bonus[k, a, b] = name_share(names, " ".join(t for t, _ in sentences[a:b]))
        cuts = best_split(emb, goal, bonus)
        return [(" ".join(t for t, _ in sentences[a:b]), float(unit(emb[a:b].mean(0)) @ unit(goal[k]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    sims = unit(emb) @ unit(goal).T
    starts = [0, *assign_slots(sims)[1:], m]
    out: list[tuple[str, float | None]] = []
    for i, (a, b) in enumerate(zip(starts, starts[1:], strict=False)):
        for k, part in enumerate(proportional_cuts(sentences[i][0], [c for c, _, _ in sections[a:b]])):
            out.append((part, float(sims[i, a + k]) if part else None))
    return out


def refine_groups(groups: DataFrame, embedder) -> DataFrame:
    """group_id, offset, text, similarity: one row for each source section of the groups.

    ``groups`` has group_id, text (the translation) and sections (array of struct<n_chars, emb, names>).  Texts of under ``LEAST_TEXT`` characters
    stay whole at the first section.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for gid, text, sections in zip(pdf["group_id"], pdf["text"].fillna(""), pdf["sections"], strict=True):
                own = [(int(s["n_chars"]), np.asarray(s["emb"], np.float64), list(s["names"] if s["names"] is not None else ())) for s in sections]
                parts = pieces(text, len(own)) if len(text) >= LEAST_TEXT else [text]
                done = deal(list(zip(parts, embedder.encode(parts), strict=True)), own) if len(text) >= LEAST_TEXT else [(text, None), *[("", None)] * (len(own) - 1)]
                rows += [(gid, k, t, s) for k, (t, s) in enumerate(done)]
            yield pd.DataFrame(rows, columns=["group_id", "offset", "text", "similarity"])

    kind = groups.schema["group_id"].dataType.simpleString()
    return groups.select("group_id", "text", "sections").mapInPandas(run, f"group_id {kind}, offset int, text string, similarity double")
