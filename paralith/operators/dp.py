"""Sequence alignment: segmental, splitting and anchoring dynamic programs, one group of rows a task.

The dynamic programs are plain NumPy over the transitions of a cell; ``segmental`` handles all target places of a source place at
once.  Groups are the sections of one work and key, which are read whole by their nature.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paralith.functions.fuzzy import sequence_score


def _sums(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros((1, *rows.shape[1:])), np.cumsum(rows, axis=0, dtype=np.float64)])


def without_repeats(names) -> list:
    """Names without those equal to the one before."""
    out: list = []
    for x in names:
        if x and (not out or out[-1] != x):
            out.append(x)
    return out


def segmental(
    source: np.ndarray, target: np.ndarray, source_chars, target_chars, expected: float, most_source: int, most_target: int,
    source_speakers: list | None = None, target_speakers: list | None = None, overlaps: np.ndarray | None = None,
) -> list[tuple[int, int, int, int, float]]:
    """Groups (source start, source end, target start, target end, cosine) that tile both sides in order.

    A step takes 1..``most_source`` source and 1..``most_target`` target rows and stays in a band around the diagonal.  Its score is
    w * cosine of the mean embeddings + (1 - w) * length bell with w = max(1/2, 1/sqrt(rows of both)), plus the speakers'
    sequence score and the mean of each source row's best overlap, where there are any.  Ties go to the earliest start.
    """
    n, m = len(source), len(target)
    if not n or not m:
        return []
    width = max(20, int(0.15 * m))
    sums_s, sums_t = _sums(np.asarray(source, np.float64)), _sums(np.asarray(target, np.float64))
    chars_s, chars_t = _sums(np.asarray(source_chars, np.float64)), _sums(np.asarray(target_chars, np.float64))
    best = np.full((n + 1, m + 1), -np.inf)
    best[0, 0] = 0.0
    step_g, step_e = np.zeros((n + 1, m + 1), np.int32), np.zeros((n + 1, m + 1), np.int32)
    places = np.arange(m + 1)
    allowed = [(places >= max(0, int(i * (m / n) - width))) & (places <= min(m, int(i * (m / n) + width))) for i in range(n + 1)]
    lands = [np.abs(places - i * (m / n)) <= width for i in range(n + 1)]
    runs_t: dict[int, list] = {}
    mean_t, size_t = {}, {}
    for e in range(1, min(most_target, m) + 1):
        mean_t[e] = (sums_t[e:] - sums_t[:-e]) / e
        size_t[e] = np.linalg.norm(mean_t[e], axis=1)
        if target_speakers is not None:
            runs_t[e] = [without_repeats(target_speakers[j : j + e]) for j in range(m - e + 1)]
    best_of = {e: np.max([overlaps[:, k : m - e + 1 + k] for k in range(e)], axis=0) for e in mean_t} if overlaps is not None else {}
    for i in range(1, n + 1):
        for g in range(min(most_source, i), 0, -1):
            mean = (sums_s[i] - sums_s[i - g]) / g
            size = np.linalg.norm(mean)
            speakers = without_repeats(x for row in source_speakers[i - g : i] for x in (row if row is not None else ())) if source_speakers is not None else []
            for e in sorted(mean_t, reverse=True):
                start = slice(0, m - e + 1)
                usable = allowed[i - g][start] & lands[i][e:] & (best[i - g, start] > -np.inf)
                if not usable.any():
                    continue
                ok = (size_t[e] >= 1e-10) & (size >= 1e-10)
                cosine = np.where(ok, mean_t[e] @ mean / np.where(ok, size_t[e] * size, 1), 0.0)
                chars = chars_t[e:] - chars_t[:-e]
                there = (chars > 0) & (expected > 0)
                ratio = (chars_s[i] - chars_s[i - g]) / np.where(there, chars * (expected or 1), 1)
                weight = max(0.5, 1 / math.sqrt(g * e))
                score = weight * cosine + (1 - weight) * np.where(there, np.exp(-0.5 * (ratio - 1) ** 2), 0.5)
                if speakers and e in runs_t:
                    score = score + np.array([sequence_score(speakers, r) if r else 0.0 for r in runs_t[e]])
                if e in best_of:
                    score = score + np.maximum(best_of[e][i - g : i].mean(axis=0), 0.0)
                total = np.where(usable, best[i - g, start] + score, -np.inf)
                better = total > best[i, e:]
                best[i, e:][better] = total[better]
                step_g[i, e:][better] = g
                step_e[i, e:][better] = e
    i, j = n, m
    if best[n, m] == -np.inf:
        corner = best[max(0, n - most_source) :, max(0, m - most_target) :]
        a, b = np.unravel_index(int(np.argmax(corner)), corner.shape)
        i, j = int(a) + max(0, n - most_source), int(b) + max(0, m - most_target)
    groups = []
    while i > 0 and j > 0 and step_g[i, j]:
        g, e = int(step_g[i, j]), int(step_e[i, j])
        a, b = sums_s[i] - sums_s[i - g], sums_t[j] - sums_t[j - e]
        size = np.linalg.norm(a / g) * np.linalg.norm(b / e)
        flat = min(np.linalg.norm(a / g), np.linalg.norm(b / e)) < 1e-10
        groups.append((i - g, i, j - e, j, 0.0 if flat else float(a / g @ (b / e) / size)))
        i, j = i - g, j - e
    return groups[::-1]


GROUPS = "group_id int, src_start int, src_end int, tgt_start int, tgt_end int, score double"


def align_sections(source: DataFrame, target: DataFrame, by: tuple[str, ...] = ("work", "align_key"), most_source: int | None = None, most_target: int | None = None) -> DataFrame:
    """Segmental groups of every key of ``by``.

    Both frames have ``by``, ord, emb (array) and n_chars; source may have ``speakers`` (array) and ``overlaps`` (array of (j, m)),
    target ``speaker``.  The largest steps default to max(5, 2n/m) and max(2, 2m/n).
    """
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema if f.name in by)

    def run(key, s: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        s, t = s.sort_values("ord"), t.sort_values("ord")
        n, m = len(s), len(t)
        if not n or not m:
            return pd.DataFrame({**{k: pd.Series([], dtype=object) for k in by}, **{c.split()[0]: [] for c in GROUPS.split(", ")}})
        expected = s["n_chars"].sum() / t["n_chars"].sum() if t["n_chars"].sum() else 1.0
        matrix = None
        if "overlaps" in s:
            matrix = np.zeros((n, m))
            for i, row in enumerate(s["overlaps"]):
                for x in row if row is not None else ():
                    matrix[i, x["j"]] = x["m"]
        speakers = "speakers" in s and "speaker" in t
        groups = segmental(
            np.stack(s["emb"].to_numpy()), np.stack(t["emb"].to_numpy()), s["n_chars"], t["n_chars"], float(expected),
            most_source or max(5, int(2 * n / m)), most_target or max(2, int(2 * m / n)),
            list(s["speakers"]) if speakers else None, list(t["speaker"]) if speakers else None, matrix)
        return pd.DataFrame([(*key, k, *g) for k, g in enumerate(groups)], columns=[*by, *(c.split()[0] for c in GROUPS.split(", "))])

    # new names on one side: both may come from one frame
    own = target.toDF(*(f"t_{c}" for c in target.columns)).toDF(*target.columns)
    return source.groupBy(*by).cogroup(own.groupBy(*by)).applyInPandas(run, f"{keys}, {GROUPS}")


def best_split(sentences: np.ndarray, sections: np.ndarray, bonus: np.ndarray | None = None) -> list[int]:
    """Bounds of len(sections) contiguous, non-empty groups of sentences with the highest sum of cosines between group mean and section.

    ``bonus[k, a, b]`` is added to the score of sentences a..b-1 with section k.  Needs as many sentences as sections.
    """
    n, m = len(sentences), len(sections)
    sums = _sums(np.asarray(sentences, np.float64))
    best = np.full((m + 1, n + 1), -np.inf)
    best[0, 0] = 0
    back = np.zeros((m + 1, n + 1), np.int32)
    for k in range(1, m + 1):
        section = np.asarray(sections[k - 1], np.float64)
        size = np.linalg.norm(section)
        for j in range(k, n - (m - k) + 1):
            starts = np.arange(k - 1, j)
            means = (sums[j] - sums[starts]) / (j - starts)[:, None]
            sizes = np.linalg.norm(means, axis=1)
            ok = (sizes >= 1e-10) & (size >= 1e-10)
            score = np.where(ok, means @ section / np.where(ok, sizes * size, 1), 0.0)
            if bonus is not None:
                score = score + bonus[k - 1, starts, j]
            total = best[k - 1, starts] + score
            at = int(np.argmax(total))
            best[k, j], back[k, j] = total[at], starts[at]
    bounds = [n]
    for k in range(m, 0, -1):
        bounds.append(int(back[k, bounds[-1]]))
    return bounds[::-1]


def assign_slots(similarity: np.ndarray) -> list[int]:
    """Strictly increasing slots of the rows of ``similarity`` (fewer rows than columns) with the highest sum; ties to earlier slots."""
    n, m = similarity.shape
    best = np.full((n + 1, m + 1), -np.inf)
    best[0] = 0
    for i in range(1, n + 1):
        for j in range(i, m + 1):
            best[i, j] = max(best[i, j - 1], best[i - 1, j - 1] + similarity[i - 1, j - 1])
    out, j = [], m
    for i in range(n, 0, -1):
        while j > i and best[i, j - 1] == best[i, j]:
            j -= 1
        out.append(j - 1)
        j -= 1
    return out[::-1]


def proportional_cuts(text: str, weights: list[int], least: int = 20) -> list[str]:
    """``text`` cut at spaces in proportion to ``weights``; parts of under ``least`` characters join the one before, empty strings fill up."""
    total, parts, at, passed = sum(weights) or 1, [], 0, 0
    for w in weights[:-1]:
        passed += w
        goal = len(text) * passed // total
        cut = text.rfind(" ", at, goal + 1)
        cut = max(at, cut if cut > at else text.find(" ", goal) if text.find(" ", goal) >= 0 else len(text))
        parts.append(text[at:cut].strip())
        at = cut
    parts.append(text[at:].strip())
    out: list[str] = []
    for p in parts:
        if out and p and len(p) < least:
            out[-1] = f"{out[-1]} {p}".strip()
            out.append("")
        else:
            out.append(p)
    return [p for p in out if p] + [""] * (len(out) - sum(map(bool, out)))


def increasing_chain(pairs: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """The heaviest chain of (source, target, weight), sources and targets strictly increasing; ties to the earliest."""
    pairs = sorted(pairs)
    if not pairs:
        return []
    total, back = [], []
    for k, (_, e, w) in enumerate(pairs):
        best, at = w, -1
        for j in range(k):
            if pairs[j][1] < e and pairs[j][0] < pairs[k][0] and total[j] + w > best:
                best, at = total[j] + w, j
        total.append(best)
        back.append(at)
    k = int(np.argmax(total))
    chain = []
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def anchor_candidates(source_names: DataFrame, target_names: DataFrame, source_words: DataFrame, target_words: DataFrame, by: tuple[str, ...] = ("work", "align_key")) -> DataFrame:
    """by, gi, ei, score: 2 for each pair of names that begin alike, 0.5 for each word in common.

    Frames have ``by``, gi or ei, and name or word; repeats within a section count once, nulls and empty strings not at all.  Names begin
    alike if their first four letters are the same or one is the beginning of the other.  Names meet by equality of their beginnings: all
    are as long as a name or four letters on one side at least, so that each pair is found once.
    """

    def heads(rows: DataFrame) -> DataFrame:
        longest = F.least(F.length("name"), F.lit(4))
        cut = rows.where("name <> ''").distinct().withColumn("k_", F.explode(F.sequence(F.lit(1), longest)))
        return cut.select(*rows.columns, F.expr("left(name, k_)").alias("head_"), (F.col("k_") == longest).alias("end_"))

    s, t = heads(source_names), heads(target_names)
    meet = lambda a, b: a.drop("name", "end_").join(b.drop("name", "end_"), [*by, "head_"]).select(*by, "gi", "ei", F.lit(2.0).alias("score"))
    names = meet(s.where("end_"), t).unionByName(meet(s.where("not end_"), t.where("end_")))
    words = source_words.where("word <> ''").distinct().join(target_words.where("word <> ''").distinct(), [*by, "word"]).select(*by, "gi", "ei", F.lit(0.5).alias("score"))
    return names.unionByName(words).groupBy(*by, "gi", "ei").agg(F.sum("score").alias("score"))


def anchor_chains(candidates: DataFrame, by: tuple[str, ...] = ("work", "align_key"), least: float = 2.0) -> DataFrame:
    """The heaviest chain of anchors (gi, ei, score) of each key: the best target of each source (ties: the first), scores of at least ``least``."""
    top = candidates.groupBy(*by, "gi").agg(F.max(F.struct("score", (-F.col("ei")).alias("k"))).alias("t")).select(*by, "gi", (-F.col("t.k")).alias("ei"), F.col("t.score").alias("score")).where(F.col("score") >= least)
    schema = top.schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        key = [pdf[k].iloc[0] for k in by]
        return pd.DataFrame([(*key, *c) for c in increasing_chain(list(zip(pdf["gi"], pdf["ei"], pdf["score"], strict=True)))], columns=schema.names)

    return top.groupBy(*by).applyInPandas(run, schema)


def prefix_rows(coverage: float, n_source: int, first_anchor: int | None) -> int:
    """How many leading source rows precede the translation: those before the first anchor, if few references match."""
    return first_anchor if coverage < 0.5 and n_source > 20 and first_anchor is not None and first_anchor > 5 else 0
