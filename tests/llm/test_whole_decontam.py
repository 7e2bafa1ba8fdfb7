"""Windows are found whatever the neighbours of a word and the size of the benchmark, against a plain version."""

from __future__ import annotations

import random
import re

import pytest

from paralith.llm import decontam
from tests.llm import brute

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, items, window=8):
    """id -> (n_words, n_hit, n_items, items_sha256)."""
    lower = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(t or "")]
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = lower(t)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add("" if i is None else str(i))
    out = {}
    for d, t in docs:
        w = lower(t)
        hit, of = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    of |= windows[tuple(w[k : k + size])]
        out[d] = (len(w), len(hit), len(of), brute.sha(",".join(sorted(of))))
    return out


def result(spark, docs, items, **options):
    rows = decontam.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), **options).collect()
    return {r["id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in rows}


@pytest.mark.parametrize("most_bits", [decontam.MOST_BITS, 64])
def test_letters_beyond_ascii(spark, most_bits):
    passage = "ΟΔΟΣ.ΑΒ Α.Σ:Β ΛΟΓΟΣ'Χ Plain WORDS Σ"  # 10 words
    texts = [f"before {passage} after", passage.replace("Plain", "pLAIN"), passage.replace("ΟΔΟΣ", "οδος"), "ΟΔΟΣ'Α ΒΒ ΓΓ ΔΔ ΕΕ ΖΖ ΗΗ ΘΘ", "İstanbul KK É ß ẞ ſ Ǆ a", "istanbul kk É ß ẞ ſ Ǆ a", None, "", "... !!", "short one", "a short one"]
    docs = list(enumerate(texts))
    items = [(1, passage), (2, passage), (3, texts[3]), (4, texts[4]), (4, texts[4]), (5, "Short-One"), (None, "one"), (6, ""), (7, None)]
    assert result(spark, docs, items, most_bits=most_bits) == plain(docs, items)
    assert plain(docs, items)[0][1] == 10 and plain(docs, items)[3][1] == 9


@pytest.mark.parametrize("most_bits", [decontam.MOST_BITS, 1 << 16])
def test_against_plain(spark, most_bits):
    r = random.Random(3)
    text = lambda n: " ".join(r.choice("abcde") + r.choice(["", "", "x", "Y."]) for _ in range(n))
    items = [(i, text(r.randint(1, 14))) for i in range(60)]
    docs = [(i, text(r.randint(0, 60)) + " " + r.choice(items)[1] + " " + text(r.randint(0, 9))) for i in range(120)]
    assert result(spark, docs, items, most_bits=most_bits) == plain(docs, items)


def test_a_large_benchmark(spark):
    """200,000 shingles: the filter's size is bounded, and the one path serves them."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(r.choices(words, k=104))) for i in range(2000)]
    docs = [(i, " ".join(r.choices(words, k=40)) + " " + " ".join(items[i][1].split()[20:50]) + " " + " ".join(r.choices(words, k=5))) for i in range(200)]
    assert result(spark, docs, items) == plain(docs, items)
