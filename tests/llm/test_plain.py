"""Operators against plain versions of their whole method, and the pipeline's stages on odd rows."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from paralith.llm import line_dedup, pieces, pii, quality_model, spans, warc
from tests.llm import brute

# ---- personal data: candidates, votes, EM and classifier, one span at a time ---------------------------------------


def plain_luhn(v: str) -> bool:
    return brute.luhn(re.sub("[^0-9]", "", v))


def plain_votes(kind: str, v: str, left: str) -> tuple[int, ...]:
    own = re.sub("[^0-9]", "", v)
    yes = lambda c: 1 if c else -1
    lengths = {x[:2]: int(x[2:]) for x in pii.IBAN_LENGTHS.split()}
    listed = 1 if re.search(pii.LISTED[kind], v) else -1 if kind in pii.DECIDED else 0
    context = -1 if re.search(pii.NOT_CUES, left) else 1 if re.search(pii.CUES[kind], left) else 0
    check = 0
    if kind == "phone":
        national = 9 <= len(own) <= 15 if v[0] == "+" else len(own) == 10 and own[0] > "1" and own[3] > "1"
        check = yes(national and not re.search(r"(\d)\1{6}", own))
    if kind == "card":
        check = yes(plain_luhn(v) and 12 <= len(own) <= 19 and len(set(own)) > 1)
    if kind == "ip":
        check = yes(not (v[0] == "0" or v.startswith("255.255.") or v.endswith(".0.0.0") or any(len(x) > 1 and x[0] == "0" for x in v.split("."))))
    if kind == "ssn":
        check = yes(v[:3] not in ("000", "666") and v[0] != "9" and v[4:6] != "00" and v[7:] != "0000")
    if kind == "iban":
        check = yes(int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1 and lengths.get(v[:2]) == len(v))
    if kind == "email":
        check = yes(not re.search(r"\.\.|^\.|\.@|@-|-\.|\.[0-9]+$", v))
    return yes(re.search(pii.STRICT[kind], v)), listed, context, check


def plain_features(kind: str, v: str, left: str, right: str) -> dict[str, object]:
    beside = lambda c: "edge" if not c else "space" if c.isspace() else "word" if c.isalnum() and c.isascii() else "sign"
    shape = re.sub("[0-9]+", "0", re.sub("[a-z]+", "a", re.sub("[A-Z]+", "A", v)))
    word = re.search(r"([A-Za-z]+)[^A-Za-z]*$", left)
    hashed = lambda x: xxhash.xxh64_intdigest(x, 42) - (2**64 if xxhash.xxh64_intdigest(x, 42) >> 63 else 0)
    return {"length": min(len(v) // 4, 12), "digits": 5 * sum(c.isdigit() for c in v) // len(v), "before": beside(left[-1:]), "after": beside(right[:1]), "shape": hashed(shape) % 256, "word": hashed(word[1].lower() if word else "") % 256}


def plain_added(texts: list[str], accept: float = 0.9) -> list[list[tuple]]:
    found = []
    for i, t in enumerate(texts):
        base = [(s, e, kind) for s, _, e, kind in brute.personal_base(t)]
        loose = [(m.start(), m.end(), kind) for kind, (p, _) in pii.LOOSE.items() for m in re.finditer(p, t)]
        loose = [x for x in loose if not any(b[0] < x[1] and x[0] < b[1] for b in base)]
        for own, (s, e, kind) in [*((True, b) for b in base), *((False, x) for x in loose)]:
            # the text before reaches back to the last span of the same pattern, the text after to the next one
            same = [x for x in (base if own else [(m.start(), m.end(), kind) for m in re.finditer(pii.LOOSE[kind][0], t)]) if x[2] == kind]
            low = max((x[1] for x in same if x[1] <= s), default=0)
            high = min((x[0] for x in same if x[0] >= e), default=len(t))
            found.append((i, own, s, e, kind, t[s:e], t[max(low, s - 40) : s], t[e : min(high, e + 40)]))
    vote = [plain_votes(kind, v, left) for _, _, _, _, kind, v, left, _ in found]
    posterior = pii.expectation_maximisation(list(Counter(vote).items()))
    sums: dict = {}
    kinds: dict = {}
    features = [plain_features(kind, v, left, right) for _, _, _, _, kind, v, left, right in found]
    for f, x, v in zip(found, features, vote, strict=True):
        p = posterior[v]
        g = kinds.setdefault(f[4], [0.0, 0.0])
        g[0] += p
        g[1] += 1 - p
        for name, value in x.items():
            s = sums.setdefault((f[4], name, value), [0.0, 0.0])
            s[0] += p
            s[1] += 1 - p
    out: list[list[tuple]] = [[] for _ in texts]
    for f, x in zip(found, features, strict=True):
        g, b = kinds[f[4]]
        score = math.log((g + 1) / (b + 1))
        for name, value in x.items():
            width = pii.BLOCKS[name]
            good, bad = sums[f[4], name, value]
            score += math.log((good + 1) / (g + width)) - math.log((bad + 1) / (b + width))
        if not f[1] and score >= math.log(accept / (1 - accept)):
            out[f[0]].append((f[2], pii.KINDS.index(f[4]), f[3], f[4]))
    return out


def personal_texts() -> list[str]:
    r = random.Random(8)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    texts = []
    for i in range(150):
        texts.append(r.choice([
            f"please call my phone {r.randint(200, 999)}-{r.randint(200, 999)}-{d(4)} today", f"order {r.randint(100, 199)}-{d(3)}-{d(4)} shipped, invoice 000-{d(2)}-0000",
            f"mail jo.{i} [at] site{i} [dot] com or u{i}@site.org", f"her ssn {r.randint(100, 500)}-{r.randint(10, 99)}-{r.randint(1000, 9999)} is here", "bank account DE89370400440532013000, IBAN GB82WEST12345698765432.",
            f"serial XX{d(2)}{d(16)} and build DE{d(20)}", f"Dear Mrs. {r.choice(['Anna', 'Zorg', 'Mary'])} Smith, signed Dr. Who", f"host 10.0.{i}.1 from 256.1.1.1, version 1.2.3.4", f"card 4111 1111 1111 1111 and +1 (555) 010-{d(4)}",
            "nothing personal here at all", f"odd ..@x 0.0.0.0 ticket 555-555-5555 not at ( at ) all {d(30)}",
        ]))
    return texts


def test_added_spans_against_plain(spark):
    texts = personal_texts()
    docs = spark.createDataFrame([*enumerate(texts), (len(texts), None)], "doc_id int, text string")
    want = [",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted([*brute.personal_base(t), *more])) for t, more in zip(texts, plain_added(texts), strict=True)]
    got = {r["id"]: r["spans"] for r in pii.find_personal_data(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want and got[len(texts)] == ""
    assert any("ssn:" in x for x in want) and any("iban:" in x for x in want)


def test_account_remainders(spark):
    codes = ["DE89370400440532013000", "GB82WEST12345698765432", "FR1420041010050500013M02606", "DE88370400440532013000"]
    got = [r["m"] for r in spark.createDataFrame([(c,) for c in codes], "c string").select(pii.remainder_97(F.col("c")).alias("m")).collect()]
    assert got == [int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 for c in codes] and got[:3] == [1, 1, 1]


def test_many_spans_in_one_text(spark):
    text = " ".join(f"u{i}@site.org" for i in range(100_000))
    began = time.monotonic()
    rows = spark.createDataFrame([(text,), ("none",), (None,)], "t string").select(spans.find_spans(F.coalesce("t", F.lit("")), pii.EMAIL, hint="@").alias("x")).collect()
    assert [(x["s"], x["e"]) for x in rows[0]["x"]] == [m.span() for m in re.finditer(brute.EMAIL, text)]
    assert rows[1]["x"] == rows[2]["x"] == [] and time.monotonic() - began < 60


def test_overlaps(spark):
    r = random.Random(4)
    pairs = lambda n: [(s, s + r.randint(1, 9)) for s in (r.randint(0, 3000) for _ in range(n))]
    for a, b in ((pairs(300), pairs(500)), (pairs(5), []), ([], pairs(5))):
        df = spark.createDataFrame([(a, b)], "a array<struct<s:int,e:int>>, b array<struct<s:int,e:int>>")
        got = [tuple(x) for x in df.select(spans.overlaps_none(F.col("a"), F.col("b"))).head()[0]]
        assert got == [x for x in a if not any(y[0] < x[1] and x[0] < y[1] for y in b)]


# ---- the others ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("join_rest", [False, True])
@pytest.mark.parametrize("most_chunks", [3, pieces.MOST_CHUNKS])
def test_pieces_of_rare_and_frequent_chunks(spark, most_chunks, join_rest):
    r = random.Random(2)
    words = ["the", "sea", "naïve", "a" * 400, "ünï", "▁x", "😀", "tab\tbed", "line\nend", *(f"w{i}" for i in range(40))]
    texts = [" ".join(r.choices(words, k=r.randint(0, 60))) + "  " * r.randint(0, 2) + f" once{i}" for i in range(60)] + [None, "", " ", "the sea", "the sea"]
    out = pieces.encode_pieces(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, extra string"), ids=True, most_chunks=most_chunks, join_rest=join_rest)
    assert out.columns[:3] == ["doc_id", "text", "extra"]
    model = pieces.encoder("piece_bpe_32k.model").model
    got = {x["doc_id"]: (x["ids"], x["decoded"], x["extra"]) for x in out.collect()}
    for i, t in enumerate(texts):
        ids = model.encode(t or "", add_bos=True, add_eos=True)
        assert got[i] == (ids, model.decode(ids), "x")


def test_chunks_are_counted_and_segmented(spark):
    counted = pieces.chunk_counts(spark.createDataFrame([("a b a",), ("a  c b",), (None,), ("",)], "t string"))
    assert {r["chunk"]: r["n"] for r in counted.collect()} == {"▁a": 3, "▁b": 2}
    e = pieces.encoder("piece_bpe_32k.model")
    table = {r["chunk"]: bytes(r["ids"]) for r in pieces.segmented(counted, "piece_bpe_32k.model").collect()}
    assert table == {c: np.array(e.model.encode(c[1:]), "<u4").tobytes() for c in ("▁a", "▁b")}


def test_shards_are_doubled(spark):
    docs = spark.createDataFrame([(i, "\n".join(f"common {k}" for k in range(40)) + f"\nown {i}") for i in range(6)], "doc_id int, text string")
    index = line_dedup.LineIndex(spark, threshold=5, shards=2, keys_each=8).insert(docs.where("doc_id < 4"))
    assert index.shards == 2 and index.filters().count() == 0
    index.insert(docs.where("doc_id >= 4"))
    assert index.shards == 8 and {r["n_dropped"] for r in index.apply(docs).collect()} == {40}
    index.delete(docs.where("doc_id < 2"))
    assert {r["n_dropped"] for r in index.apply(docs).collect()} == {0}


def plain_score(model: quality_model.QualityModel, text: str | None) -> float:
    """The score of a text, word by word."""

    def index(word: str, seed: int) -> list[float]:
        x, out = xxhash.xxh64_intdigest(word, seed), [0.0] * quality_model.DIM
        for _ in range(quality_model.NONZERO):
            x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % 2**64
            x ^= x >> 32
            out[x % quality_model.DIM] += 1 if x >> 40 & 1 else -1
        size = max(math.sqrt(sum(v * v for v in out)), 1e-6)
        return [v / size for v in out]

    def shape(word: str) -> str:
        out = ""
        for c in word:
            c = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
            out += "" if out.endswith(c) else c
        return out

    words = (text or "").split()
    x = [0.0] * (2 * quality_model.DIM + quality_model.RATIOS)
    if words:
        for w in words:
            at = model.contexts.get(w.lower())
            own = [a + (float(model.matrix[at][k]) if at is not None else 0.0) for k, a in enumerate(index(w.lower(), 1))]
            for k, v in enumerate([*own, *index(shape(w), 2)]):
                x[k] += v / len(words)
        x[-3:] = [sum(a == b for a, b in zip(words, words[1:])) / len(words), len(set(words)) / len(words), math.log1p(len(words)) / 10]
    hidden = [math.tanh(sum((x[i] - model.mean[i]) / model.scale[i] * model.w1[i][j] for i in range(len(x))) + model.b1[j]) for j in range(len(model.b1))]
    return 1 / (1 + math.exp(-(sum(h * w for h, w in zip(hidden, model.w2)) + model.b2) / model.temperature))


def plain_sums(texts: list[str], rows: int) -> np.ndarray:
    """Neighbours' index vectors and numbers of words by row, word by word."""
    out = np.zeros((rows, quality_model.DIM + 1), np.int64)
    for t in texts:
        words = [w.lower() for w in t.split()]
        for i, w in enumerate(words):
            row = xxhash.xxh64_intdigest(w, 1) % rows
            out[row, -1] += 1
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                if j != i:
                    x = xxhash.xxh64_intdigest(words[j], 1)
                    for _ in range(quality_model.NONZERO):
                        x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % 2**64
                        x ^= x >> 32
                        out[row, x % quality_model.DIM] += 1 if x >> 40 & 1 else -1
    return out


def test_context_sums_against_plain(spark, data, monkeypatch):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("text").unionByName(spark.createDataFrame([(None,), ("",), ("One",), ("a a A b",)], "text string"))
    texts = [r["text"] or "" for r in docs.collect()]
    contexts = quality_model.HashedRows(101)
    want = plain_sums(texts, 101)
    assert (quality_model.corpus_context_sums(docs, "text", contexts) == want).all()
    monkeypatch.setattr(quality_model, "HELD_WORDS", 7)
    monkeypatch.setattr(quality_model, "MOST_WORDS", 50)
    assert (quality_model.context_sums(texts, contexts) == want).all()
    assert not quality_model.corpus_context_sums(docs.limit(0), "text", contexts).any()
    assert not quality_model.context_matrix(want * 0).any()


def test_quality_scores_against_plain(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    model = quality_model.fit_quality(docs, spark.read.parquet(f"{data}/labels.parquet"))
    odd = docs.where("length(text) < 4000").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "x" * 500 + " Aa1-" * 90)], "doc_id bigint, text string"))
    text = {r["doc_id"]: r["text"] for r in odd.collect()}
    for r in quality_model.score_quality(odd, model).collect():
        assert abs(r["score"] - plain_score(model, text[r["doc_id"]])) < 1e-4


def test_revisits_name_their_originals(spark, tmp_path):
    pages = spark.createDataFrame([("a", "http://x/1", "<p>same"), ("b", "http://x/2", "<p>same"), ("c", None, "<p>other")], "page_id string, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/w")
    rows = {r["page_id"]: r for r in warc.read_archives(spark, f"{tmp_path}/w", id_type="string").collect()}
    assert rows["a"]["record_type"] == "revisit" and rows["a"]["refers_to_record"] == rows["b"]["record_id"]
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.deduplicate_archives(pages).collect()}
    assert got == {"a": ("revisit", "b", 7), "b": ("response", None, 7), "c": ("response", None, 8)}


CLASHES = "score string, held_out string, predicted string, n_lines string, n_dropped string, kept_sha256 string, t1 string, c0 string"


def test_stages_on_odd_rows(spark, tmp_path, data):
    item = "one two three four five six seven eight nine"
    texts = [None, "", "  \n\t", "plain words of a text\nand a line of its own", "plain words of a text\nand a line of its own", f"before {item} after", item.replace("nine", "x"), "w " * 30_000, "é😀 ünï\nshared", *(f"shared\nown words number {i} here" for i in range(12))]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + CLASHES
    rows = [(None if i == 3 else i, t, "en", "s", 5, *(["mine"] * 8)) for i, t in enumerate(texts)]
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(5, 1), (7, 0), (None, 1), (8, None)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, names)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert all(r["score"] == r["n_lines"] == r["t1"] == "mine" for r in out.collect())
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    cut = corpus_pipeline.drop_common_lines(spark, docs, str(tmp_path))
    assert cut.count() == len(rows) and {r["text"] for r in cut.where("doc_id > 8").collect()} == {f"own words number {i} here" for i in range(12)}
    assert cut.where("doc_id = 9").head()["n_chars"] == len("own words number 0 here")
    clean = [r["text"] for r in corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()]
    assert len(clean) == len(rows) - 2 and not any(t and item[:30] in t for t in clean)
    kept = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()]
    assert 0 in kept and 1 not in kept and 4 in kept
    assert corpus_pipeline.encode(spark, docs, str(tmp_path)).count() == len(rows) and corpus_pipeline.encode(spark, docs.limit(0), str(tmp_path)).count() == 0
