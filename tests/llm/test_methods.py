"""Methods against plain versions of themselves."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paralith.llm import components, html_text, line_dedup, pieces, pii, quality_model, quality_rules, secret_scan, simhash, warc
from tests.llm import brute


def test_cuckoo_filter_is_reversible():
    rng = np.random.default_rng(2)
    hi, lo = rng.integers(-(2**63), 2**63, (2, 3000), dtype=np.int64)
    f = line_dedup.CuckooFilter.sized(3000)
    before = f.dump()
    assert f.insert(hi, lo) and f.contains(hi, lo).all()
    other = rng.integers(-(2**63), 2**63, (2, 20_000), dtype=np.int64)
    assert f.contains(*other).mean() < 0.002
    f = line_dedup.CuckooFilter.load(f.buckets, f.dump())
    f.delete(hi[:1500], lo[:1500])
    assert f.contains(hi[1500:], lo[1500:]).all() and f.contains(hi[:1500], lo[:1500]).mean() < 0.01
    f.delete(hi[1500:], lo[1500:])
    assert f.dump() == before
    assert not line_dedup.CuckooFilter(4).insert(hi[:40], lo[:40])


def test_line_index_takes_back_documents(spark):
    docs = spark.createDataFrame([(i, f"common\nline {i}\n{'even' if i % 2 == 0 else 'odd'}") for i in range(24)], "doc_id int, text string")
    index = line_dedup.LineIndex(spark, threshold=10, shards=4).insert(docs)
    state = sorted(map(tuple, index.counts().collect()))
    assert index.apply(docs).where("n_dropped = 2").count() == 24
    late = spark.createDataFrame([(100 + i, "line 3\nCOMMON ") for i in range(9)], "doc_id int, text string")
    index.insert(late)
    assert index.apply(docs).where("doc_id = 3").head()["text"] == ""
    index.delete(late)
    assert sorted(map(tuple, index.counts().collect())) == state
    assert index.apply(docs).where("doc_id = 3").head()["text"] == "line 3"
    index.delete(docs.where("doc_id >= 9"))
    assert index.apply(docs).where("n_dropped > 0").count() == 0
    new = spark.createDataFrame([(1, "never seen")], "doc_id int, text string")
    assert index.apply(new).head()["text"] == "never seen"


def plain_fingerprint(text: str) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=40, deadline=None)
@given(st.text("aB \n\té", max_size=60))
def test_fingerprints(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_hash_is_sparks(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).head()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_every_close_pair_shares_a_key():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for p in rng.choice(64, rng.integers(1, 5), replace=False):
            b[i] ^= np.uint64(1 << int(p))
    sets = []
    for x in (a, b):
        key, place = simhash.fuzzy_keys(x)
        own = [set() for _ in x]
        for k, p in zip(key.tolist(), place.tolist(), strict=True):
            own[p].add(k)
        sets.append(own)
    assert all(x & y for x, y in zip(*sets, strict=True))


def plain_components(fps: list[int], most: int = 4) -> dict[int, int]:
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= most:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {x: find(x) for x in fps}


@pytest.mark.parametrize("block", [40, 2048])
def test_links_of_a_crowded_neighbourhood(spark, block):
    r = random.Random(6)
    base, fps = r.getrandbits(62), set()
    for _ in range(400):
        fps.add(base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 6))))
    fps |= {r.getrandbits(63) for _ in range(200)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp bigint")
    got = {r["node"]: r["root"] for r in components.connected_components(simhash.fuzzy_links(df, 4, block)).collect()}
    want = plain_components(sorted(fps))
    groups = lambda pairs: sorted(sorted(g) for g in pairs if len(g) > 1)
    by = lambda m: [[k for k in m if m[k] == v] for v in set(m.values())]
    assert groups(by(got)) == groups([[signed(x) for x in g] for g in by(want)])


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components.connected_components(links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_near_duplicates_against_plain(spark, data):
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet'").fetchall())
    fps = {d: plain_fingerprint(t or "") for d, t in docs.items()}
    root = plain_components(sorted(set(fps.values())))
    least: dict[int, int] = {}
    for d in sorted(docs, reverse=True):
        least[root[fps[d]]] = d
    for r in entry.queries()["op2_simhash"](spark, data).collect():
        assert (int(r["fingerprint"], 16), r["component_id"]) == (fps[r["doc_id"]], least[root[fps[r["doc_id"]]]])


def test_main_text_of_held_out_pages():
    model = html_text.default_model()
    hit = said = truth = 0
    for page in html_text.labelled_pages(120, seed=77):
        want = Counter(w for n in html_text.parse(page) if n.tag == "#text" and html_text.MARK in n.text for w in n.text.replace(html_text.MARK, "").split())
        got = Counter(model.main_text(page.replace(html_text.MARK, "")).split())
        hit, said, truth = hit + (want & got).total(), said + got.total(), truth + want.total()
    assert hit / said > 0.97 and hit / truth > 0.97


def test_main_text_of_the_pages(spark, data):
    import html

    for r in entry.queries()["op3_main_text"](spark, data).join(spark.read.parquet(f"{data}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search("<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        blocks = re.sub("</?b>", "", re.sub("</?(?:p|h1|br)>", "\x00", inner)).split("\x00")
        assert r["text"] == " ".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)


def test_messages_give_the_exact_marginals():
    """Against the sum over all labellings of a small tree."""
    from itertools import product
    from math import exp, log

    model = html_text.default_model()
    nodes = html_text.parse('<div class="ad">buy <a href=x>now</a></div><p>A text.')
    weight = [sum(model.weights.get(f, 0.0) for f in fs) for fs in html_text._features(nodes)]
    total = [[0.0, 0.0] for _ in nodes]
    for y in product((0, 1), repeat=len(nodes)):
        p = exp(sum(w for w, v in zip(weight, y, strict=True) if v))
        for i, n in enumerate(nodes[1:], 1):
            share = (model.edges.get(n.kind) or model.edges.get(n.tag, model.edges[""]))[y[n.parent]]
            p *= share if y[i] else 1 - share
        for i, v in enumerate(y):
            total[i][v] += p
    assert np.allclose(model.marginals(nodes), [log(b / a) for a, b in total])


@settings(max_examples=60, deadline=None)
@given(st.text("ab ▁\n\té😀<s>", max_size=40))
def test_pieces_are_the_librarys(text):
    e = pieces.encoder("piece_bpe_32k.model")
    assert np.frombuffer(e.encode(text), "<u4").tolist() == [1, *e.model.encode(text), 2]


def test_pieces_of_documents(spark, data):
    import hashlib

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path("piece_bpe_32k.model"))
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet'").fetchall())
    for r in entry.queries()["op4_pieces"](spark, data).collect():
        ids = sp.encode(docs[r["doc_id"]] or "", add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


PERSONAL = [
    "a@b.c d.e+f@g-h.i.j x@y z@.k", "a@b.co_m@n.op", "a@b@c.de", "1.2.3.4.5.6.7.8 256.1.1.1 007.1.1.1 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111111",
    "4111 1111 1111 1111 2", "+1 (555) 010-9999 +12 34 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "++49.30.1234567-", "1 " * 5000, "a" * 20_000 + "@b.c", "9" * 20_000, ".a@b.c.d.e" * 300,
]


def test_personal_data_against_plain(spark):
    docs = spark.createDataFrame(list(enumerate(PERSONAL)), "doc_id int, text string")
    for r in pii.find_personal_data(docs).collect():
        assert r["base_sha256"] == brute.sha(brute.listed(brute.personal_base(PERSONAL[r["id"]]))), PERSONAL[r["id"]][:60]


def test_labelers_add_what_they_agree_on(spark):
    r = random.Random(1)
    texts = [f"please call my phone {r.randint(200, 999)}-{r.randint(200, 999)}-{r.randint(1000, 9999)} today, mail u{i}@site{i}.com" for i in range(60)]
    texts += [f"order {r.randint(100, 199)}-{r.randint(100, 999)}-{r.randint(1000, 9999)} shipped" for _ in range(40)] + ["nothing here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {x["id"]: x["spans"] for x in pii.find_personal_data(docs).collect()}
    assert all("phone:" in got[i] and "email:" in got[i] for i in range(60)) and not any(got[i] for i in range(60, 101))


def test_em_finds_the_reliable_labelers():
    r = random.Random(2)
    counts: Counter = Counter()
    truth: dict = {}
    for _ in range(4000):
        good = r.random() < 0.4
        vote = tuple((1 if good else -1) if r.random() < a else (-1 if good else 1) for a in (0.95, 0.9, 0.85, 0.6))
        counts[vote] += 1
        truth.setdefault(vote, []).append(good)
    p = pii.expectation_maximisation(list(counts.items()))
    right = sum(sum(g == (p[v] > 0.5) for g in gs) for v, gs in truth.items())
    assert right / 4000 > 0.93
    assert pii.expectation_maximisation([]) == {}


SECRETS = [
    "token=secret=abcdefgh1 PASSWORD : 'x1234567' api_key=short apikey\"=\"longenough", "secret = secret : longenough1", "AKIA1234567890AB AKIAAKIA1234567890 AKIA12", "é " + "0123456789abcdef" * 2 + "G" + "f" * 31, "paſſword=abcdefgh1",
    "token:" + "a" * 10_000, "deadbeef" * 3000,
]


def test_secrets_against_plain(spark):
    docs = spark.createDataFrame(list(enumerate(SECRETS)), "doc_id int, text string")
    for r in secret_scan.secret_report(docs).collect():
        assert r["base_sha256"] == brute.sha(brute.listed(brute.secret_base(SECRETS[r["id"]]))), SECRETS[r["id"]][:60]


def test_ledger_scans_what_it_has_not_seen(spark, tmp_path):
    ledger = str(tmp_path)
    one = spark.createDataFrame([(1, "token=abcdefgh1"), (2, "token=abcdefgh1"), (3, "clean")], "doc_id int, text string")
    first = secret_scan.BASE_RULES[:1]
    assert sorted(r["id"] for r in secret_scan.scan_secrets(one, first, ledger).collect() if r["found"]) == [1, 2]
    seen = lambda: sorted((r["blob"], tuple(r["rules"])) for r in spark.read.parquet(f"{ledger}/scanned").collect())
    assert len(seen()) == 2 and {x for _, x in seen()} == {("assign@1",)}
    two = spark.createDataFrame([(1, "token=abcdefgh1"), (4, "AKIA1234567890AB"), (5, "token=abcdefgh1")], "doc_id int, text string")
    out = {r["id"]: [f["rule"] for f in r["found"]] for r in secret_scan.scan_secrets(two, secret_scan.BASE_RULES, ledger).collect()}
    assert out == {1: ["assign@1"], 4: ["access@1"], 5: ["assign@1"]}
    assert sorted(Counter(rules for _, rules in seen()).items()) == [(("access@1", "hex@1"), 1), (("assign@1",), 2), (("assign@1", "access@1", "hex@1"), 1)]
    before = len(seen())
    secret_scan.scan_secrets(two, secret_scan.BASE_RULES, ledger).count()
    assert len(seen()) == before


def test_warc_payloads_come_back(spark, data, tmp_path):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    warc.write_archives(pages, f"{tmp_path}/w")
    back = warc.read_archives(spark, f"{tmp_path}/w").where("record_type = 'response'")
    assert back.where("payload_digest <> stated_digest").count() == 0
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in back.collect():
        assert r["html"] == html[r["page_id"]]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("a\r\nW/", max_size=12), max_size=5), st.integers(1, 7))
def test_record_streams(bodies, size):
    raw = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(b), b.encode()) for b in bodies)
    assert [b for _, b in warc.parse_stream(iter([raw[i : i + size] for i in range(0, len(raw), size)]))] == [b.encode() for b in bodies]


def test_quality_of_held_out_documents(spark, data):
    scored = entry.queries()["op9_quality_model"](spark, data.replace("sf0.001", "sf0.01"))
    rows = scored.where("held_out").join(spark.read.parquet(f"{data.replace('sf0.001', 'sf0.01')}/labels.parquet"), "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95


def test_labels_outside_training_change_nothing():
    texts = [f"good plain words number {i} about the sea" for i in range(30)] + [f"JUNK!! $$$ {i} ### &&&" for i in range(30)]
    model = quality_model.train(texts, [1] * 30 + [0] * 30)
    v = quality_model.WordVectors(model.contexts, model.matrix)
    good, bad = model.scores(np.array([v.pooled("other plain words about the land"), v.pooled("MORE!! $$$ ###")], float))
    assert good > 0.7 > bad and 0.4 < model.temperature < 9


def plain_repeats(words: list, window: int = 8) -> int:
    grams = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    often = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(window)})


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60))
def test_repeated_words(words):
    assert quality_rules.repeated_words(words) == plain_repeats(words)


def test_quality_rules_against_plain(spark, data):
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet'").fetchall())
    good = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{data}/labels.parquet' WHERE quality = 1").fetchall()}
    token = re.compile(r"\w+|[^\w\s]+")
    raw, target = np.zeros((2, quality_rules.BUCKETS), np.int64)
    of = {}
    for d, t in docs.items():
        h = [int.from_bytes(xxhash.xxh32_digest(w), "little") for w in token.findall(t or "")]
        pairs = [((a * 0x9E3779B97F4A7C15 + b) * 0xBF58476D1CE4E5B9 % 2**64) >> 40 for a, b in zip(h, h[1:])]
        of[d] = [x % quality_rules.BUCKETS for x in h + pairs]
        for x in of[d]:
            raw[x] += 1
            target[x] += d in good
    ratio = quality_rules.log_ratios(raw, target)
    for r in entry.queries()["op10_quality_rules"](spark, data).collect():
        t = docs[r["doc_id"]] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        base = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), plain_repeats(words))
        assert base == tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        llr = float(ratio[of[r["doc_id"]]].mean()) if of[r["doc_id"]] else 0.0
        assert r["base_failed"] == failed and abs(r["llr"] - llr) < 1e-9 and r["kept"] == (not failed and llr >= quality_rules.THRESHOLD)
