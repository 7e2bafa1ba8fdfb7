"""Near-duplicate groups by SimHash fingerprints and Golay-code fuzzy hashing.

The binary Golay code of length 23 is perfect: every word of 23 bits is within 3 bits of just one of its 4,096 codewords (the
*home*).  Within 4 bits lie that one and, where it is 3 bits away, five more.  Two words at most 2 bits apart share one of
their codewords within 4 bits, for the home of a word half way is within 3 + 1 bits of both; if they are 1 bit apart, the home
of each is among the other's.

A fingerprint is cut into segments of 23, 23 and 18 bits (the last is padded).  If at most 4 bits differ, the two segments with
the fewest differences have at most 2 together, so some pair of segments differs by (0, at most 2) or (1, 1).  For each pair the keys are

* one segment as it is, with each codeword near the other: these meet where the differences are (0, at most 2);
* the home of the one with each codeword near the other, and the other way round, each with the codewords near the third
  segment: these meet where they are (1, 1), for the third then differs in 2 bits at most.

That is about 120 keys of 35 or 36 bits for a fingerprint.  Fingerprints that share a key are compared, and kept as links
if at most 4 bits differ.  No link is lost.

Only different fingerprints get keys.  Within a key, links are searched from node to node, so that each fingerprint is reached
once instead of once from each neighbour, and a task gives back one link for each fingerprint at most.  Keys with over ``BLOCK``
fingerprints are put off while they stream by, cut into blocks, and compared by pairs of blocks in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paralith.llm.common import positional, text_digest, written
from paralith.llm.components import connected_components

GENERATOR = 0xC75
SEGMENTS = ((0, 23), (23, 23), (46, 18))
MOST_BITS = 4
BLOCK = 2048
SMALL = 24


# ---- fingerprints --------------------------------------------------------------------------------------------------


def fingerprint(text: bytes, words_each: int = 4, seed: int = 42) -> int:
    """The majority of each bit over the XXH64 hashes of all shingles, repeats included; 0 without words.

    A-Z is lower-cased and words end at ASCII white space; a text of fewer words than a shingle is one shingle.
    """
    words = text.lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    n = len(words) - words_each + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(whole, seed)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(whole[a:b], seed) for a, b in zip(starts, ends[words_each - 1 :], strict=True)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        ones += np.unpackbits(h[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words_each: int = 4, seed: int = 42) -> DataFrame:
    """id, t1, t2 (digest of the text), fp (the fingerprint's 64 bits as a bigint) of every row."""
    inner, (doc_id, text) = positional(docs, id_col, text_col)
    whole = F.coalesce(F.col(text), F.lit(""))
    kind = inner.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, words_each, seed) for t in batch.column("t").cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column("id"), batch.column("t1"), batch.column("t2"), pa.array(fp)], names=["id", "t1", "t2", "fp"])

    return inner.select(F.col(doc_id).alias("id"), *text_digest(whole), whole.alias("t")).mapInArrow(run, f"id {kind}, t1 bigint, t2 bigint, fp bigint")


# ---- Golay keys ----------------------------------------------------------------------------------------------------


def _remainder(v: int) -> int:
    for bit in range(22, 10, -1):
        if v >> bit & 1:
            v ^= GENERATOR << (bit - 11)
    return v


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the 12 upper bits; for each remainder the differences to the codewords within 4 bits (the home first), and how many there are."""
    upper = np.array([_remainder(m << 11) for m in range(4096)], np.uint32)
    near: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for places in combinations(range(23), weight):
            difference = sum(1 << p for p in places)
            near[_remainder(difference)].append(difference)
    count = np.array([len(x) for x in near])
    return upper, np.array([x + x[:1] * (6 - len(x)) for x in near], np.uint32), count


_golay: list = []


def near_codewords(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (12 bits) of the codewords within 4 bits of each 23-bit word, six columns with the home first, and which columns hold one."""
    if not _golay:
        _golay.extend(_tables())
    upper, near, count = _golay
    remainder = upper[v >> 11] ^ (v & 0x7FF)
    return (v[:, None] ^ near[remainder]) >> 11, np.arange(6) < count[remainder][:, None]


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints (unsigned 64-bit), and for each key the place of its fingerprint."""
    segments = [((fp >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.uint32) for a, n in SEGMENTS]
    coded = [near_codewords(s) for s in segments]
    keys, places = [], []
    rows = np.broadcast_to(np.arange(len(fp))[:, None], (len(fp), 6))

    def put(family: int, first: np.ndarray, second: np.ndarray, there: np.ndarray) -> None:
        key = np.uint64(family << 40) | (np.broadcast_to(first, there.shape).astype(np.uint64) << np.uint64(12)) | np.broadcast_to(second, there.shape).astype(np.uint64)
        keys.append(key[there])
        places.append(rows[there])

    for n, (i, j, k) in enumerate(((0, 1, 2), (0, 2, 1), (1, 2, 0))):
        (near_i, there_i), (near_j, there_j), (near_k, there_k) = coded[i], coded[j], coded[k]
        put(3 * n, segments[i][:, None], near_j, there_j)
        put(3 * n + 1, segments[j][:, None], near_i, there_i)
        for c in range(6):  # with each codeword near the third
            third = there_k[:, c : c + 1]
            put(3 * n + 2, near_i[:, :1] << np.uint32(12) | near_j, np.broadcast_to(near_k[:, c : c + 1], near_j.shape), there_j & third)
            other = there_i & third
            other[:, 0] = False  # home with home is there already
            put(3 * n + 2, near_i << np.uint32(12) | near_j[:, :1], np.broadcast_to(near_k[:, c : c + 1], near_i.shape), other)
    return np.concatenate(keys), np.concatenate(places)


# ---- links ---------------------------------------------------------------------------------------------------------


def walk_links(fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the fingerprints of ``fp`` as all links of at most ``most`` bits do: every one is reached once."""
    ends: list[np.ndarray] = []
    rest = np.unique(fp)
    while len(rest):
        stack, rest = [rest[0]], rest[1:]
        while stack and len(rest):
            node = stack.pop()
            near = np.bitwise_count(rest ^ node) <= most
            if near.any():
                ends.append(np.stack([np.full(int(near.sum()), node), rest[near]]))
                stack.extend(rest[near])
                rest = rest[~near]
    found = np.concatenate(ends, axis=1) if ends else np.zeros((2, 0), np.uint64)
    return found[0], found[1]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star links with the components of the links a-b: one for each node that is not the least of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        low = np.minimum(label[i], label[j])
        for side in (i, j, label[i], label[j]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


class _Links:
    """Links found by a task so far, as a forest once there are many."""

    def __init__(self) -> None:
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.n = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.n += len(a)

    def reduced(self) -> None:
        if self.n:
            a, b = forest(np.concatenate(self.a), np.concatenate(self.b))
            self.a, self.b, self.n = [a], [b], len(a)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.reduced()
        out = (self.a[0], self.b[0]) if self.n else (np.zeros(0, np.uint64),) * 2
        self.__init__()
        return out


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    return starts, np.diff(np.append(starts, len(key)))


def link_runs(key: np.ndarray, fp: np.ndarray, most: int, links: _Links) -> None:
    """Links within each run of equal keys, of at most BLOCK fingerprints."""
    starts, size = _runs(key)
    each = np.repeat(size, size)
    small = (each > 1) & (each <= SMALL)
    k, f = key[small], fp[small]
    for d in range(1, int(each[small].max()) if small.any() else 0):
        same = (k[d:] == k[:-d]) & (np.bitwise_count(f[d:] ^ f[:-d]) <= most) & (f[d:] != f[:-d])
        links.add(f[:-d][same], f[d:][same])
    for s in np.flatnonzero(size > SMALL):
        links.add(*walk_links(fp[starts[s] : starts[s] + size[s]], most))


def fuzzy_links(different: DataFrame, most: int = MOST_BITS, block: int = BLOCK) -> DataFrame:
    """a, b: links that connect the fingerprints of ``different`` (fp bigint, no repeats) as all links of at most ``most`` (4 or fewer) bits do."""
    if most > MOST_BITS:
        raise ValueError(f"keys meet up to {MOST_BITS} differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            key, place = fuzzy_keys(fp)
            for at in range(0, len(key), 200_000):
                yield pa.record_batch([pa.array(key[at : at + 200_000].view(np.int64)), pa.array(fp[place[at : at + 200_000]].view(np.int64))], names=["k", "fp"])

    names = ["kind", "k", "b", "x", "y"]

    def rows(kind: int, k: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.full(len(x), kind, np.int32)), *(pa.array(v.view(np.int64)) for v in (k, b, x, y))], names=names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links (kind 0: x, y) of the keys in order, and the fingerprints (kind 1: k, block b, x) of keys put off."""
        links, key, fp = _Links(), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        off: tuple[np.uint64, int] | None = None  # the key that is being put off, and how many so far

        def put_off(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            nonlocal off
            had = off[1] if off and off[0] == k[0] else 0
            off = (k[0], had + len(k))
            return rows(1, k, (had + np.arange(len(k))) // block, f, f)

        def done(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Whole runs, and the last run's part if it is put off."""
            if not len(k):
                return
            starts, size = _runs(k)
            large = (size > block) | ((k[starts] == off[0]) if off else False)
            for s in np.flatnonzero(large):
                yield put_off(k[starts[s] : starts[s] + size[s]], f[starts[s] : starts[s] + size[s]])
            keep = np.repeat(~large, size)
            link_runs(k[keep], f[keep], most, links) if keep.any() else None
            if links.n > 400_000:
                links.reduced()

        for batch in batches:
            key = np.concatenate([key, batch.column("k").to_numpy().view(np.uint64)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(key):
                continue
            last = int(np.searchsorted(key.view(np.int64), key.view(np.int64)[-1]))
            yield from done(key[:last], fp[:last])
            key, fp = key[last:], fp[last:]
            if len(key) > block or (off and len(key) and off[0] == key[0]):
                yield put_off(key, fp)
                key, fp = key[:0], fp[:0]
        yield from done(key, fp)
        a, b = links.take()
        yield rows(0, a, a, a, b)

    found = written(
        different.select("fp").mapInArrow(keyed, "k bigint, fp bigint").repartition("k").sortWithinPartitions("k").mapInArrow(search, "kind int, k bigint, b bigint, x bigint, y bigint"), "fuzzy")
    links = found.where("kind = 0").select(F.col("x").alias("a"), F.col("y").alias("b"))
    late = found.where("kind = 1").select("k", "b", F.col("x").alias("fp"))
    if late.take(1):
        blocks = late.groupBy("k").agg(F.max("b").alias("last"))
        others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("last")), lambda o: o != F.col("b"))
        pairs = late.join(blocks, "k").select("k", "b", "fp", F.explode(others).alias("o")).select("k", F.least("b", "o").alias("p"), F.greatest("b", "o").alias("q"), "fp")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Links within each pair of blocks; a pair is held at a time."""
            found, held, at = _Links(), [], None
            for batch in batches:
                where = list(zip(*(batch.column(c).to_pylist() for c in ("k", "p", "q")), strict=True))
                fp = batch.column("fp").to_numpy().view(np.uint64)
                start = 0
                for n in range(1, len(where) + 1):
                    if n == len(where) or where[n] != where[start]:
                        if where[start] != at:
                            found.add(*walk_links(np.concatenate(held), most)) if held else None
                            held, at = [], where[start]
                        held.append(fp[start:n])
                        start = n
                if found.n > 400_000:
                    found.reduced()
            found.add(*walk_links(np.concatenate(held), most)) if held else None
            a, b = found.take()
            yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        links = links.unionByName(pairs.repartition("k", "p", "q").sortWithinPartitions("k", "p", "q").mapInArrow(compare, "a bigint, b bigint"))
    return links


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 4, most: int = MOST_BITS, seed: int = 42) -> DataFrame:
    """One row for each row of ``docs``: id, t1, t2 (digest of the text), fp (bigint), root (the group's least fingerprint) and component_id.

    Texts are linked if their fingerprints differ in ``most`` bits or fewer; component_id is the smallest id reachable over
    links, the text's own included.  Null and empty texts have fingerprint 0 and are linked like others.  Null ids are left
    out of the smallest (a component of null ids only has null).  Repeated rows stay; an empty table gives an empty table.
    """
    prints = written(fingerprints(docs, id_col, text_col, words_each, seed), "prints")
    different = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected_components(fuzzy_links(different, most))
    placed = written(different.join(roots, different["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "placed")
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = written(placed.join(smallest, "root").select(F.col("fp").alias("of"), "root", "component_id"), "groups")  # a table, so that a fingerprint of many rows can be split
    return prints.join(groups, F.col("fp") == F.col("of")).select("id", "t1", "t2", "fp", "root", "component_id")


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their group: one document of each.

    Rows that repeat a kept document's id and text are left out too; if different texts of a group share the id, the one
    with the least digest stays.  Where a group has null ids only, the text with the least digest stays.  Columns are those of ``docs``.
    """
    groups = simhash_groups(docs, id_col, text_col, **options)
    chosen = groups.where(F.col("id").eqNullSafe(F.col("component_id")))
    kept = written(chosen.groupBy("id", "root").agg(F.min(F.struct("t1", "t2")).alias("d")).select(F.col("id").alias("kid"), F.col("d.t1").alias("k1"), F.col("d.t2").alias("k2")), "kept")
    inner, (doc_id, text) = positional(docs, id_col, text_col)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = inner.withColumns({"t1": text_digest(whole)[0], "t2": text_digest(whole)[1]})
    out = rows.join(kept, (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2")) & F.col(doc_id).eqNullSafe(F.col("kid")), "left_semi").dropDuplicates(["t1", "t2", doc_id])
    return out.select(*inner.columns).toDF(*docs.columns)
