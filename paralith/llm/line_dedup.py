"""Reversible line deduplication over an index of sharded cuckoo filters and exact reference counts.

``LineIndex`` keeps two tables in a folder that driver and executors share:

* the reference counts ``(hi, lo, n)``: for each line key (its 128-bit XXH3 digest) the exact number of documents that hold it;
* the filters ``(shard, buckets, slots)``: one cuckoo filter a shard, over the keys whose count has reached the threshold.

Documents are inserted and deleted in batches.  A batch becomes count changes (+n or -n for each key), the changes are added to
the counts, and just the keys that cross the threshold are inserted into or deleted from the filters of their shards.  Deleting
a batch therefore undoes its insertion.  Every batch writes a new version of both tables, so a job that dies half way leaves
the last version as it was.

A lookup routes (document, key) pairs to the filter of their shard, in ``SALTS`` salted copies so that a line held by a
third of all documents is spread over that many tasks, and checks what passes against the counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from paralith.llm.common import positional, shared_path, text_digest, written

SPACE = b" \t\n\x0b\x0c\r"
SALTS = 32
SLOTS = 4
MAX_KICKS = 500
KEYS_EACH = 100_000


def line_key(line: bytes) -> bytes:
    """The key of a line: white space of ASCII stripped at both ends, A-Z lower-cased."""
    return line.strip(SPACE).lower()


def key_digest(key: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(key)
    return _signed(d >> 64), _signed(d & 0xFFFFFFFFFFFFFFFF)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys_of(text: bytes, min_chars: int) -> set[bytes]:
    keys = {line.strip(SPACE) for line in text.lower().split(b"\n")}
    if min_chars <= 1:
        keys.discard(b"") if min_chars == 1 else None
        return keys
    return {k for k in keys if len(k.decode("utf-8", "replace")) >= min_chars}


# ---- cuckoo filter -------------------------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on unsigned words."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class CuckooFilter:
    """Partial-key cuckoo hashing with 16-bit fingerprints, four slots a bucket and a power of two of buckets."""

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        self.buckets = buckets
        self.slots = np.zeros((buckets, SLOTS), dtype=np.uint16) if slots is None else slots

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        n = 4
        while n * SLOTS * 0.85 < keys:
            n *= 2
        return cls(n)

    @classmethod
    def load(cls, buckets: int, raw: bytes) -> CuckooFilter:
        return cls(buckets, np.frombuffer(raw, dtype="<u2").reshape(buckets, SLOTS).copy())

    def dump(self) -> bytes:
        return self.slots.astype("<u2").tobytes()

    def places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of each key."""
        mask = np.uint64(self.buckets - 1)
        finger = (_mix(hi) & np.uint64(0xFFFF)).astype(np.uint16)
        finger[finger == 0] = 1
        one = _mix(lo) & mask
        return finger, one, self._other(one, finger)

    def _other(self, bucket: np.ndarray, finger: np.ndarray) -> np.ndarray:
        return (bucket ^ _mix(finger.astype(np.uint64))) & np.uint64(self.buckets - 1)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        finger, one, two = self.places(hi, lo)
        want = finger[:, None]
        return (self.slots[one.astype(np.int64)] == want).any(1) | (self.slots[two.astype(np.int64)] == want).any(1)

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """False if some key found no place: the caller rebuilds the filter at twice the size."""
        finger, one, two = self.places(hi, lo)
        rest = np.arange(len(finger))
        for bucket in (one.astype(np.int64), two.astype(np.int64)):
            for slot in range(SLOTS):  # one key a bucket at a time, all buckets at once
                free = rest[self.slots[bucket[rest], slot] == 0]
                chosen = free[np.unique(bucket[free], return_index=True)[1]]
                self.slots[bucket[chosen], slot] = finger[chosen]
                rest = np.setdiff1d(rest, chosen, assume_unique=True)
        return all(self._put(int(two[i]), int(finger[i])) or self._kick(int(two[i]), int(finger[i])) for i in rest)

    def _put(self, bucket: int, finger: int) -> bool:
        free = np.flatnonzero(self.slots[bucket] == 0)
        if not len(free):
            return False
        self.slots[bucket, free[0]] = finger
        return True

    def _kick(self, bucket: int, finger: int) -> bool:
        for n in range(MAX_KICKS):
            slot = (finger + n) % SLOTS
            finger, self.slots[bucket, slot] = int(self.slots[bucket, slot]), finger
            bucket = int(self._other(np.array([bucket], np.uint64), np.array([finger], np.uint16))[0])
            if self._put(bucket, finger):
                return True
        return False

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Remove one copy of each key's fingerprint; the keys must have been inserted."""
        finger, one, two = self.places(hi, lo)
        rest = np.arange(len(finger))
        for bucket in (one.astype(np.int64), two.astype(np.int64)):
            for slot in range(SLOTS):
                there = rest[self.slots[bucket[rest], slot] == finger[rest]]
                chosen = there[np.unique(bucket[there], return_index=True)[1]]
                self.slots[bucket[chosen], slot] = 0
                rest = np.setdiff1d(rest, chosen, assume_unique=True)


# ---- index ---------------------------------------------------------------------------------------------------------


class LineIndex:
    """The counts and filters of a corpus of lines; see the module's description.

    ``threshold``: documents that must hold a key before its lines are dropped.  ``min_chars``: code points a key must
    have to be counted at all.  Each input row is one document: repeated rows count as often as they occur.  Null and
    empty texts hold one empty line.  ``shards`` is where the number of filters begins; it is doubled, and the filters are made
    anew from the counts, while a shard would have over ``keys_each`` frequent keys.
    """

    def __init__(self, spark: SparkSession, threshold: int = 10, min_chars: int = 1, shards: int = 64, path: str | None = None, keys_each: int = KEYS_EACH):
        if shards & (shards - 1):
            raise ValueError("shards must be a power of two")
        self.spark, self.threshold, self.min_chars, self.shards, self.keys_each = spark, threshold, min_chars, shards, keys_each
        self.path = path or shared_path(spark, "line-index")
        self.version = 0

    COUNTS = "hi bigint, lo bigint, n bigint"
    FILTERS = "shard int, buckets int, slots binary"

    def counts(self) -> DataFrame:
        """hi, lo, n: the exact reference counts."""
        if not self.version:
            return self.spark.createDataFrame([], self.COUNTS)
        return self.spark.read.schema(self.COUNTS).parquet(f"{self.path}/v{self.version}/counts")

    def filters(self) -> DataFrame:
        """shard, buckets, slots: the cuckoo filters; shards without frequent keys have none."""
        if not self.version:
            return self.spark.createDataFrame([], self.FILTERS)
        return self.spark.read.schema(self.FILTERS).parquet(f"{self.path}/v{self.version}/filters")

    def insert(self, docs: DataFrame, text_col: str = "text") -> LineIndex:
        """Count the lines of ``docs``."""
        return self._change(docs, text_col, 1)

    def delete(self, docs: DataFrame, text_col: str = "text") -> LineIndex:
        """Take back the lines of ``docs``, which must have been inserted before."""
        return self._change(docs, text_col, -1)

    def _change(self, docs: DataFrame, text_col: str, sign: int) -> LineIndex:
        inner, (text,) = positional(docs, text_col)
        min_chars, threshold = self.min_chars, self.threshold

        def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n: Counter = Counter()
                for t in batch.column(0).cast(pa.binary()).to_pylist():
                    n.update(_keys_of(t, min_chars))
                ids = [key_digest(k) for k in n]
                yield pa.record_batch([pa.array([i[0] for i in ids], pa.int64()), pa.array([i[1] for i in ids], pa.int64()), pa.array(list(n.values()), pa.int64())], names=["hi", "lo", "d"])

        delta = inner.select(F.coalesce(F.col(text), F.lit("")).alias("t")).mapInArrow(tally, "hi bigint, lo bigint, d bigint").withColumn("d", F.col("d") * sign)
        old = self.counts().select("hi", "lo", F.lit(0).cast("bigint").alias("d"), "n")
        new = (
            delta.select("hi", "lo", "d", F.lit(0).cast("bigint").alias("n")).unionByName(old)
            .groupBy("hi", "lo").agg(F.sum("d").alias("d"), F.sum("n").alias("was"))
            .select("hi", "lo", (F.col("was") + F.col("d")).alias("n"), "was")
        )
        at = f"{self.path}/v{self.version + 1}"
        new.where("n > 0 or was > 0").write.parquet(f"{at}/changed")
        changed = self.spark.read.schema(self.COUNTS + ", was bigint").parquet(f"{at}/changed")
        changed.where("n > 0").drop("was").write.parquet(f"{at}/counts")
        frequent = self.spark.read.schema(self.COUNTS).parquet(f"{at}/counts").where(F.col("n") >= threshold).select("hi", "lo")
        shards, n = self.shards, frequent.count()
        while shards * self.keys_each < n:
            shards *= 2
        anew, self.shards = shards != self.shards, shards
        shard = F.pmod("lo", F.lit(shards)).cast("int").alias("shard")
        hot = frequent.select(shard, "hi", "lo")
        crossed = hot.withColumn("on", F.lit(True)) if anew else changed.where((F.col("n") >= threshold) != (F.col("was") >= threshold)).select(shard, "hi", "lo", (F.col("n") >= threshold).alias("on"))
        old_filters = self.filters().limit(0) if anew else self.filters()

        def grow(key, olds, moves):
            """The shard's filter with the keys that crossed the threshold; None in place of slots where it must be rebuilt."""
            import pandas as pd

            add, drop = moves[moves["on"]], moves[~moves["on"]]
            f = CuckooFilter.load(int(olds["buckets"].iloc[0]), olds["slots"].iloc[0]) if len(olds) else CuckooFilter.sized(2 * len(add))
            f.delete(drop["hi"].to_numpy(), drop["lo"].to_numpy())
            ok = f.insert(add["hi"].to_numpy(), add["lo"].to_numpy())
            return pd.DataFrame({"shard": [int(key[0])], "buckets": [f.buckets], "slots": [f.dump() if ok else None]})

        old_filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(grow, self.FILTERS).write.parquet(f"{at}/grown")
        grown = self.spark.read.schema(self.FILTERS).parquet(f"{at}/grown")
        full = grown.where("slots is null").select("shard", F.col("buckets").alias("had"))

        def rebuild(key, had, keys):
            import pandas as pd

            if not len(had):
                return pd.DataFrame({"shard": [], "buckets": [], "slots": []})
            f = CuckooFilter(2 * int(had["had"].iloc[0]))
            while not f.insert(keys["hi"].to_numpy(), keys["lo"].to_numpy()):
                f = CuckooFilter(2 * f.buckets)
            return pd.DataFrame({"shard": [int(key[0])], "buckets": [f.buckets], "slots": [f.dump()]})

        fit = grown.where("slots is not null")
        if full.take(1):
            fit = fit.unionByName(full.groupBy("shard").cogroup(hot.join(full, "shard", "left_semi").groupBy("shard")).applyInPandas(rebuild, self.FILTERS))
        fit.write.parquet(f"{at}/filters")
        self.version += 1
        return self

    def frequent(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """t1, t2 (digest of a text), keys: the frequent keys of each different text of ``docs`` that has any."""
        inner, (text,) = positional(docs, text_col)
        min_chars, shards = self.min_chars, self.shards
        shape = "shard int, salt int, kind int, t1 bigint, t2 bigint, hi bigint, lo bigint, buckets int, slots binary"

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: tuple[list, list, list, list] = ([], [], [], [])
                texts, t1s, t2s = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
                for t, a, b in dict(zip(zip(t1s, t2s, strict=True), zip(texts, t1s, t2s, strict=True), strict=True)).values():
                    for k in _keys_of(t, min_chars):
                        hi, lo = key_digest(k)
                        for column, v in zip(out, (a, b, hi, lo), strict=True):
                            column.append(v)
                yield pa.record_batch([pa.array(c, pa.int64()) for c in out], names=["t1", "t2", "hi", "lo"])

        whole = F.coalesce(F.col(text), F.lit(""))
        rows = inner.select(whole.alias("t"), *text_digest(whole)).mapInArrow(pairs, "t1 bigint, t2 bigint, hi bigint, lo bigint").select(
            F.pmod("lo", F.lit(shards)).cast("int").alias("shard"), F.pmod("t2", F.lit(SALTS)).cast("int").alias("salt"), F.lit(1).alias("kind"),
            "t1", "t2", "hi", "lo", F.lit(None).cast("int").alias("buckets"), F.lit(None).cast("binary").alias("slots"))
        none = F.lit(None).cast("bigint")
        copies = self.filters().select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(0).alias("kind"),
            none.alias("t1"), none.alias("t2"), none.alias("hi"), none.alias("lo"), "buckets", "slots")

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A shard's filter comes before its pairs; one filter is held at a time."""
            at, f = None, None
            for batch in batches:
                kind = batch.column("kind").to_numpy()
                place = batch.column("shard").to_numpy().astype(np.int64) * SALTS + batch.column("salt").to_numpy()
                hi, lo = (batch.column(c).fill_null(0).to_numpy() for c in ("hi", "lo"))
                keep = np.zeros(len(kind), dtype=bool)
                cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    if a == b:
                        continue
                    if place[a] != at:
                        at, f = place[a], None
                    if kind[a] == 0:
                        f = CuckooFilter.load(batch.column("buckets")[a].as_py(), batch.column("slots")[a].as_py())
                        a += 1
                    if f is not None and a < b:
                        keep[a:b] = f.contains(hi[a:b], lo[a:b])
                yield batch.select(["t1", "t2", "hi", "lo"]).filter(pa.array(keep))

        passed = copies.unionByName(rows).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind").mapInArrow(probe, "t1 bigint, t2 bigint, hi bigint, lo bigint")
        exact = passed.join(self.counts().where(F.col("n") >= self.threshold).select("hi", "lo"), ["hi", "lo"], "left_semi")
        return exact.groupBy("t1", "t2").agg(F.collect_set(F.struct("hi", "lo")).alias("keys"))

    def apply(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` without the lines whose keys are frequent in the index.

        All columns of ``docs`` come back, with the kept lines joined by a newline in ``text_col`` (null becomes the
        empty text), and then ``n_lines`` (before dropping), ``n_dropped`` and ``kept_sha256``; these three replace
        columns of the same names.  A document that loses every line keeps the empty text.
        """
        inner, (text,) = positional(docs, text_col)
        keys = written(self.frequent(docs, text_col).select(F.col("t1").alias("h1"), F.col("t2").alias("h2"), "keys"), "line-keys")  # a table, so that a text of many rows can be split
        others = [c for c in inner.columns if c != text]
        whole = F.coalesce(F.col(text), F.lit(""))
        found = inner.withColumns({text: whole}).select(*others, F.col(text), *text_digest(F.col(text))).join(keys, (F.col("t1") == F.col("h1")) & (F.col("t2") == F.col("h2")), "left").select(*others, text, "keys")
        schema = StructType([*found.drop("keys").schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept_sha256", StringType())])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import hashlib

            for batch in batches:
                kept, n_lines, n_dropped, sha = [], [], [], []
                for t, drop in zip(batch.column(text).cast(pa.binary()).to_pylist(), batch.column("keys").to_pylist(), strict=True):
                    lines = t.split(b"\n")
                    n_lines.append(len(lines))
                    if drop:
                        gone = {(k["hi"], k["lo"]) for k in drop}
                        lines = [x for x in lines if key_digest(line_key(x)) not in gone]
                        t = b"\n".join(lines)
                    n_dropped.append(n_lines[-1] - len(lines))
                    kept.append(t)
                    sha.append(hashlib.sha256(t).hexdigest())
                yield pa.record_batch([*(batch.column(c) for c in others), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(sha)], names=[*others, text, "n_lines", "n_dropped", "kept_sha256"])

        done = found.mapInArrow(cut, schema)
        new = ("n_lines", "n_dropped", "kept_sha256")
        return done.select(*(F.col(c).alias(name) for c, name in zip(inner.columns, docs.columns, strict=True) if name not in new), *new)


def dedup_lines(docs: DataFrame, text_col: str = "text", threshold: int = 10, min_chars: int = 1, shards: int = 64) -> DataFrame:
    """Index ``docs`` and drop its frequent lines: :meth:`LineIndex.insert`, then :meth:`LineIndex.apply`.

    Every case has one result: null and empty texts are one empty line, an empty table gives an empty table, keys found
    in exactly ``threshold`` documents are dropped, repeated rows are documents of their own.
    """
    return LineIndex(docs.sparkSession, threshold, min_chars, shards).insert(docs, text_col).apply(docs, text_col)
