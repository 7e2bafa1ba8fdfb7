"""Benchmark decontamination: a prefix-filtered set join of documents with the word windows of benchmark items.

An item's windows are its runs of ``window`` words (an item of fewer is one window).  A window is a set of shingles of
``SHINGLE`` words with their offsets.  A text that contains the window contains all of them, so one shingle is a sufficient
prefix: the rarest.

1. *Order.*  Shingles of the benchmark are counted over all documents, by the hash of their words; counts are kept a place of the
   filter below, so there are at most ``MOST_BITS`` of them, and they are combined before the shuffle.
2. *Prefix.*  Each window is left with its rarest shingle.
3. *Candidates.*  Places of texts whose hash may be that of a prefix shingle become rows, with the words around them.  They are
   joined with the prefixes on the shingle's words; the window's offset and length bound where it can start.
4. *Verification.*  The words at that start must be the window's.

Both looks at the texts tell places by a filter: a bit for each hash, in an array that is part of the plan.  It has some
``BITS_EACH`` bits a shingle and at most ``MOST_BITS``, whatever the benchmark's size; where it gets crowded, more candidates
fail to join, and results are the same.

Hashes are of words in full lower case, one word at a time as far as context goes (the final sigma counts as the other one),
so they never depend on a word's neighbours; windows are compared with A-Z lower-cased.  Windows are found in texts, not in
rows: a text is known by its digest, so copies are counted once after step 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralith.llm.common import positional, text_digest, written

NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE = 4
BITS_EACH = 16
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 23


def words_of(text: Column) -> Column:
    """The words of a text: what stands between runs of ASCII characters other than letters and digits."""
    return F.array_remove(F.split(text, NO_WORD), "")


def folded(text: Column) -> Column:
    """Lower case without the one form that depends on its place in a word; it has as many words, at the same places."""
    return F.replace(F.lower(text), F.lit("ς"), F.lit("σ"))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """item (the id as a string, null as the empty one), win (its words joined), w (their number): the different windows of each item."""
    inner, (item, text) = positional(items, id_col, text_col)
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    rows = inner.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), words_of(lower).alias("words")).withColumn("n", F.size("words")).where("n > 0")
    rows = rows.withColumn("w", F.least("n", F.lit(window))).withColumn("start", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("w"))))
    return rows.select("item", F.concat_ws(" ", F.slice("words", F.col("start") + 1, F.col("w"))).alias("win"), "w").distinct()


def _hash(words: Column, i: Column, size: int) -> Column:
    """The hash of the run of ``size`` words from place ``i`` on, of the words' hashes."""
    return F.xxhash64(F.lit(size), *(F.get(words, i + k) for k in range(size)))


def _bit(h: Column, bits: int) -> Column:
    """The place of a hash in a filter of ``bits`` bits."""
    return h.bitwiseAND(bits - 1).cast("int")


def _filter_words(shingles: DataFrame, bits: int) -> Column:
    """The filter (64-bit words) of the places ``bit`` of ``shingles``: at most ``MOST_BITS`` / 64 words, a literal once it is planned."""
    parts = shingles.select(F.shiftright("bit", 6).alias("at"), F.expr("shiftleft(1L, bit & 63)").alias("v")).groupBy("at").agg(F.bit_or("v").alias("v"))
    words = ["0"] * (bits // 64)
    for r in parts.collect():  # bits / 64 rows at most
        words[r["at"]] = str(r["v"])
    return F.split(F.lit(",".join(words)), ",").cast("array<bigint>")


def once(value: Column, use) -> Column:
    """``use`` of a variable bound to ``value``.  A column used inside a lambda is otherwise evaluated for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


HITS = "array<struct<q:int,pos:int,bit:int>>"


def _hits(hashed: Column, sizes: list[int], found: Column, bits: int) -> Column:
    """q, pos, bit of the places of words (by their hashes) where a run of q words is in the filter."""
    there = lambda p: F.getbit(F.get(found, F.shiftright(p.bit, 6)), p.bit.bitwiseAND(63)) == 1
    n = F.size(hashed)

    def of(q: int) -> Column:
        every = F.transform(F.sequence(F.lit(0), n - q), lambda i: F.struct(F.lit(q).alias("q"), i.alias("pos"), _bit(_hash(hashed, i, q), bits).alias("bit")))
        return F.when(n >= q, F.filter(every, there)).otherwise(F.array().cast(HITS))

    return F.concat(F.array().cast(HITS), *map(of, sizes))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 8, least_items: int = 2, most_bits: int = MOST_BITS) -> DataFrame:
    """One row for each row of ``docs``: id, t1, t2 (digest of the text), n_words, n_hit (words inside windows), n_items (items with windows in the text), items_sha256 and contaminated (n_items >= ``least_items``).

    Null and empty texts have no words; items without words have no windows; items of one id count once, as do repeated
    items; a null item id counts as the empty string.  Repeated rows of ``docs`` have equal results.  An empty table of
    documents gives an empty table; with an empty table of items nothing is hit.
    """
    windows = written(item_windows(items, item_col, item_text, window), "windows")
    unique = windows.select("win", "w").distinct().withColumn("words", F.split("win", " ")).withColumn("q", F.least("w", F.lit(SHINGLE)))
    hashed = F.transform(F.split(folded(F.col("win")), " "), lambda w: F.xxhash64(w))
    parts = unique.withColumn("hashed", hashed).select("win", "w", "q", "words", "hashed", F.explode(F.sequence(F.lit(0), F.col("w") - F.col("q"))).alias("off"))
    run = F.lit(None).cast("bigint")
    for q in range(1, SHINGLE + 1):
        run = F.when(F.col("q") == q, _hash(F.col("hashed"), F.col("off"), q)).otherwise(run)
    parts = written(parts.select("win", "w", "q", "off", F.concat_ws(" ", F.slice("words", F.col("off") + 1, F.col("q"))).alias("s"), run.alias("h")), "parts")
    sizes = [r["q"] for r in parts.select("q").distinct().collect()]  # SHINGLE rows at most
    n_shingles = parts.agg(F.approx_count_distinct("h")).head()[0]
    bits = LEAST_BITS
    while bits < min(most_bits, BITS_EACH * n_shingles):
        bits *= 2
    parts = parts.withColumn("bit", _bit(F.col("h"), bits))

    inner, (doc_id, text) = positional(docs, id_col, text_col)
    rows = inner.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    hashed = F.transform(words_of(folded(F.col("t"))), lambda w: F.xxhash64(w))

    all_bits = _filter_words(parts.select("bit").distinct(), bits)
    often = rows.select(F.explode(once(hashed, lambda hw: _hits(hw, sizes, all_bits, bits).getField("bit"))).alias("bit")).groupBy("bit").agg(F.count("*").alias("often"))
    often = written(often, "often")
    order = parts.join(often, "bit", "left").groupBy("win", "w", "q").agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "h", "off", "s", "bit")).alias("r"))
    prefix = written(order.where("r.often > 0").select("win", "w", "q", F.col("r.s").alias("s"), F.col("r.off").alias("off"), F.col("r.bit").alias("bit")), "prefix")

    # the widest window around a place: from ``window`` words before it to as many from it on
    def around(p: Column, words: Column) -> Column:
        at = F.greatest(p.pos - window, F.lit(0))
        near = F.transform(F.slice(words, at + 1, F.lit(2 * window)), lambda w: F.translate(w, UPPER, LOWER))
        return F.struct(p.q.alias("q"), p.pos.alias("pos"), at.alias("at"), near.alias("near"))

    kept = _filter_words(prefix.select("bit").distinct(), bits)
    nowhere = F.array().cast("array<struct<q:int,pos:int,at:int,near:array<string>>>")
    places = lambda hits: F.when(F.size(hits) > 0, once(words_of(F.col("t")), lambda words: F.transform(hits, lambda p: around(p, words)))).otherwise(nowhere)
    seen = once(hashed, lambda hw: F.struct(F.size(hw).cast("bigint").alias("n_words"), once(_hits(hw, sizes, kept, bits), places).alias("places")))
    held = written(rows.select("id", *text_digest(F.col("t")), seen.alias("x")), "held").select("id", "t1", "t2", "x.*")
    places = held.where(F.size("places") > 0).select("t1", "t2", "n_words", F.inline("places"))
    places = places.withColumn("s", F.concat_ws(" ", F.slice("near", F.col("pos") - F.col("at") + 1, F.col("q"))))
    starts = places.join(prefix.select("win", "w", "s", "off"), "s").withColumn("start", F.col("pos") - F.col("off")).where("start >= 0 and start + w <= n_words")
    occurs = starts.where(F.concat_ws(" ", F.slice("near", F.col("start") - F.col("at") + 1, F.col("w"))) == F.col("win"))
    occurs = written(occurs.select("t1", "t2", "start", "win", "w").distinct(), "occurs")

    hit = occurs.select("t1", "t2", F.explode(F.sequence("start", F.col("start") + F.col("w") - 1)).alias("p")).distinct().groupBy("t1", "t2").agg(F.count("*").alias("n_hit"))
    of = occurs.select("t1", "t2", "win").join(windows.select("item", "win"), "win").groupBy("t1", "t2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    per_text = written(hit.join(of, ["t1", "t2"]).select(F.col("t1").alias("h1"), F.col("t2").alias("h2"), "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "hits")
    joined = held.drop("places").join(per_text, (F.col("t1") == F.col("h1")) & (F.col("t2") == F.col("h2")), "left")
    zero, n_items = F.lit(0).cast("bigint"), F.coalesce("n_items", F.lit(0).cast("bigint"))
    return joined.select(
        "id", "t1", "t2", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), n_items.alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_items >= least_items).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose texts are not contaminated, with all their columns.

    Null and empty texts stay; copies of a text stay or go together; an empty table gives an empty table.
    """
    bad = decontaminate(docs, items, id_col, text_col, **options).where("contaminated").select(F.col("t1").alias("b1"), F.col("t2").alias("b2")).distinct()
    inner, (text,) = positional(docs, text_col)
    t1, t2 = text_digest(F.coalesce(F.col(text), F.lit("")))
    return inner.join(written(bad, "bad"), (t1 == F.col("b1")) & (t2 == F.col("b2")), "left_anti").toDF(*docs.columns)
