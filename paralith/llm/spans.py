"""Spans of regular expressions in texts, by SQL functions only.  Offsets are in code points, ends exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<s:int,e:int,v:string,g:string,left:string,right:string>>"
SIDE = 40
BLOCK = 128


def none() -> Column:
    return F.array().cast(SPANS)


def find_spans(text: Column, pattern: str, group: int = 0, hint: str | None = None) -> Column:
    """Leftmost non-overlapping matches in order: start, end, the match, its group, and up to ``SIDE`` characters before and after it.

    Matches and the pieces between them alternate, so offsets are running sums of their lengths.  Sums run within blocks of
    ``BLOCK`` matches and over the blocks, as an array that grows by one is copied each time: many matches in one text take
    time in proportion.  Texts without a match (first, without ``hint``, a string that every match holds) are told by one look.
    """
    there = text.rlike(pattern)
    if hint:
        there = F.contains(text, F.lit(hint)) & there
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    zipped = F.arrays_zip(whole.alias("m"), part.alias("g"), F.slice(between, 1, F.size(whole)).alias("p"), F.slice(between, 2, F.size(whole)).alias("q"))
    return F.when(there, F.get(F.transform(F.array(zipped), _placed), F.lit(0))).otherwise(none())


def _blocks(items: Column) -> Column:
    """An array that is not empty as blocks of ``BLOCK`` items."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def _length(x: Column) -> Column:
    return F.length(x.p) + F.length(x.m)


def _placed(pairs: Column) -> Column:
    """Spans of (match m, group g, piece before p, piece after q) in order."""
    grow = lambda a, n: F.struct((a.at + n).alias("at"), F.concat(a.out, F.array(a.at)).alias("out"))

    def starts(blocks: Column) -> Column:
        lengths = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + _length(x)))
        return F.aggregate(lengths, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), grow, lambda a: a.out)

    def step(a: Column, x: Column) -> Column:
        s = a.at + F.length(x.p)
        one = F.struct(
            s.alias("s"), (s + F.length(x.m)).alias("e"), x.m.alias("v"), x.g.alias("g"), F.substring(x.p, -SIDE, SIDE).alias("left"), F.substring(x.q, 1, SIDE).alias("right"))
        return F.struct((a.at + _length(x)).alias("at"), F.concat(a.out, F.array(one)).alias("out"))

    within = lambda b, at: F.aggregate(b, F.struct(at.alias("at"), none().alias("out")), step, lambda a: a.out)
    # blocks are bound to a variable, which keeps them from being made once for the sums and again for the spans
    return F.get(F.transform(F.array(_blocks(pairs)), lambda bs: F.flatten(F.zip_with(bs, starts(bs), within))), F.lit(0))


def marked(spans: Column, kind: str, order: int) -> Column:
    """Spans as (s, rank, e, kind), which sort by start and then by kind as listed."""
    return F.transform(spans, lambda x: F.struct(x.s.alias("s"), F.lit(order).alias("rank"), x.e.alias("e"), F.lit(kind).alias("kind")))


def listed(spans: Column) -> Column:
    """kind:start:end of sorted (s, rank, e, kind) spans, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat(x.kind, F.lit(":"), x.s.cast("string"), F.lit(":"), x.e.cast("string"))), ",")


def overlaps_none(spans: Column, others: Column) -> Column:
    """Those of ``spans`` (s, e, ...) that overlap no span of ``others`` (s first, e).

    The others are sorted and cut into blocks with their bounds, so that a span is compared with few blocks' members.
    """
    bounded = F.transform(_blocks(F.array_sort(others)), lambda b: F.struct(F.get(b, F.lit(0)).s.alias("lo"), F.array_max(F.transform(b, lambda x: x.e)).alias("hi"), b.alias("b")))
    meets = lambda c, x: (x.lo < c.e) & (c.s < x.hi) & F.exists(x.b, lambda b: (b.s < c.e) & (c.s < b.e))
    kept = F.get(F.transform(F.array(bounded), lambda bs: F.filter(spans, lambda c: ~F.exists(bs, lambda x: meets(c, x)))), F.lit(0))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), kept).otherwise(spans)
