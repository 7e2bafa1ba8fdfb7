"""Reference joins: matching dotted references by a cascade of rules, repairing and grouping matches, completing the output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def parts(ref: str | Column) -> Column:
    return F.split(ref, r"\.")


def prefix(ref: str | Column, n: Column | int) -> Column:
    return F.array_join(F.slice(parts(ref), F.lit(1), n if isinstance(n, Column) else F.lit(n)), ".")


def parent(ref: str | Column) -> Column:
    return prefix(ref, F.greatest(F.size(parts(ref)) - 1, F.lit(1)))


def key_status(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """key, status: both, unmatched_source or unmatched_target."""
    s, t = source.select(key).distinct().withColumn("s", F.lit(1)), target.select(key).distinct().withColumn("t", F.lit(1))
    status = F.when(F.col("s").isNull(), "unmatched_target").when(F.col("t").isNull(), "unmatched_source").otherwise("both")
    return s.join(t, key, "full_outer").select(key, status.alias("status"))


def match_references(source: DataFrame, target: DataFrame) -> DataFrame:
    """gi, ref, ei: the target row of each source row, or null.

    ``source`` has gi, ref and split_from; ``target`` has ei, ref and split_from.  The first rule that applies decides: the same reference (its
    first split piece, if it was split); the parent of three or more parts; the parent's first split piece; the source's own
    split_from; the first two parts; the only target under the same prefix.  Of equal target references the last counts, of
    split pieces the first.
    """
    exact = target.where("ref is not null").groupBy("ref").agg(F.max("ei").alias("ei"))
    pieces = target.where("split_from is not null").groupBy(F.col("split_from").alias("ref")).agg(F.min("ei").alias("ei"))
    lone = target.where(F.size(parts("ref")) >= 2).groupBy(parent(F.col("ref")).alias("ref")).agg(F.count("*").alias("n"), F.max("ei").alias("ei")).where("n = 1").drop("n")
    deep, two = F.size(parts("ref")) >= 3, F.size(parts("ref")) >= 2
    rules = [
        ("r0", pieces, F.col("ref")), ("r1", exact, F.col("ref")),
        ("r2", exact, F.when(deep, parent("ref"))), ("r3", pieces, F.when(deep, parent("ref"))),
        ("r4", exact, F.col("split_from")), ("r5", pieces, F.col("split_from")),
        ("r6", exact, F.when(two, prefix("ref", 2))), ("r7", lone, F.when(deep, parent("ref"))),
    ]
    out = source.select("gi", "ref", "split_from")
    for name, table, key in rules:
        out = out.withColumn("k", key).join(table.select(F.col("ref").alias("k"), F.col("ei").alias(name)), "k", "left").drop("k")
    return out.select("gi", "ref", F.coalesce(*(name for name, _, _ in rules)).alias("ei"))


def repair_crossings(matches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``ei`` as the largest up to each ``gi``: matches never go back.  Nulls stay."""
    so_far = F.max("ei").over(W.partitionBy(*(by or (F.lit(1),))).orderBy("gi").rowsBetween(W.unboundedPreceding, 0))
    return matches.withColumn("ei", F.when(F.col("ei").isNotNull(), so_far))


def match_groups(matches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """group_id: runs of source rows with the same target."""
    w = W.partitionBy(*(by or (F.lit(1),))).orderBy("gi")
    new = F.coalesce((F.col("ei") != F.lag("ei").over(w)).cast("int"), F.lit(1))
    return matches.where("ei is not null").withColumn("new", new).withColumn("group_id", F.sum("new").over(w)).drop("new")


def gaps(matches: DataFrame, ends: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """src_start, src_end, tgt_start, tgt_end: half-open stretches without a match between matched rows, the head and the tail.

    ``ends`` has ``by`` (if any), n_source and n_target.
    """
    w = W.partitionBy(*(by or (F.lit(1),))).orderBy("gi")
    got = matches.where("ei is not null").withColumns({"next_g": F.lead("gi").over(w), "next_e": F.lead("ei").over(w), "first": F.row_number().over(w) == 1})
    got = got.join(ends, list(by)) if by else got.crossJoin(F.broadcast(ends))
    between = got.select(*by, (F.col("gi") + 1).alias("src_start"), F.coalesce("next_g", "n_source").alias("src_end"), (F.col("ei") + 1).alias("tgt_start"), F.coalesce("next_e", "n_target").alias("tgt_end"))
    head = got.where("first").select(*by, F.lit(0).alias("src_start"), F.col("gi").alias("src_end"), F.lit(0).alias("tgt_start"), F.col("ei").alias("tgt_end"))
    return between.unionByName(head).where("src_end > src_start and tgt_end >= tgt_start")


def gap_plan(stretches: DataFrame) -> DataFrame:
    """mode: group (at most three source rows or one target row: one group of score 0.5) or dp; largest source step of the latter."""
    n, m = F.col("src_end") - F.col("src_start"), F.col("tgt_end") - F.col("tgt_start")
    return stretches.withColumns({"mode": F.when((n <= 3) | (m <= 1), "group").otherwise("dp"), "most_source": F.least(F.greatest(F.lit(5), (2 * n / F.greatest(m, F.lit(1))).cast("int"), n), F.lit(20))})


def first_emission(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in the order of emission."""
    return rows.withColumn("k", F.row_number().over(W.partitionBy(key).orderBy(order))).where("k = 1").drop("k")


def split_continuations(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Target pieces whose siblings are matched but which are not themselves, with a sibling's source and type split_continuation."""
    used = rows.select(F.col("tgt_ref").alias("ref")).distinct()
    owner = rows.join(target.select(F.col("ref").alias("tgt_ref"), "split_from"), "tgt_ref").where("split_from is not null").groupBy("split_from").agg(F.max_by("src_ref", "tgt_ref").alias("src_ref"))
    missing = target.where("split_from is not null").join(used, "ref", "left_anti").join(owner, "split_from")
    return missing.select("src_ref", F.col("ref").alias("tgt_ref"), F.lit("split_continuation").alias("match_type"))


def append_unmatched(rows: DataFrame, target: DataFrame, key: str = "tgt_ref") -> DataFrame:
    """``rows`` and a row of type unmatched_target for each target reference that none of them has."""
    missing = target.select(F.col("ref").alias(key)).join(rows.select(key), key, "left_anti").withColumn("match_type", F.lit("unmatched_target"))
    return rows.unionByName(missing, allowMissingColumns=True)


def best_depths(source: DataFrame, target: DataFrame) -> DataFrame:
    """work, ref, s_text, t_text: references in common at the pair of depths that shares most of them.

    Frames have work, depth, ref and text.  Ties go to the lesser source and then target depth; works without a common reference try
    normalised ones.
    """
    from paralith.functions.text import reference

    def common(s: DataFrame, t: DataFrame) -> DataFrame:
        both = s.select("work", F.col("depth").alias("sd"), "ref", F.col("text").alias("s_text")).join(t.select("work", F.col("depth").alias("td"), "ref", F.col("text").alias("t_text")), ["work", "ref"])
        best = both.groupBy("work", "sd", "td").agg(F.countDistinct("ref").alias("n")).withColumn("k", F.row_number().over(W.partitionBy("work").orderBy(F.desc("n"), "sd", "td"))).where("k = 1")
        return both.join(best.select("work", "sd", "td"), ["work", "sd", "td"]).select("work", "ref", "s_text", "t_text")

    plain = common(source, target)
    rest = [x.join(plain.select("work").distinct(), "work", "left_anti").withColumn("ref", reference(F.col("ref"))) for x in (source, target)]
    return plain.unionByName(common(*rest))


def nearest_before(rows: DataFrame, marks: DataFrame, order: str, by: tuple[str, ...], value: str) -> DataFrame:
    """As-of join: each row with the value of the last mark at or before it."""
    both = rows.withColumn("mark", F.lit(None).cast(marks.schema[value].dataType)).withColumn("is_row", F.lit(1)).unionByName(marks.withColumnRenamed(value, "mark").withColumn("is_row", F.lit(0)), allowMissingColumns=True)
    w = W.partitionBy(*by).orderBy(order, "is_row").rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn("mark", F.last("mark", ignorenulls=True).over(w)).where("is_row = 1").drop("is_row")
