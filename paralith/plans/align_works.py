"""Alignment of works end to end: prepared sections of both sides in, scored records and checks out.

Every step handles all works at once; ``work`` and ``align_key`` say which rows belong together, so works run side by side as tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paralith.functions import text as T
from paralith.operators import dp, embed, integrity, lexicon, pairwise, refs, score, sections
from paralith.operators.refine import refine_groups

KEY = ("work", "align_key")


def prepared(rows: DataFrame, language: str = "english") -> DataFrame:
    """Sections (work, align_key, ord, cts_ref, text, ...) with oversize ones split and notes taken out, numbered anew."""
    for name, kind in (("text_for_embedding", "string"), ("split_from", "string"), ("notes", "array<struct<marker:string,text:string>>")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    limit = sections.split_threshold(rows.withColumn("n_", F.length("text")), ("work",), "n_", chars_per_token=sections.CHARS_PER_TOKEN[language]).select("work", "most")
    parts = sections.split_large(rows.join(F.broadcast(limit), "work")).drop("most")
    clean = sections.apply_note_policy(parts)
    return clean.withColumns({"ord": (F.row_number().over(W.partitionBy(*KEY).orderBy("ord", T.reference_key(F.col("cts_ref")), "cts_ref")) - 1), "n_chars": F.length("text")})


def aligned(source: DataFrame, target: DataFrame, embedder=None) -> DataFrame:
    """work, align_key, group_id, i, j, similarity, match_type: the pairs of the segmental groups of prepared sections."""
    def side(rows: DataFrame) -> DataFrame:
        return embed.with_embeddings(rows.withColumn("t_", F.coalesce("text_for_embedding", "text")), embed.embed(rows.withColumn("t_", F.coalesce("text_for_embedding", "text")), embedder, column="t_"), "t_").select(*KEY, "ord", "emb", "n_chars")

    groups = dp.align_sections(side(source), side(target), KEY)
    span = lambda a, b: F.explode(F.sequence(F.col(a), F.col(b) - 1))
    pairs = groups.withColumn("i", span("src_start", "src_end")).withColumn("j", span("tgt_start", "tgt_end"))
    return pairs.select(*KEY, "group_id", "i", "j", F.round("score", 4).alias("similarity"), F.lit("dp_aligned").alias("match_type"))


def aligned_by_reference(source: DataFrame, target: DataFrame) -> DataFrame:
    """work, align_key, i, j, similarity 1, match_type cts_aligned: reference matches, repaired to go forward."""
    scope = lambda rows: rows.withColumn("cts_ref", F.concat_ws("\u0001", "work", "align_key", "cts_ref"))
    one = lambda rows, name: scope(rows).select(*KEY, F.col("ord").alias(name), F.col("cts_ref").alias("ref"), F.when(F.col("split_from").isNotNull(), F.concat_ws("\u0001", "work", "align_key", "split_from")).alias("split_from"))
    s = one(source, "o").withColumn("gi", F.monotonically_increasing_id())
    t = one(target, "j")
    found = refs.match_references(s.select(F.struct(*KEY, "o").alias("gi"), "ref", "split_from"), t.select(F.col("j").alias("ei"), "ref", "split_from"))
    matched = refs.repair_crossings(found.select("gi.*", F.col("gi.o").alias("gi"), "ei"), KEY)
    return matched.where("ei is not null").select(*KEY, F.col("gi").alias("i"), F.col("ei").alias("j"), F.lit(1.0).alias("similarity"), F.lit("cts_aligned").alias("match_type"))


def overridden(pairs: DataFrame, source: DataFrame, target: DataFrame, concordance: DataFrame) -> DataFrame:
    """``pairs`` (work, align_key, i, j, similarity, match_type) with the sections of a concordance (work, source_section, target_section) matched as it says.

    Sections that it does not name, or names on one side only, keep their pairs.
    """
    s = source.select(*KEY, F.col("ord").alias("i"), F.col("cts_ref").alias("source_section"))
    t = target.select(*KEY, F.col("ord").alias("j"), F.col("cts_ref").alias("target_section"))
    fixed = concordance.join(s, ["work", "source_section"]).join(t, [*KEY, "target_section"]).select(*KEY, "i", "j", F.lit(1.0).alias("similarity"), F.lit("concordance").alias("match_type"))
    return pairs.join(fixed.select(*KEY, "i").distinct(), [*KEY, "i"], "left_anti").select(*fixed.columns).unionByName(fixed)


def assembled(source: DataFrame, target: DataFrame, embedder=None, refine: bool = True) -> DataFrame:
    """work, align_key, i, j, part, similarity, match_type: reference matches first, what lies between them by groups or DP, shared translations dealt out.

    References give cts_aligned pairs.  A stretch without them is one group of similarity 0.5 if it is small (its rows go to the first target of
    the stretch, or to the one before it where it has none), else it is aligned on its own; keys without any reference in common are one
    stretch.  With ``refine``, the text of a target that several neighbouring rows share is dealt to them as ``part`` (dp_refined); null
    elsewhere.  Pieces of a matched target that nothing matches become split_continuation rows of their sibling's source, other
    targets unmatched_target rows without a source.
    """
    text = lambda rows: rows.withColumn("t_", F.coalesce("text_for_embedding", "text"))
    embedded = lambda rows: embed.with_embeddings(text(rows), embed.embed(text(rows), embedder, column="t_"), "t_").select(*KEY, "ord", "emb", "n_chars")
    matched = pairwise._cut(aligned_by_reference(source, target).select(*KEY, F.col("i").alias("gi"), F.col("j").alias("ei")))
    sizes = source.groupBy(*KEY).agg(F.count("*").alias("n_source")).join(target.groupBy(*KEY).agg(F.count("*").alias("n_target")), list(KEY))
    whole = sizes.join(matched.select(*KEY).distinct(), list(KEY), "left_anti").select(*KEY, F.lit(0).alias("src_start"), F.col("n_source").alias("src_end"), F.lit(0).alias("tgt_start"), F.col("n_target").alias("tgt_end"))
    stretches = pairwise._cut(refs.gap_plan(refs.gaps(matched, sizes, KEY).select(*whole.columns).unionByName(whole)).withColumn("gap", F.col("src_start").cast("int")))

    def within(rows: DataFrame, start: str, end: str) -> DataFrame:
        long = stretches.where("mode = 'dp'").select(*KEY, "gap", start, end)
        return rows.join(long, list(KEY)).where((F.col("ord") >= F.col(start)) & (F.col("ord") < F.col(end))).withColumn("ord", F.col("ord") - F.col(start)).drop(start, end)

    found = dp.align_sections(within(embedded(source), "src_start", "src_end"), within(embedded(target), "tgt_start", "tgt_end"), (*KEY, "gap"))
    at = stretches.select(*KEY, "gap", F.col("src_start").alias("a_"), F.col("tgt_start").alias("b_"))
    span = lambda a, b: F.explode(F.sequence(F.col(a), F.col(b) - 1))
    by_dp = found.join(at, [*KEY, "gap"]).withColumn("i", span("src_start", "src_end")).withColumn("j", span("tgt_start", "tgt_end"))
    by_dp = by_dp.select(*KEY, (F.col("i") + F.col("a_")).alias("i"), (F.col("j") + F.col("b_")).alias("j"), F.round("score", 4).alias("similarity"), F.lit("dp_aligned").alias("match_type"))
    small = stretches.where("mode = 'group'").withColumn("i", span("src_start", "src_end"))
    nearest = F.greatest(F.when(F.col("tgt_end") > F.col("tgt_start"), F.col("tgt_start")).otherwise(F.col("tgt_start") - 1), F.lit(0))
    by_group = small.select(*KEY, "i", nearest.alias("j"), F.lit(0.5).alias("similarity"), F.lit("dp_aligned").alias("match_type"))
    by_ref = matched.select(*KEY, F.col("gi").alias("i"), F.col("ei").alias("j"), F.lit(1.0).alias("similarity"), F.lit("cts_aligned").alias("match_type"))
    rows = pairwise._cut(by_ref.unionByName(by_dp).unionByName(by_group)).withColumn("part", F.lit(None).cast("string"))
    if refine:
        rows = refined(rows, source, target, embedder)
    name = lambda c: F.concat_ws("\u0001", *KEY, c)
    ends = target.select(*KEY, F.col("ord").alias("j"), name("cts_ref").alias("ref"), F.when(F.col("split_from").isNotNull(), name("split_from")).alias("split_from"))
    linked = rows.join(ends.select(*KEY, "j", "ref"), [*KEY, "j"]).select(F.col("i").alias("src_ref"), F.col("ref").alias("tgt_ref"))
    more = refs.split_continuations(linked, ends.select("ref", "split_from"))
    rest = refs.append_unmatched(linked.select("tgt_ref").unionByName(more.select("tgt_ref")), ends.select("ref")).where("match_type is not null")
    late = more.unionByName(rest.select(F.lit(None).cast("int").alias("src_ref"), "tgt_ref", "match_type")).join(ends.withColumnRenamed("ref", "tgt_ref"), "tgt_ref")
    return rows.unionByName(late.select(*KEY, F.col("src_ref").alias("i"), "j", F.lit(0.0).alias("similarity"), "match_type", F.lit(None).cast("string").alias("part")).select(*rows.columns))


def refined(rows: DataFrame, source: DataFrame, target: DataFrame, embedder=None) -> DataFrame:
    """``rows`` (work, align_key, i, j, similarity, match_type, part) where the text of a target that two or more rows share is dealt out to them."""
    shared = rows.groupBy(*KEY, "j").agg(F.count("*").alias("n_"), F.min("i").alias("first_")).where("n_ > 1")
    s = embed.with_embeddings(source, embed.embed(source, embedder)).select(*KEY, F.col("ord").alias("i"), "n_chars", "emb", T.greek_names(F.col("text")).alias("names"))
    members = rows.join(shared, [*KEY, "j"]).join(s, [*KEY, "i"])
    groups = members.groupBy(*KEY, "j").agg(F.array_sort(F.collect_list(F.struct("i", "n_chars", "emb", "names"))).alias("sections"))
    groups = groups.join(target.select(*KEY, F.col("ord").alias("j"), "text"), [*KEY, "j"]).withColumn("group_id", F.struct(*KEY, "j").cast("struct<work:string,align_key:string,j:int>"))
    numbered = groups.select(F.to_json("group_id").alias("group_id"), *KEY, "j", "text", F.transform("sections", lambda x: F.struct(x.n_chars.alias("n_chars"), x.emb.alias("emb"), x.names.alias("names"))).alias("sections"), F.transform("sections", lambda x: x.i).alias("is_"))
    numbered = pairwise._cut(numbered)
    dealt = refine_groups(numbered, embedder or embed.HashingEmbedder()).join(numbered.select("group_id", *KEY, "j", "is_"), "group_id")
    new = dealt.select(*KEY, F.get("is_", F.col("offset")).alias("i"), "j", F.coalesce(F.round("similarity", 4), F.lit(0.0)).alias("similarity"), F.lit("dp_refined").alias("match_type"), F.col("text").alias("part"))
    keep = rows.join(shared.select(*KEY, "j"), [*KEY, "j"], "left_anti").select(*rows.columns)
    return keep.unionByName(new.select(*rows.columns))


def matched_pairwise(source: DataFrame, target: DataFrame, one_to_one: bool = False) -> DataFrame:
    """i, j, similarity, runner_up of one work's embedded rows (ord, emb)."""
    s, t = source.select(F.col("ord").alias("i"), F.col("emb").alias("vec")), target.select(F.col("ord").alias("j"), F.col("emb").alias("vec"))
    return pairwise.greedy_of(s, t) if one_to_one else pairwise.best_of(s, t)


def scored(pairs: DataFrame, source: DataFrame, target: DataFrame, lexicon_rows: DataFrame | None = None, idfs: DataFrame | None = None) -> DataFrame:
    """Records with texts, signals and the combined score."""
    s = source.select(*KEY, F.col("ord").alias("i"), F.col("cts_ref").alias("src_ref"), F.col("text").alias("source"), F.length("text").alias("src_chars"))
    t = target.select(*KEY, F.col("ord").alias("j"), F.col("cts_ref").alias("tgt_ref"), F.col("text").alias("target"), F.length("text").alias("tgt_chars"))
    rows = pairs.join(s, [*KEY, "i"], "left").join(t, [*KEY, "j"], "left").withColumn("pair_id", F.concat_ws(":", *KEY, "i", "j"))
    common = score.common_names(target.withColumn("id", F.concat_ws(":", *KEY, "ord")), "id", "text").agg(F.collect_list("word").alias("stop"))
    named = rows.crossJoin(F.broadcast(common)).select("pair_id", F.transform(T.greek_names(F.col("source")), lambda x: T.transliterated(x)).alias("source_names"), T.english_names(F.col("target"), F.col("stop")).alias("target_names"))
    rows = rows.join(score.name_overlap(named, shortest=4).select("pair_id", "matches", "names"), "pair_id", "left")
    if lexicon_rows is not None:
        words = lexicon.overlap(lexicon.tokens(rows, "source", T.GREEK_WORD), lexicon.tokens(rows, "target"), lexicon_rows, idfs)
        rows = rows.join(words.withColumnRenamed("score", "lexical"), "pair_id", "left").withColumn("lexical", F.coalesce("lexical", F.lit(0.0)))
    else:
        rows = rows.withColumn("lexical", F.lit(0.0))
    expected = score.expected_ratio(rows, "src_chars", "tgt_chars", ("work",))
    rows = score.sharing(rows.join(F.broadcast(expected), "work")).crossJoin(F.broadcast(score.percentile_95(rows))).withColumn("speaker", F.lit(0))
    return score.combined_score(rows)


def checked(records: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """check, failures: references repeated or lost on either side, and pairs out of order."""
    s, t = (x.select(F.concat_ws(":", *KEY, "cts_ref").alias("ref")) for x in (source, target))
    got = lambda c: records.where(F.col(c).isNotNull()).select(F.concat_ws(":", *KEY, c).alias("ref"))
    return integrity.gate({
        "repeated_source": integrity.repeated(s, "ref"), "missing_source": integrity.missing(s, got("src_ref"), "ref"), "missing_target": integrity.missing(t, got("tgt_ref"), "ref"),
        "order": integrity.order_violations(records.where("match_type not like 'unmatched%'"), KEY, "i", "j"),
    })
