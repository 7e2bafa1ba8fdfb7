"""The combined score of an alignment record, its signals and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paralith.functions import text as T
from paralith.functions.fuzzy import partial_ratio_of, ratio_of
from paralith.functions.vectors import length_penalty


def percentile_95(records: DataFrame, lexical: str = "lexical", otherwise: float = 0.25) -> DataFrame:
    """p95: one row."""
    return records.agg(F.coalesce(F.percentile(lexical, F.lit(0.95)), F.lit(otherwise)).alias("p95"))


def sharing(records: DataFrame, key: str = "tgt_ref") -> DataFrame:
    return records.withColumn("sharing", F.when(F.col(key).isNull(), 0).otherwise(F.count("*").over(W.partitionBy(key))))


def expected_ratio(records: DataFrame, source_chars: str, target_chars: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Characters of all sources over those of all targets; 1 if the latter are none."""
    total = F.sum(target_chars)
    return records.groupBy(*by).agg(F.when(total > 0, F.sum(source_chars) / F.nullif(total, F.lit(0))).otherwise(1.0).alias("expected"))


def common_names(sections: DataFrame, id_col: str, text_col: str, share: float = 0.1, ascii_edges: bool = False) -> DataFrame:
    """word, n: names in over ``share`` of the sections, which tell none apart."""
    total = sections.agg(F.count("*").alias("total"))
    names = sections.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(T.english_names(F.col(text_col), ascii_edges=ascii_edges))).alias("word"))
    return names.groupBy("word").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).where(F.col("n") > share * F.col("total")).select("word", "n")


def name_overlap(pairs: DataFrame, limit: float = 75.0, shortest: int = 1) -> DataFrame:
    """pair_id, matches, names, overlap: source names (array of Latin forms) that some target name is like, repeats counted.

    The similarity is taken once for each different pair of names that meet.
    """
    s = pairs.select("pair_id", F.explode("source_names").alias("a"))
    t = pairs.select("pair_id", F.explode(F.array_distinct("target_names")).alias("b"))
    met = s.select("pair_id", "a").distinct().join(t, "pair_id").where((F.length("a") >= shortest) & (F.length("b") >= shortest))
    alike = met.select("a", "b").distinct().withColumn("r", partial_ratio_of("a", "b")).where(F.col("r") > limit)
    hit = met.join(alike, ["a", "b"]).select("pair_id", "a").distinct().withColumn("hit", F.lit(1))
    counted = s.join(hit, ["pair_id", "a"], "left").groupBy("pair_id").agg(F.sum(F.coalesce("hit", F.lit(0))).alias("matches"), F.count("*").alias("names"))
    return pairs.select("pair_id").join(counted, "pair_id", "left").select("pair_id", F.coalesce("matches", F.lit(0)).alias("matches"), F.coalesce("names", F.lit(0)).alias("names"), (F.col("matches") / F.col("names")).alias("overlap"))


def same_speaker(pairs: DataFrame, least: float = 60.0) -> DataFrame:
    """source, target: the target speaker that a source speaker's name begins (the first of these), else the most similar one of at least ``least``."""
    begins = F.col("target").startswith(F.col("source")) | F.col("source").startswith(F.col("target"))
    scored = pairs.withColumns({"begins": begins.cast("int"), "r": ratio_of("source", "target")}).where((F.col("begins") == 1) | (F.col("r") >= least))
    order = [F.desc("begins"), F.when(F.col("begins") == 1, F.lit(0.0)).otherwise(-F.col("r")), F.col("ord")]
    return scored.withColumn("k", F.row_number().over(W.partitionBy("source").orderBy(*order))).where("k = 1").select("source", "target")


def combined_score(records: DataFrame) -> DataFrame:
    """``records`` with entity_score, length_score, combined and match_quality.

    Needs match_type, src_ref, similarity, lexical, p95, matches, names, speaker (0, 1), src_chars, tgt_chars, expected and sharing.
    The veto comes after rounding, and the reference types have a floor of one half.
    """
    kind = F.col("match_type")
    by_reference = kind.contains("cts") | (kind == "concordance")
    refined = kind == "dp_refined"
    emb = F.greatest(F.least(F.coalesce("similarity", F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    lex = F.when(F.col("p95") > 0, F.greatest(F.least(F.col("lexical") / F.nullif("p95", F.lit(0.0)), F.lit(1.0)), F.lit(0.0))).otherwise(0.0)
    entity = F.when(F.col("names") > 0, F.col("matches") / F.nullif("names", F.lit(0))).otherwise(0.0)
    ent = F.when(F.col("matches") >= 2, entity).otherwise(0.3 * entity)
    spk = F.coalesce("speaker", F.lit(0)).cast("double")
    ratio = F.when(F.col("tgt_chars") > 0, F.col("src_chars") / F.nullif("tgt_chars", F.lit(0)))
    bell = length_penalty(ratio, F.col("expected"))
    out = records.withColumns({"emb_": emb, "lex_": lex, "entity_": entity, "ent_": ent, "spk_": spk, "len_": bell})
    several = sum(((F.col(c) > 0.2).cast("int") for c in ("ent_", "lex_", "spk_")), F.lit(0)) >= 2
    primary = F.greatest("ent_", "lex_", "spk_") + F.when(several, 0.1).otherwise(0.0)
    content = F.when(primary >= 0.3, primary).when(primary > 0, F.greatest(primary, 0.5 * F.col("emb_"))).otherwise(F.col("emb_"))
    free = content * F.when(refined, F.sqrt("len_")).otherwise(F.col("len_"))
    free = F.when((F.col("sharing") > 1) & ~refined, free / F.sqrt(F.greatest("sharing", F.lit(1)).cast("double"))).otherwise(free)
    fixed = F.greatest(F.greatest("ent_", "lex_", "spk_", "emb_") * F.col("len_"), F.lit(0.5))
    score = F.round(F.least(F.when(by_reference, fixed).otherwise(free), F.lit(1.0)), 4)
    veto = ~by_reference & (F.col("similarity") < 0.99) & (F.col("len_") < 0.1) & (F.col("entity_") < 0.3) & ~refined
    empty = (kind == "unmatched_english") | (kind == "unmatched_target") | F.col("src_ref").isNull()
    continued = kind == "split_continuation"
    combined = F.when(continued, 0.5).when(empty, 0.0).when(veto, 0.0).otherwise(score)
    return out.withColumns({
        "entity_score": F.when(continued | empty, 0.0).otherwise(F.round("entity_", 3)),
        "length_score": F.when(continued, 1.0).when(empty, 0.0).otherwise(F.round("len_", 3)),
        "combined": combined, "match_quality": F.when(veto & ~continued & ~empty, "no_match"),
    }).drop("emb_", "lex_", "entity_", "ent_", "spk_", "len_")
