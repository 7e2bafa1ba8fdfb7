"""The concordance of a corpus of text pairs: lexicon, vectors, lemma groups, export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paralith.functions import text as T
from paralith.operators import contexts, lemmas, lexicon, pairwise


def build_lexicon(pairs: DataFrame, pattern: str = T.GREEK_WORD, stop_source: DataFrame | None = None, stop_target: DataFrame | None = None, least: int = 3) -> dict[str, DataFrame]:
    """lexicon, idf, stop words of both sides (from unfiltered words) and the reverse index (without target stop words) of pairs (pair_id, source, target)."""
    s, t = lexicon.tokens(pairs, "source", pattern, stop_source), lexicon.tokens(pairs, "target", stop=stop_target)
    total = lexicon.pair_total(pairs)
    return {
        "lexicon": lexicon.translations(s, t, total, least), "idf": lexicon.idf(s, total),
        "stop_source": lexicon.stopwords(lexicon.tokens(pairs, "source", pattern), total), "stop_target": lexicon.stopwords(lexicon.tokens(pairs, "target"), total),
        "reverse": lexicon.reverse_index(s, t, least),
    }


def build_vectors(texts: DataFrame, pattern: str = T.GREEK_WORD, dims: int = 200, least: int = 5) -> DataFrame:
    """word, vec from texts (id, text)."""
    return contexts.svd_vectors(contexts.ppmi(contexts.window_counts(texts, "id", "text", least=least, pattern=pattern)), dims)


def completed(found: DataFrame, lexicon_rows: DataFrame, vectors: DataFrame, suffixes: DataFrame, small: int = 5, most: int = 25) -> DataFrame:
    """``found`` (word, rep, confidence) with words left alone at the representative nearest to them, and then groups of at most ``small``
    words in the larger group nearest to their representative, up to ``most`` words."""
    size = lambda rows: rows.groupBy("rep").agg(F.count("*").alias("n"))
    placed = lambda reps: reps.select(F.col("rep").alias("word"), "n").join(vectors, "word")
    heads = size(found).where("n > 1").select("rep")
    alone = lexicon_rows.select(F.col("src").alias("word")).distinct().join(found.join(heads, "rep", "left_semi").select("word"), "word", "left_anti")
    late = lemmas.rescue_singletons(alone.join(vectors, "word"), placed(size(found).where("n > 1")), lexicon_rows, suffixes).select("word", "rep", "confidence")
    grown = pairwise._cut(found.join(late.select("word"), "word", "left_anti").unionByName(late))
    few, many = placed(size(grown).where(F.col("n") <= small)), placed(size(grown).where(F.col("n") > small))
    near = lemmas.rescue_singletons(few, many, lexicon_rows, suffixes, least=0.60)
    sizes = near.select(F.col("word").alias("small"), F.col("rep").alias("large"), "sim", "confidence").join(few.select(F.col("word").alias("small"), F.col("n").alias("n_small")), "small")
    sizes = sizes.join(many.select(F.col("word").alias("large"), F.col("n").alias("n_large")), "large")
    taken = lemmas.merge_small(sizes.select("small", "n_small", "large", "n_large", "sim"), most).join(sizes.select("small", F.col("confidence").alias("c_")), "small")
    moved = grown.join(taken.withColumnRenamed("small", "rep"), "rep", "left")
    return moved.select("word", F.coalesce("large", "rep").alias("rep"), F.coalesce("c_", "confidence").alias("confidence"))


def build_lemmas(lexicon_rows: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """word, rep, confidence: clusters of linked word forms, extended by common stems whose members translate alike; with ``vectors``
    (word, vec) also by words left alone and by small groups."""
    words = lexicon_rows.select(F.col("src").alias("word")).distinct()
    pairs = lemmas.scored_pairs(lemmas.translation_cosine(lemmas.candidate_pairs(words), lexicon_rows))
    limit = lemmas.elbow(pairs.select("score"), low=0.10, high=0.30)
    edges = pairwise._cut(pairs.crossJoin(F.broadcast(limit)).where("score >= elbow").select("a", "b"))
    clustered = pairwise._cut(lemmas.clusters(edges, lemmas.components(edges, pairwise._cut)))
    affixes = pairwise._cut(lemmas.common_affixes(lemmas.affix_rows(clustered)))
    stemmed = lemmas.near_translations(pairwise._cut(lemmas.stems(words, affixes).select("stem", "word")), lexicon_rows)
    found = lemmas.merge_groups(clustered, stemmed.select("stem", "word"), lemmas.word_frequency(lexicon_rows))
    if vectors is None:
        return found
    return completed(pairwise._cut(found), lexicon_rows, vectors, affixes.where("kind = 'suffix'").select("affix"))


def concordance(pairs: DataFrame, pattern: str = T.GREEK_WORD, vectors: DataFrame | None = None) -> DataFrame:
    """The exported concordance of pairs (pair_id, source, target); ``vectors`` as :func:`build_vectors` gives them complete the lemmas."""
    built = build_lexicon(pairs, pattern)
    return lexicon.export(built["lexicon"], built["idf"], build_lemmas(built["lexicon"], vectors))
