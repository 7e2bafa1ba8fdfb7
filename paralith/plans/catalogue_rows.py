"""Queries of row functions, windows and word tables, each over whole tables and with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paralith.functions import text as T
from paralith.functions import vectors as V
from paralith.operators import dp, embed, integrity, lemmas, pairwise, quality, refs, sections
from paralith.plans.catalogue import _LEXICON, _PAIRS, _SEQUENCE, _lexicon, conversation_pairs, query, table

_sha = lambda c: F.sha2(c, 256)


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


# ---- text functions ------------------------------------------------------------------------------------------------


@query(r"SELECT doc_id, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS hash FROM documents")
def q_collapsed_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", _sha(T.collapsed(F.col("text"))).alias("hash"))


@query(r"""SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace('[A] ' || text || ' [12] x[B]', '\[[A-Z]\]', '', 'g'), '\[[0-9]+\]', '', 'g'), '\s+', ' ', 'g'))) AS hash FROM documents""")
def q_without_markers(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", _sha(T.without_markers(F.concat(F.lit("[A] "), "text", F.lit(" [12] x[B]")))).alias("hash"))


@query("SELECT doc_id, substring(text, 1, 80) AS preview FROM documents")
def q_previews(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.preview(F.col("text")).alias("preview"))


@query(f"WITH w AS (SELECT doc_id, {_SEQUENCE.format('text')} AS ws FROM documents) SELECT doc_id, len(ws)::BIGINT AS n, len(list_distinct(ws))::BIGINT AS n_different, sha256(array_to_string(ws, ' ')) AS hash FROM w")
def q_word_sequences(spark, sf_dir):
    """The words of every document in order, and how many are different."""
    words = _docs(spark, sf_dir).select("doc_id", T.word_sequence(F.col("text")).alias("ws"), T.word_set(F.col("text")).alias("set"))
    return words.select("doc_id", F.size("ws").cast("bigint").alias("n"), F.size("set").cast("bigint").alias("n_different"), _sha(F.array_join("ws", " ")).alias("hash"))


@query(f"WITH w AS (SELECT unnest({_SEQUENCE.format('text')}) AS word FROM documents) SELECT word, count(*) AS n FROM w GROUP BY word ORDER BY n DESC, word LIMIT 100")
def q_frequent_words(spark, sf_dir):
    """The hundred most frequent words, a report."""
    words = _docs(spark, sf_dir).select(F.explode(T.word_sequence(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(100)


@query("SELECT doc_id, doc_id % 3999 + 1 AS number FROM documents")
def q_roman_numerals(spark, sf_dir):
    """Numerals made of each document's id, read back as numbers."""
    n = F.col("doc_id") % 3999 + 1
    digit = lambda k, one, five, ten: F.element_at(F.array(*map(F.lit, ("", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten))), (F.floor(n / k) % 10 + 1).cast("int"))
    numeral = F.concat(F.repeat(F.lit("M"), F.floor(n / 1000).cast("int")), digit(100, "C", "D", "M"), digit(10, "X", "L", "C"), digit(1, "I", "V", "X"))
    return _docs(spark, sf_dir).select("doc_id", T.roman(numeral).cast("bigint").alias("number"))


@query("SELECT doc_id, (doc_id % 7) || '.' || (doc_id % 100) || CASE WHEN doc_id % 3 = 0 THEN '.0' ELSE '' END AS ref FROM documents")
def q_references(spark, sf_dir):
    ref = F.concat(F.lit("0"), F.col("doc_id") % 7, F.lit(".00"), F.col("doc_id") % 100, F.when(F.col("doc_id") % 3 == 0, ".pr").otherwise(""))
    return _docs(spark, sf_dir).select("doc_id", T.reference(ref).alias("ref"))


@query(r"""SELECT doc_id, array_to_string(list_transform(list_filter(string_split(source || '.' || doc_id || '.2a.03', '.'), lambda x: regexp_full_match(x, '[0-9]+')), lambda x: x::INTEGER), ',') AS parts FROM documents""")
def q_reference_keys(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.array_join(T.reference_key(F.concat_ws(".", "source", "doc_id", F.lit("2a"), F.lit("03"))).cast("array<string>"), ",").alias("parts"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 0 ELSE doc_id END AS n, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'a' WHEN 2 THEN 'bis' ELSE lang END AS suffix FROM documents")
def q_line_keys(spark, sf_dir):
    key = T.line_key(F.when(F.col("doc_id") % 4 == 3, F.col("lang")).otherwise(F.concat("doc_id", F.element_at(F.array(F.lit(""), F.lit("a"), F.lit("bis"), F.lit("")), (F.col("doc_id") % 4 + 1).cast("int")))))
    return _docs(spark, sf_dir).select("doc_id", key.getField("n").cast("bigint").alias("n"), key.getField("s").alias("suffix"))


@query("""SELECT page_id, sha256(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS hash FROM pages""")
def q_escaped(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", _sha(T.escaped(F.col("html"))).alias("hash"))


@query(r"""SELECT page_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(replace(translate('“ ’[ 3 ]— ' || html || '…', '“”‘’—–', '""''''--'), '…', '...'), '<[^>]+>', '', 'g'), '\[\s*[0-9]+\s*\]', '', 'g'), '\s+', ' ', 'g'))) AS hash FROM pages""")
def q_plain_punctuation(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", _sha(T.plain_punctuation(F.concat(F.lit("“ ’[ 3 ]— "), "html", F.lit("…")))).alias("hash"))


@query("SELECT doc_id, 'the ' || lower(source) || ' and ' || lang AS subject FROM documents")
def q_title_subjects(spark, sf_dir):
    title = F.concat(F.col("doc_id"), F.lit(". The "), F.col("source"), F.lit(" (see n. 3) Variant AND "), F.col("lang"))
    return _docs(spark, sf_dir).select("doc_id", T.title_subject(title).alias("subject"))


@query(r"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
s AS (SELECT coalesce(nullif(regexp_extract(line, '^([A-Z]{2,}(?:\s+[A-Z]{2,})?)\.\s+', 1), ''), nullif(regexp_extract(line, '^([A-Z][a-z]{1,10})\.\s+', 1), ''), nullif(regexp_extract(line, '^([A-Z][a-z]{1,10})\s+\(', 1), '')) AS speaker FROM l)
SELECT speaker, count(*) AS n FROM s GROUP BY speaker""")
def q_speakers(spark, sf_dir):
    """Lines of every document by the speaker they name, those without one too."""
    lines = _docs(spark, sf_dir).select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.select(T.speaker(F.col("line")).alias("speaker")).groupBy("speaker").agg(F.count("*").alias("n"))


@query(f"""WITH {_PAIRS}, w AS (SELECT pair_id, list_distinct(string_split(lower(trim(regexp_replace(source, '\\s+', ' ', 'g'))), ' ')) AS x, list_distinct(string_split(lower(trim(regexp_replace(target, '\\s+', ' ', 'g'))), ' ')) AS y FROM pairs)
SELECT pair_id, round(1 - len(list_filter(x, lambda v: NOT list_contains(y, v) AND length(v) >= 4))::DOUBLE / len(x), 6) AS coverage FROM w""")
def q_refined_coverage(spark, sf_dir):
    """The share of the first side's words that the other side has, for every pair."""
    return conversation_pairs(spark, sf_dir).select("pair_id", F.round(integrity.coverage(F.col("source"), F.col("target")), 6).alias("coverage"))


# ---- windows and references ----------------------------------------------------------------------------------------


@query("""WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place, count(*) OVER (PARTITION BY user_id) AS total, 3 + user_id % 5 AS k FROM events),
q AS (SELECT *, total // k AS small, (total // k) * (k - total % k) AS edge FROM e)
SELECT user_id, event_id, CASE WHEN small < 1 THEN least(place, k - 1) WHEN place < edge THEN place // small ELSE k - total % k + (place - edge) // (small + 1) END AS part FROM q""")
def q_quotas(spark, sf_dir):
    """The events of each user dealt to as many parts as its id says."""
    w = W.partitionBy("user_id")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.row_number().over(w.orderBy("event_id")) - 1).alias("place"), F.count("*").over(w).alias("total"), (3 + F.col("user_id") % 5).alias("k"))
    return e.select("user_id", "event_id", sections.quota(F.col("total"), F.col("k"), F.col("place")).cast("bigint").alias("part"))


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, (event_id * 7) % 50 AS n FROM events),
r AS (SELECT user_id, event_id, k, n FROM e WHERE k = 1 UNION ALL SELECT e.user_id, e.event_id, e.k, CASE WHEN e.n <= r.n THEN r.n + 1 ELSE e.n END FROM r JOIN e ON e.user_id = r.user_id AND e.k = r.k + 1)
SELECT user_id, event_id, n FROM r""")
def q_repaired_numerals(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", ((F.col("event_id") * 7) % 50).alias("n"))
    return sections.repaired_numerals(rows, ("user_id",), "event_id", "n").select("user_id", "event_id", "n")


@query("""SELECT user_id, event_id + 1 AS "from", lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS "to" FROM events WHERE event_type = 'signup'""")
def q_marker_spans(spark, sf_dir):
    marks = table(spark, sf_dir, "events").where("event_type = 'signup'").select("user_id", F.col("event_id").alias("start"), (F.col("event_id") + 1).alias("end"))
    return sections.marker_spans(marks, ("user_id",)).select("user_id", "from", "to")


@query("""WITH t AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS was FROM events)
SELECT user_id, string_agg(event_type, '>' ORDER BY event_id) AS turns, count(*) AS n FROM t WHERE was IS NULL OR was <> event_type GROUP BY user_id""")
def q_speakers_in_order(spark, sf_dir):
    """The kinds of each user's events in order, runs of one kind once."""
    found = sections.speakers_in_order(table(spark, sf_dir, "events"), ("user_id",), "event_id", "event_type")
    return found.select("user_id", F.array_join("speakers", ">").alias("turns"), F.size("speakers").cast("bigint").alias("n"))


_MATCHES = "SELECT event_type AS book, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS gi, CASE WHEN value >= 40 THEN (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 2 END AS ei FROM events"


def _matches(spark, sf_dir):
    place = F.row_number().over(W.partitionBy("event_type").orderBy("event_id")) - 1
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("book"), place.cast("bigint").alias("gi"), "value")
    return e.select("book", "gi", F.when(F.col("value") >= 40, F.floor(F.col("gi") / 2)).alias("ei"))


@query(f"""WITH m AS ({_MATCHES}), f AS (SELECT *, CASE WHEN ei = lag(ei) OVER (PARTITION BY book ORDER BY gi) THEN 0 ELSE 1 END AS new FROM m WHERE ei IS NOT NULL)
SELECT book, gi, ei, (sum(new) OVER (PARTITION BY book ORDER BY gi ROWS UNBOUNDED PRECEDING))::BIGINT AS group_id FROM f""")
def q_match_groups(spark, sf_dir):
    return refs.match_groups(_matches(spark, sf_dir), ("book",)).select("book", "gi", "ei", "group_id")


@query(f"""WITH m AS ({_MATCHES}), n AS (SELECT book, count(*) AS n_source, count(*) // 2 + 3 AS n_target FROM m GROUP BY book), g AS (SELECT *, lead(gi) OVER w AS ng, lead(ei) OVER w AS ne, row_number() OVER w AS k FROM m WHERE ei IS NOT NULL WINDOW w AS (PARTITION BY book ORDER BY gi)),
x AS (SELECT book, gi + 1 AS src_start, coalesce(ng, n_source) AS src_end, ei + 1 AS tgt_start, coalesce(ne, n_target) AS tgt_end FROM g JOIN n USING (book) UNION ALL SELECT book, 0, gi, 0, ei FROM g WHERE k = 1)
SELECT *, CASE WHEN src_end - src_start <= 3 OR tgt_end - tgt_start <= 1 THEN 'group' ELSE 'dp' END AS mode,
least(greatest(5, floor(2 * (src_end - src_start) / greatest(tgt_end - tgt_start, 1)), src_end - src_start), 20)::BIGINT AS most_source FROM x WHERE src_end > src_start AND tgt_end >= tgt_start""")
def q_gap_plan(spark, sf_dir):
    """Stretches between matched rows, and how each is to be aligned."""
    m = _matches(spark, sf_dir)
    ends = m.groupBy("book").agg(F.count("*").alias("n_source"), (F.floor(F.count("*") / 2) + 3).alias("n_target"))
    columns = ("src_start", "src_end", "tgt_start", "tgt_end")
    found = refs.gap_plan(refs.gaps(m, ends, ("book",)))
    return found.select("book", *(F.col(c).cast("bigint").alias(c) for c in columns), "mode", F.col("most_source").cast("bigint").alias("most_source"))


@query("""WITH t AS (SELECT doc_id::VARCHAR AS ref, CASE WHEN doc_id % 5 < 3 THEN source || '-' || doc_id % 50 END AS split_from FROM documents), r AS (SELECT doc_id AS src, doc_id::VARCHAR AS ref FROM labels),
o AS (SELECT split_from, src, row_number() OVER (PARTITION BY split_from ORDER BY t.ref DESC, src DESC) AS k FROM r JOIN t USING (ref) WHERE split_from IS NOT NULL)
SELECT src::VARCHAR AS src_ref, ref AS tgt_ref, 'split_continuation' AS match_type FROM t JOIN o USING (split_from) WHERE k = 1 AND ref NOT IN (SELECT ref FROM r)""")
def q_split_continuations(spark, sf_dir):
    """Documents without a label in the families of labelled ones."""
    target = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("ref"), F.when(F.col("doc_id") % 5 < 3, F.concat("source", F.lit("-"), F.col("doc_id") % 50)).alias("split_from"))
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("src_ref"), F.col("doc_id").cast("string").alias("tgt_ref"))
    return refs.split_continuations(rows, target)


# ---- scores of pairs -----------------------------------------------------------------------------------------------


@query("""WITH p AS (SELECT event_id, value / 397 AS a, (event_id % 101)::DOUBLE / 103 AS b FROM events)
SELECT event_id, round(a * b, 6) AS product, round(least(a, b), 6) AS minimum, round(sqrt(a * b), 6) AS geometric, round(CASE WHEN a + b = 0 THEN 0 ELSE 2 * a * b / (a + b) END, 6) AS harmonic,
round(CASE WHEN a = 0 OR b = 0 THEN 0 ELSE 2 / (0.7::DOUBLE / a + 0.3::DOUBLE / b) END, 6) AS weighted_harmonic FROM p""")
def q_score_means(spark, sf_dir):
    p = table(spark, sf_dir, "events").select("event_id", (F.col("value") / 397).alias("a"), ((F.col("event_id") % 101).cast("double") / 103).alias("b"))
    return p.select("event_id", *(F.round(f(F.col("a"), F.col("b")), 6).alias(name) for name, f in V.MEANS.items()))


@query("""WITH p AS (SELECT event_id, (event_id % 11)::DOUBLE / 10 AS r, (event_id % 13)::DOUBLE / 12 AS t FROM events)
SELECT event_id, round(CASE WHEN r >= 0.8 THEN CASE WHEN t = 0 THEN 0 ELSE pow(r, 0.7::DOUBLE) * pow(t, 0.3::DOUBLE) END ELSE r * t END, 6) AS score FROM p""")
def q_bootstrap_scores(spark, sf_dir):
    p = table(spark, sf_dir, "events").select("event_id", ((F.col("event_id") % 11).cast("double") / 10).alias("r"), ((F.col("event_id") % 13).cast("double") / 12).alias("t"))
    return p.select("event_id", F.round(V.bootstrap_score(F.col("r"), F.col("t")), 6).alias("score"))


_SOURCE_PAIRS = f"""{_LEXICON}, gr AS (SELECT DISTINCT src, substring(src, i::INTEGER, 4) AS gram FROM (SELECT DISTINCT src, unnest(range(1, length(src) - 2)) AS i FROM lex WHERE length(src) >= 4)), few AS (SELECT gram FROM gr GROUP BY gram HAVING count(*) <= 500),
cand AS (SELECT DISTINCT x.src AS a, y.src AS b FROM gr x JOIN gr y USING (gram) JOIN few USING (gram) WHERE x.src < y.src), size AS (SELECT src, sqrt(sum(weight * weight)) AS size FROM lex GROUP BY src),
tc AS (SELECT a, b, coalesce(sum(x.weight * y.weight) / any_value(sa.size * sb.size), 0) AS tc FROM cand JOIN size sa ON sa.src = a JOIN size sb ON sb.src = b LEFT JOIN lex x ON x.src = a LEFT JOIN lex y ON y.src = b AND y.en = x.en GROUP BY a, b)"""


@query(f"WITH {_SOURCE_PAIRS} SELECT a, b, round(tc, 6) AS tc FROM tc")
def q_translation_cosines(spark, sf_dir):
    """Pairs of source words with a 4-gram in common, and the cosine of their translations."""
    lex = _lexicon(spark, sf_dir)[3]
    return lemmas.translation_cosine(lemmas.candidate_pairs(lex.select(F.col("src").alias("word")).distinct()), lex).select("a", "b", F.round("tc", 6).alias("tc"))


@query(f"""WITH {_LEXICON}, f AS (SELECT src AS word, sum(n)::BIGINT AS freq FROM lex GROUP BY src) SELECT word, freq FROM f""")
def q_word_frequencies(spark, sf_dir):
    return lemmas.word_frequency(_lexicon(spark, sf_dir)[3])


_ALIKE = "SELECT event_id, value / 400 AS a, (event_id % 101)::DOUBLE / 100 AS b, (event_id % 17)::DOUBLE / 16 AS r FROM events"


@query(f"""WITH p AS ({_ALIKE}), l AS (SELECT 'a' AS metric, a AS v, r FROM p UNION ALL SELECT 'b', b, r FROM p)
SELECT metric, count(*) FILTER (v >= 0.5 AND r >= 0.5) AS both, count(*) FILTER (v >= 0.5 AND r < 0.5) AS metric_only, count(*) FILTER (v < 0.5 AND r >= 0.5) AS reference_only, count(*) FILTER (v < 0.5 AND r < 0.5) AS neither,
round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.95), 6) AS p95 FROM l GROUP BY metric""")
def q_quadrants(spark, sf_dir):
    p = table(spark, sf_dir, "events").select((F.col("value") / 400).alias("a"), ((F.col("event_id") % 101).cast("double") / 100).alias("b"), ((F.col("event_id") % 17).cast("double") / 16).alias("r"))
    found = quality.quadrants(p, ["a", "b"], "r")
    return found.select("metric", "both", "metric_only", "reference_only", "neither", F.round(F.col("percentiles")[0], 6).alias("p25"), F.round(F.col("percentiles")[3], 6).alias("p95"))


# ---- lemma groups and alignment ------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT vec_id, vec_id % 50 AS g, embedding::DOUBLE[] AS v FROM embeddings), m AS (SELECT g, d, avg(v[d]) AS m FROM (SELECT g, v, unnest(range(1, len(v) + 1)) AS d FROM c) GROUP BY g, d), z AS (SELECT g, list(m ORDER BY d) AS z FROM m GROUP BY g),
s AS (SELECT g, vec_id, list_dot_product(v, z) / sqrt(list_dot_product(v, v) * list_dot_product(z, z)) AS sim FROM c JOIN z USING (g))
SELECT g AS group_id, vec_id, round(sim, 6) AS sim FROM s WHERE sim >= 0.15 QUALIFY count(*) OVER (PARTITION BY g) >= 2""")
def q_centroid_keep(spark, sf_dir):
    """Vectors near the mean of their group, a group being the ids of one remainder."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("word"), F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    kept = lemmas.near_centroid(e.select((F.col("word") % 50).alias("stem"), "word"), e)
    return kept.select(F.col("stem").alias("group_id"), F.col("word").alias("vec_id"), F.round("sim", 6).alias("sim"))


@query(f"""WITH {_LEXICON}, g AS (SELECT DISTINCT substring(src, 1, 4) AS rep, src AS word FROM lex WHERE length(src) >= 4), i AS (SELECT rep, word, unnest(range(1, length(word) + 1)) AS i FROM g),
u AS (SELECT DISTINCT rep, word, substring(word, i::INT, k::INT) AS run, k FROM (SELECT rep, word, i, unnest(range(1, length(word) - i + 2)) AS k FROM i)),
l AS (SELECT a.rep, max(a.k) AS k FROM u a JOIN u b ON a.rep = b.rep AND a.run = b.run AND a.word < b.word GROUP BY a.rep, a.word, b.word), m AS (SELECT rep, min(k) AS stem FROM l GROUP BY rep),
d AS (SELECT word, (length(word) - stem)::INT AS d FROM g JOIN m USING (rep) WHERE length(word) - stem BETWEEN 1 AND 6),
c AS (SELECT kind, affix, count(*) AS n FROM (SELECT 'suffix' AS kind, right(word, d) AS affix FROM d UNION ALL SELECT 'prefix', left(word, d) FROM d WHERE d >= 2) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, affix) - 1 AS k, count(*) OVER (PARTITION BY kind) AS every FROM c), least_of AS (SELECT kind, n AS least_n FROM k WHERE k = least(greatest(1, every // 20), every - 1))
SELECT kind, affix, n FROM c JOIN least_of USING (kind) WHERE n >= least_n""")
def q_affixes(spark, sf_dir):
    """The frequent endings and beginnings of source words beyond the stem of their group, groups being words of four equal first letters."""
    words = pairwise._cut(_lexicon(spark, sf_dir)[3].select(F.col("src").alias("word")).distinct().where(F.length("word") >= 4))
    return lemmas.common_affixes(lemmas.affix_rows(words.select(F.substring("word", 1, 4).alias("rep"), "word"))).select("kind", "affix", "n")


_STEMS = f"""{_LEXICON}, w AS (SELECT DISTINCT src AS word FROM lex), size AS (SELECT count(*) AS every FROM w), e AS (SELECT word, unnest([2, 3]) AS d FROM w),
sx AS (SELECT right(word, d) AS affix FROM e, size WHERE length(word) > d GROUP BY 1 HAVING count(*) * 50 >= any_value(every)), px AS (SELECT left(word, d) AS affix FROM e, size WHERE length(word) > d GROUP BY 1 HAVING count(*) * 200 >= any_value(every)),
p AS (SELECT word, max(d) AS d FROM e WHERE length(word) - d >= 4 AND right(word, d) IN (FROM sx) GROUP BY word), b AS (SELECT word, left(word, d) AS prefix, substring(word, d + 1) AS rest FROM e WHERE word NOT IN (SELECT word FROM p) AND length(word) > d AND left(word, d) IN (FROM px)),
x AS (SELECT word, prefix, rest, coalesce(max(CASE WHEN length(rest) - d >= 4 AND right(rest, d) IN (FROM sx) THEN d END), 0)::INT AS cut FROM b, (SELECT unnest([2, 3]) AS d) GROUP BY ALL),
y AS (SELECT word, prefix, left(rest, (length(rest) - cut)::INT) AS stem FROM x WHERE length(rest) - cut >= 4 QUALIFY row_number() OVER (PARTITION BY word ORDER BY length(prefix) DESC) = 1),
stems AS (SELECT word, left(word, (length(word) - d)::INT) AS stem FROM p UNION ALL SELECT word, stem FROM y UNION ALL SELECT word, word FROM w WHERE word NOT IN (SELECT word FROM p) AND word NOT IN (SELECT word FROM y))"""


def _stems(spark, sf_dir):
    """The lexicon, and its source words by the stem that frequent endings and beginnings of two or three letters leave."""
    lex = pairwise._cut(_lexicon(spark, sf_dir)[3])
    words = lex.select(F.col("src").alias("word")).distinct()
    ends = words.select("word", F.explode(F.array(F.lit(2), F.lit(3))).alias("d")).where(F.length("word") > F.col("d"))
    every = F.broadcast(words.agg(F.count("*").alias("every")))  # one row

    def frequent(kind, affix, share):
        return ends.groupBy(F.expr(affix).alias("affix")).agg(F.count("*").alias("n")).crossJoin(every).where(F.col("n") * share >= F.col("every")).select(F.lit(kind).alias("kind"), "affix")

    return lex, lemmas.stems(words, frequent("suffix", "right(word, d)", 50).unionByName(frequent("prefix", "left(word, d)", 200)))


@query(f"WITH {_STEMS} SELECT word, stem FROM stems")
def q_stems(spark, sf_dir):
    return _stems(spark, sf_dir)[1].select("word", "stem")


@query(f"""WITH {_STEMS}, n AS (SELECT *, count(*) OVER (PARTITION BY stem) AS k FROM stems), every_en AS (SELECT stem, en, sum(weight) AS c FROM n JOIN lex ON src = word WHERE k > 1 GROUP BY stem, en),
m AS (SELECT n.stem, n.word, coalesce(l.weight, 0) AS w, CASE WHEN k = 2 THEN c - coalesce(l.weight, 0) ELSE c END AS c FROM n JOIN every_en USING (stem) LEFT JOIN lex l ON l.src = n.word AND l.en = every_en.en),
alike AS (SELECT stem, word, sum(w * c) / sqrt(sum(w * w) * sum(c * c)) AS sim FROM m GROUP BY stem, word) SELECT stem, word, round(sim, 6) AS sim FROM alike WHERE sim >= 0.15 QUALIFY count(*) OVER (PARTITION BY stem) >= 2""")
def q_stem_groups(spark, sf_dir):
    """Source words of one stem that translate alike."""
    lex, found = _stems(spark, sf_dir)
    return lemmas.near_translations(pairwise._cut(found.select("stem", "word")), lex).select("stem", "word", F.round("sim", 6).alias("sim"))


@query()
def q_segmental_dp(spark, sf_dir):
    """The user's turns of every conversation against the assistant's, in groups that tile both."""
    turns = table(spark, sf_dir, "conversations").where("text is not null")
    vectors = embed.embed(turns)

    def side(role):
        own = turns.where(F.col("role") == role).select("conv_id", F.col("turn").alias("ord"), "text", F.length("text").alias("n_chars"))
        return embed.with_embeddings(own, vectors).select("conv_id", "ord", "emb", "n_chars")

    return dp.align_sections(side("user"), side("assistant"), ("conv_id",))


@query(f"""WITH n AS (SELECT conv_id, turn, role, unnest(list_distinct(list_transform(list_filter(string_split_regex(text, '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda w: regexp_full_match(w, '[A-Z][a-z]+')), lambda w: lower(w)))) AS name FROM conversations WHERE role = 'assistant' OR length(text) >= 30),
w AS (SELECT conv_id, turn, role, unnest(list_distinct({_SEQUENCE.format("text")})) AS word FROM conversations WHERE role = 'assistant' OR length(text) >= 30),
c AS (SELECT a.conv_id, a.turn AS gi, b.turn AS ei, 2.0 AS score FROM n a JOIN n b ON a.conv_id = b.conv_id AND a.role = 'user' AND b.role = 'assistant' AND (left(a.name, 4) = left(b.name, 4) OR starts_with(a.name, b.name) OR starts_with(b.name, a.name))
UNION ALL SELECT a.conv_id, a.turn, b.turn, 0.5 FROM w a JOIN w b ON a.conv_id = b.conv_id AND a.word = b.word AND a.role = 'user' AND b.role = 'assistant')
SELECT conv_id, gi, ei, sum(score)::DOUBLE AS score FROM c GROUP BY ALL""")
def q_anchor_candidates(spark, sf_dir):
    """The user's turns (of 30 characters or more) against the assistant's turns with names or words in common."""
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant' or length(text) >= 30")

    def side(role, place, values, name):
        return turns.where(F.col("role") == role).select("conv_id", F.col("turn").alias(place), F.explode(values).alias(name))

    names = F.transform(F.filter(F.split("text", r"[^\p{L}\p{M}\p{N}_]+"), lambda w: w.rlike(r"^[A-Z][a-z]+$")), F.lower)
    words = T.word_set(F.col("text"))
    return dp.anchor_candidates(side("user", "gi", names, "name"), side("assistant", "ei", names, "name"), side("user", "gi", words, "word"), side("assistant", "ei", words, "word"), ("conv_id",))


@query()
def q_anchor_chains(spark, sf_dir):
    return dp.anchor_chains(q_anchor_candidates(spark, sf_dir), ("conv_id",))
