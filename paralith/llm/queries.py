"""The operators as queries over the tables of a folder, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paralith.llm import decontam, html_text, line_dedup, pieces, pii, quality_model, quality_rules, secret_scan, simhash, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, threshold=10, min_chars=1).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_groups(docs, words_each=4, most=4, seed=42).select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs).withColumnRenamed("id", "doc_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=8, least_items=2)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.secret_report(docs).withColumnRenamed("id", "doc_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.deduplicate_archives(table(spark, sf_dir, "pages"), min_bytes=0)


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_model.score_quality(docs, model).select("doc_id", "held_out", "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").where(F.col("quality") == 1).select("doc_id")
    return quality_rules.quality_rules(docs, trusted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_simhash, op3_main_text, op4_pieces, op5_personal_data, op6_decontamination, op7_secrets, op8_warc, op9_quality_model, op10_quality_rules)}


_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos FROM docs),
keyed AS (SELECT rid, line, pos, {_LOWER.format(f"trim(line, {_SPACE})")} AS k FROM lines),
hot AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= 10),
cut AS (SELECT rid, count(*) AS n_lines, count(hot.k) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (hot.k IS NULL), '') AS kept
        FROM keyed LEFT JOIN hot USING (k) GROUP BY rid)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN cut USING (rid)
"""

_BITS = " || ".join(
    f"substring('{warc.BASE32}', ((('0x' || substring(sha1(h), {5 * i + 1}, 5))::INT >> {s}) & 31) + 1, 1)" for i in range(8) for s in (15, 10, 5, 0)
)
OP8_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, {_BITS} AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to FROM m
"""


OP6_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{{word}}') AS words FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{{word}}') AS words FROM benchmark),
cut AS (SELECT item, words, least(len(words), 8) AS w, unnest(range(len(words) - least(len(words), 8) + 1)) AS i FROM items WHERE len(words) > 0),
win AS (SELECT DISTINCT item, w, array_to_string(list_slice(words, i + 1, i + w), ' ') AS win FROM cut),
starts AS (SELECT rid, w, words, unnest(range(len(words) - w + 1)) AS i FROM docs, (SELECT DISTINCT w FROM win) WHERE len(words) >= w),
runs AS (SELECT rid, w, i, array_to_string(list_slice(words, i + 1, i + w), ' ') AS win FROM starts),
occ AS (SELECT rid, w, i, win FROM runs WHERE win IN (SELECT win FROM win)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + w)) AS p FROM occ) GROUP BY rid),
of AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM occ JOIN win USING (win)) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN of USING (rid)
""".replace("{word}", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _spans_sql(kind: str, rank: int, pattern: str, group: int, condition: str) -> str:
    """Spans of a pattern in the table docs (rid, t): running sums over the matches and the pieces between them."""
    return f"""
SELECT rid, '{kind}' AS kind, {rank} AS rank, s, s + length(m) AS e FROM (
  SELECT *, (sum(length(b) + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m))::BIGINT AS s FROM (
    SELECT rid, unnest(ms) AS m, unnest(gs) AS g, unnest(list_slice(bs, 1, len(ms))) AS b, unnest(range(len(ms))) AS i FROM (
      SELECT rid, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS gs, string_split_regex(t, '{pattern}') AS bs
      FROM docs WHERE regexp_matches(t, '{pattern}')))) WHERE {condition}"""


_ANY_CASE = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
_KEYWORD = "(" + "|".join(_ANY_CASE(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r")[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
OP7_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({_spans_sql("assign", 0, _KEYWORD, 2, "length(g) >= 8")}
UNION ALL {_spans_sql("access", 1, "AKIA[A-Z0-9]+", 0, "length(m) >= 16")}
UNION ALL {_spans_sql("hex", 2, "[0-9a-f]+", 0, "length(m) >= 32")}
{"".join(" UNION ALL " + _spans_sql(r.kind, 3 + n, r.pattern, 0, "true") for n, r in enumerate(secret_scan.MORE_RULES))}),
per AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN per USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op6_decontamination": OP6_SQL, "op7_secrets": OP7_SQL, "op8_warc": OP8_SQL}
