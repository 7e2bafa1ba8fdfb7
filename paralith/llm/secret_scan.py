"""Secret scanning with an incremental blob ledger.

A document version is a path (its id) to a *blob*, the content addressed by its SHA-256.  The ledger, a folder of two
append-only tables, says which (blob, rule version) pairs were scanned, and what was found:

* ``scanned (blob, rules)``: the rule versions that a run applied to a blob;
* ``findings (blob, rule, spans)``: the spans of one rule version in one blob, where there are any.

A run scans each blob that some path has now once, with just those rule versions that the ledger has not seen it with, and
appends; findings are joined back to all paths of the blob.  A new version of a rule has another name, so it is scanned
anew.  All of it is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralith.llm import spans as S
from paralith.llm.common import positional, shared_path, written


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` of at least ``least`` characters in group ``group``."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1
    hint: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def find(self, text: Column) -> Column:
        return F.filter(S.find_spans(text, self.pattern, self.group, self.hint), lambda x: F.length(x.g) >= self.least)


KEYWORD = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
BASE_RULES = (
    Rule("assign", KEYWORD, 8, 2),
    Rule("access", r"AKIA[A-Z0-9]++", 16, hint="AKIA"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 32),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/= \t\n\r]{16,}-----END [A-Z ]{0,20}PRIVATE KEY-----", hint="PRIVATE KEY"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", hint="eyJ"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", hint="AIza"),
)
RULES = BASE_RULES + MORE_RULES
SPAN = "array<struct<s:int,e:int>>"


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, blob and found (array of (rule name, spans)) for every row of ``docs``; scans what the ledger at ``ledger`` has not seen.

    Without ``ledger`` a fresh one in the shared folder is used.  Null and empty texts are the empty blob.  Rows that repeat an
    id are paths of their own; copies of a text are one blob.  A run that fails before it ends may be repeated.
    """
    spark = docs.sparkSession
    ledger = ledger or shared_path(spark, "ledger")
    inner, (doc_id, text) = positional(docs, id_col, text_col)
    rows = inner.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("blob", F.sha2("t", 256))
    paths = written(rows.select("id", "blob"), "paths")
    names = [r.name for r in rules]
    seen = _table(spark, f"{ledger}/scanned", "blob string, rules array<string>").groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("had"))
    wanted = paths.groupBy("blob").agg(F.min("id").alias("one")).join(seen, "blob", "left").withColumn("had", F.coalesce("had", F.array().cast("array<string>")))
    wanted = written(wanted.select(F.col("blob").alias("wblob"), "one", F.array_except(F.lit(names), "had").alias("todo")).where(F.size("todo") > 0), "unseen")
    unseen = rows.join(wanted.hint("shuffle_hash"), (F.col("blob") == F.col("wblob")) & F.col("id").eqNullSafe(F.col("one"))).select("blob", "t", "todo")
    each = [F.struct(F.lit(r.name).alias("rule"), F.when(F.array_contains("todo", r.name), F.transform(r.find(F.col("t")), lambda x: F.struct(x.s.alias("s"), x.e.alias("e")))).otherwise(F.array().cast(SPAN)).alias("spans")) for r in rules]
    scanned = unseen.select("blob", F.filter(F.array(*each), lambda x: F.size(x.spans) > 0).alias("found")).where(F.size("found") > 0)
    scanned.dropDuplicates(["blob"]).select("blob", F.inline("found")).write.mode("append").parquet(f"{ledger}/findings")
    wanted.select(F.col("wblob").alias("blob"), F.col("todo").alias("rules")).write.mode("append").parquet(f"{ledger}/scanned")
    findings = _table(spark, f"{ledger}/findings", f"blob string, rule string, spans {SPAN}").where(F.col("rule").isin(names)).dropDuplicates(["blob", "rule"])
    by_blob = written(findings.groupBy("blob").agg(F.collect_list(F.struct("rule", "spans")).alias("found")), "by-blob")  # one entry a rule; a table, so that a blob of many paths can be split
    return paths.join(by_blob, "blob", "left").select("id", "blob", F.coalesce("found", F.array().cast(f"array<struct<rule:string,spans:{SPAN}>>")).alias("found"))


def _table(spark, path: str, schema: str) -> DataFrame:
    """The table at ``path``; without rows while it has not been written."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def spans_of(found: Column, rules: tuple[Rule, ...]) -> Column:
    """Spans (s, rank, e, kind) of the given rules."""
    one = [F.flatten(F.transform(F.filter(found, lambda x: x.rule == r.name), lambda x: x.spans)) for r in rules]
    return F.concat(*(S.marked(x, r.kind, n) for n, (x, r) in enumerate(zip(one, rules, strict=True))))


def secret_report(docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256 (of the base rules' spans) and spans (of all rules) for every row of ``docs``.

    Null and empty texts have no spans; repeated rows and copies of a text have equal results; an empty table gives an empty table.
    """
    found = scan_secrets(docs, RULES, ledger, id_col, text_col)
    base = found.withColumn("base", spans_of(F.col("found"), BASE_RULES)).withColumn("every", spans_of(F.col("found"), RULES))
    count = lambda kind: F.size(F.filter("base", lambda x: x.kind == kind)).cast("bigint")
    return base.select("id", *(count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES), F.sha2(S.listed(F.col("base")), 256).alias("base_sha256"), S.listed(F.col("every")).alias("spans"))
