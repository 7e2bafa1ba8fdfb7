"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs the labelers, a span classifier decides.

Candidates are the spans of fixed patterns (*base*, always kept) and those of looser patterns that overlap no base span.  Four
labelers vote on each candidate, base or not, +1 (personal), -1 (not) or 0 (abstains):

* *regex*: the candidate has its kind's strict form, or has not;
* *gazetteer*: its value begins or ends as listed (country calling codes, card issuers, domain endings, countries, given names);
* *context*: a cue word of its kind, or a word of other numbers (order, invoice, ...), stands before it;
* *check*: check sums, ranges and lengths hold, or do not.

Votes are counted by pattern (3^4 at most).  EM on these counts estimates how often each labeler casts each vote given the hidden
class (a Dawid-Skene model), which gives every candidate a probability.  A naive Bayes classifier is trained with these
probabilities as weights on the span itself and what stands around it, not on the votes: its length, share of digits, shape,
the characters before and after it and the word before it, each by kind.  Shapes and words are hashed to ``HASHED`` places, so
there are ``FEATURES`` parameters whatever the corpus.  Candidates that it accepts are added to the base spans.

All rows are handled by DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralith.llm import spans as S
from paralith.llm.common import positional, text_digest, written

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("ssn", "iban", "name")
KINDS = BASE_KINDS + MORE_KINDS
LABELERS = ("regex", "gazetteer", "context", "check")

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# Looser forms, cue words and listed beginnings or endings of each kind.
LOOSE = {
    "email": (r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]{1,63}){1,4}", "at"),
    "phone": (r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])", None),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])", None),
    "name": (r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.\x20[A-Z][a-z]{1,30}(?:\x20[A-Z][a-z]{1,30})?", ". "),
}
CUES = {
    "email": r"(?i)e-?mail|contact|write to|reach",
    "ip": r"(?i)\bip\b|address|host|client|from",
    "card": r"(?i)card|visa|mastercard|credit|debit",
    "phone": r"(?i)phone|tel\b|tel\.|call|mobile|cell|fax",
    "ssn": r"(?i)ssn|social security",
    "iban": r"(?i)iban|account|bank",
    "name": r"(?i)dear|regards|patient|contact|signed|by ",
}
NOT_CUES = r"(?i)order|invoice|isbn|version|serial|part no|build|ticket"
STRICT = {
    "email": r"^[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9](?:[A-Za-z0-9.\x20()\[\]-]*[.\])]\x20?)[A-Za-z]{2,24}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{12,19}|[0-9]{4}(?:[\x20-][0-9]{4}){2,3}(?:[\x20-][0-9]{1,3})?|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{4,5})$",
    "phone": r"^(?:\+[1-9][0-9]{0,2}[\x20().-]{1,2}[0-9].*|\+[1-9][0-9]{8,14}|(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[.\x20-])[2-9][0-9]{2}[.\x20-][0-9]{4})$",
    "ssn": r"^[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}(?:[A-Z]{4}[A-Z0-9]*|[0-9][A-Z0-9]*)$",
    "name": r"^(?:Mr|Mrs|Ms|Dr|Prof)\.\x20[A-Z][a-z]{2,}(?:\x20[A-Z][a-z]{2,})?$",
}
GIVEN_NAMES = (
    "Adam Alan Albert Alex Alexander Alice Amanda Amy Andrea Andrew Angela Ann Anna Anne Anthony Antonio Barbara Benjamin Brian Carl Carlos Carmen Carol Caroline "
    "Catherine Charles Charlotte Chris Christian Christine Christopher Claire Claudia Daniel David Deborah Dennis Diana Diego Donald Dorothy Edward Elena Elizabeth "
    "Emily Emma Eric Eva Felix Fernando Francis Frank Franz Gabriel George Gerald Gregory Hans Harold Helen Henry Hugo Ingrid Isabel Jack Jacob James Jan Jane Jason "
    "Javier Jean Jeffrey Jennifer Jessica Joan Johann John Jonathan Jorge Jose Joseph Joshua Juan Julia Julie Karen Karl Kate Katherine Kenneth Kevin Klaus Laura "
    "Lawrence Linda Lisa Louis Lucas Lucia Luis Manuel Marc Margaret Maria Marie Mark Martha Martin Mary Matthew Max Melissa Michael Michel Michelle Miguel Monica "
    "Nancy Nicholas Nicole Olivia Oscar Otto Pablo Patricia Patrick Paul Paula Pedro Peter Philip Pierre Rachel Raymond Rebecca Richard Robert Roger Ronald Rosa Ruth "
    "Samuel Sandra Sarah Scott Sergio Sharon Simon Sofia Sophie Stefan Stephanie Stephen Steven Susan Teresa Theresa Thomas Timothy Ursula Victor Victoria Walter William Wolfgang"
)
CALLING_CODES = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 "
    "211 212 213 216 218 22[0-9] 23[0-9] 24[0-9] 25[0-8] 26[0-9] 290 291 297 298 299 350 351 352 353 354 355 356 357 358 359 37[0-8] 380 381 382 383 385 386 387 389 "
    "420 421 423 50[0-9] 59[0-9] 67[0-9] 68[0-9] 690 691 692 850 852 853 855 856 880 886 96[0-8] 97[0-7] 992 993 994 995 996 998"
)
ENDINGS = (
    "com org net edu gov mil int info biz name pro io app dev ai ar at au be bg br by ca ch cl cn co cy cz de dk ee eg es eu fi fr ge gr hk hr hu id ie il in ir is it jp ke kr kz "
    "lt lu lv ma mt mx my ng nl no nz pe ph pk pl pt ro rs ru sa se sg si sk th tn tr tw ua uk us uy ve vn za"
)
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 "
    "IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 "
    "SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
)
_any = lambda words: "|".join(words.split())
LISTED = {
    "email": rf"(?i)(?:\.|dot[\])]\x20?)(?:{_any(ENDINGS)})$",
    "ip": r"^(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[0-1][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[0-8]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3(?:0[0-5]|[4678]|5(?:2[89]|[3-8]))|6(?:011|4[4-9]|5|2))",
    "phone": rf"^(?:\+(?:{_any(CALLING_CODES)})|\(?[2-9])",
    "ssn": r"^(?!000|666|9)[0-9]{3}",
    "iban": "^(?:" + "|".join(x[:2] for x in IBAN_LENGTHS.split()) + ")",
    "name": rf"\.\x20(?:{_any(GIVEN_NAMES)})\b",
}
DECIDED = ("ip", "card", "phone", "ssn", "iban")  # kinds whose list is whole: what is not listed is a vote against


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The Luhn check of a string of digits."""

    def add(a: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, d * 2).otherwise(d)
        return a + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The fixed patterns' spans; failing matches are dropped without another try.

    The patterns match the same spans as their plain forms: repeats that cannot give way are possessive, and a run is
    entered at its beginning only, so that long runs take linear time.
    """
    card = F.filter(S.find_spans(text, CARD), lambda x: luhn(digits(x.v)))
    ip = F.filter(S.find_spans(text, IP), lambda x: x.v.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$"))
    phone = F.filter(S.find_spans(text, PHONE, hint="+"), lambda x: F.length(digits(x.v)).between(9, 15))
    return {"email": S.find_spans(text, EMAIL, hint="@"), "ip": ip, "card": card, "phone": phone}


def _tagged(spans: Column, kind: str, base: bool) -> Column:
    return F.transform(spans, lambda x: F.struct(x.s.alias("s"), F.lit(KINDS.index(kind)).alias("rank"), x.e.alias("e"), F.lit(kind).alias("kind"), F.lit(base).alias("base"), x.v.alias("v"), x.left.alias("left"), x.right.alias("right")))


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, t1, t2 (digest of the text), base and loose: arrays of (s, rank, e, kind, base, v, left, right), one row for each row of ``docs``."""
    inner, (doc_id, text) = positional(docs, id_col, text_col)
    rows = inner.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    base = rows.withColumns({f"b_{k}": v for k, v in base_spans(F.col("t")).items()})
    base = base.withColumn("base", F.concat(*(_tagged(F.col(f"b_{k}"), k, True) for k in BASE_KINDS)))
    base = base.withColumns({f"l_{k}": S.find_spans(F.col("t"), p, hint=h) for k, (p, h) in LOOSE.items()})
    loose = S.overlaps_none(F.concat(*(_tagged(F.col(f"l_{k}"), k, False) for k in LOOSE)), F.col("base"))
    return base.select("id", *text_digest(F.col("t")), "base", loose.alias("loose"))


def _by_kind(patterns: dict[str, str], value: Column) -> Column:
    out = F.lit(False)
    for kind, pattern in patterns.items():
        out = F.when(F.col("kind") == kind, value.rlike(pattern)).otherwise(out)
    return out


def remainder_97(code: Column) -> Column:
    """The check remainder of an account code: its first four signs last, letters as 10 to 35, modulo 97; 1 is right."""
    moved = F.concat(F.substring(code, 5, 60), F.substring(code, 1, 4))
    sign = lambda a, c: F.when(c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(code)), lambda i: F.substring(moved, i, F.lit(1))), F.lit(0), sign)


def votes(spans: DataFrame) -> DataFrame:
    """``spans`` (kind, v, left, ...) with a vote of each labeler."""
    v, kind = F.col("v"), F.col("kind")
    own = digits(v)
    vote = lambda c: F.when(c, 1).otherwise(-1)
    length = F.create_map(*(F.lit(x) for c in IBAN_LENGTHS.split() for x in (c[:2], int(c[2:]))))
    national = F.when(v.startswith("+"), F.length(own).between(9, 15)).otherwise((F.length(own) == 10) & own.rlike("^[2-9][0-9]{2}[2-9]"))
    check = (
        F.when(kind == "phone", vote(national & ~own.rlike(r"([0-9])\1{6}")))
        .when(kind == "card", vote(luhn(own) & F.length(own).between(12, 19) & ~own.rlike(r"^([0-9])\1+$")))
        .when(kind == "ip", vote(~v.rlike(r"^0|^255\.255\.|\.0\.0\.0$|(?:^|\.)0[0-9]")))
        .when(kind == "ssn", vote(~v.rlike("^000|^666|^9|-00-|-0000$")))
        .when(kind == "iban", vote((remainder_97(v) == 1) & F.coalesce(F.length(v) == F.element_at(length, F.substring(v, 1, 2)), F.lit(False))))
        .when(kind == "email", vote(~v.rlike(r"\.\.|^\.|\.@|@-|-\.|\.[0-9]+$")))
        .otherwise(0)
    )
    return spans.withColumns({
        "regex": vote(_by_kind(STRICT, v)),
        "gazetteer": F.when(_by_kind(LISTED, v), 1).when(kind.isin(*DECIDED), -1).otherwise(0),
        "context": F.when(F.col("left").rlike(NOT_CUES), -1).when(_by_kind(CUES, F.col("left")), 1).otherwise(0),
        "check": check,
    })


def expectation_maximisation(counts: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """The probability of the class 'personal' given each vote pattern.

    The hidden class starts at the share of positive votes; each labeler's votes given the class are smoothed by one
    pseudo-vote, with 'right' votes thought twice as likely as wrong ones.  Without patterns there is nothing to estimate.
    """
    p = {v: (1 + sum(x > 0 for x in v)) / (2 + sum(x != 0 for x in v)) for v, _ in counts}
    for _ in range(rounds):
        share = (1 + sum(n * p[v] for v, n in counts)) / (2 + sum(n for _, n in counts))
        given: list[dict[tuple[bool, int], float]] = []
        for i in range(len(LABELERS)):
            table = {}
            for good in (True, False):
                weight = lambda v: p[v] if good else 1 - p[v]  # noqa: B023, E731
                prior = {x: 2.0 if (x > 0) == good and x else 1.0 for x in (-1, 0, 1)}
                total = sum(prior.values()) + sum(n * weight(v) for v, n in counts)
                for x in (-1, 0, 1):
                    table[good, x] = (prior[x] + sum(n * weight(v) for v, n in counts if v[i] == x)) / total
            given.append(table)
        for v in p:
            odds = math.log(share / (1 - share)) + sum(math.log(t[True, x] / t[False, x]) for t, x in zip(given, v, strict=True))
            p[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return p


HASHED = 256
BLOCKS = {"length": 13, "digits": 6, "before": 4, "after": 4, "shape": HASHED, "word": HASHED}
WIDTH = sum(BLOCKS.values())
FEATURES = len(KINDS) * WIDTH


def span_features() -> Column:
    """The numbers of a span's features, one of each of ``BLOCKS``, by kind."""
    v, left, right = F.col("v"), F.col("left"), F.col("right")
    n, d = F.length(v), F.length(digits(v))
    beside = lambda c, at: F.when(c == "", 0).when(c.rlike(rf"^[\s]$"), 1).when(c.rlike("^[A-Za-z0-9]$"), 2).otherwise(3)
    hashed = lambda c: F.pmod(F.xxhash64(c), F.lit(HASHED))
    shape = v
    for letters, by in (("[A-Z]+", "A"), ("[a-z]+", "a"), ("[0-9]+", "0")):
        shape = F.regexp_replace(shape, letters, by)
    values = {
        "length": F.least(F.floor(n / 4), F.lit(12)), "digits": F.floor(5 * d / F.greatest(n, F.lit(1))), "before": beside(F.substring(left, -1, 1), -1), "after": beside(F.substring(right, 1, 1), 1),
        "shape": hashed(shape), "word": hashed(F.lower(F.regexp_extract(left, r"([A-Za-z]+)[^A-Za-z]*$", 1))),
    }
    at, out = 0, []
    for name, width in BLOCKS.items():
        out.append((values[name] + at).cast("int"))
        at += width
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    return F.transform(F.array(*out), lambda x: kind * WIDTH + x)


def naive_bayes(sums: list[tuple[int, float, float]]) -> tuple[list[float], list[float]]:
    """Log-odds of each feature and of each kind, from (feature, weight of personal ones, weight of others); smoothed by one of each."""
    good, bad = [0.0] * FEATURES, [0.0] * FEATURES
    for f, g, b in sums:
        good[f], bad[f] = g, b
    kinds = [(sum(good[k * WIDTH : k * WIDTH + BLOCKS["length"]]), sum(bad[k * WIDTH : k * WIDTH + BLOCKS["length"]])) for k in range(len(KINDS))]
    log_odds = [0.0] * FEATURES
    for k, (g, b) in enumerate(kinds):
        at = k * WIDTH
        for width in BLOCKS.values():
            for f in range(at, at + width):
                log_odds[f] = math.log((good[f] + 1) / (g + width)) - math.log((bad[f] + 1) / (b + width))
            at += width
    return log_odds, [math.log((g + 1) / (b + 1)) for g, b in kinds]


def _numbers(values: list[float]) -> Column:
    """An array of numbers, a literal once it is planned."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.9) -> DataFrame:
    """One row for each row of ``docs``: id, n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans) and spans (base spans and those that the classifier accepts with a probability of at least ``accept``).

    Spans are kind:start:end, ordered by start and then kind, comma-joined.  Null and empty texts have none.  The model is fitted to the
    candidates of all rows; repeated rows have equal results, an empty table gives an empty table.
    """
    found = written(candidates(docs, id_col, text_col), "candidates")
    every = votes(found.select("t1", "t2", F.inline(F.concat("base", "loose"))))
    counted = every.groupBy(*LABELERS).agg(F.count("*").alias("n")).collect()  # 3^4 rows at most
    posterior = expectation_maximisation([(tuple(r[x] for x in LABELERS), r["n"]) for r in counted])
    weight = F.lit(0.5)
    for pattern, p in posterior.items():
        same = F.lit(True)
        for x, v in zip(LABELERS, pattern, strict=True):
            same = same & (F.col(x) == v)
        weight = F.when(same, p).otherwise(weight)
    judged = every.withColumn("p", weight).withColumn("features", span_features())
    sums = judged.select("p", F.explode("features").alias("f")).groupBy("f").agg(F.sum("p").alias("good"), F.sum(1 - F.col("p")).alias("bad")).collect()  # FEATURES rows at most
    log_odds, start = naive_bayes([(r["f"], r["good"], r["bad"]) for r in sums])
    table = _numbers(log_odds)
    first = F.get(_numbers(start), F.floor(F.get("features", F.lit(0)) / WIDTH).cast("int"))
    score = first + F.aggregate("features", F.lit(0.0), lambda a, f: a + F.get(table, f))
    added = judged.where(~F.col("base")).where(score >= math.log(accept / (1 - accept))).select("t1", "t2", "s", "rank", "e", "kind").distinct()
    added = added.groupBy(F.col("t1").alias("h1"), F.col("t2").alias("h2")).agg(F.collect_list(F.struct("s", "rank", "e", "kind")).alias("added"))
    added = written(added, "added")  # a table, so that a text of many rows can be split
    plain = F.transform("base", lambda x: F.struct(x.s.alias("s"), x["rank"].alias("rank"), x.e.alias("e"), x.kind.alias("kind")))
    joined = found.select("id", "t1", "t2", plain.alias("base")).join(added, (F.col("t1") == F.col("h1")) & (F.col("t2") == F.col("h2")), "left")
    count = lambda kind: F.size(F.filter("base", lambda x: x.kind == kind)).cast("bigint")
    whole = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", F.coalesce("added", F.array().cast("array<struct<s:int,rank:int,e:int,kind:string>>"))))
    return joined.select("id", *(count(k).alias(f"n_{k}") for k in BASE_KINDS), F.sha2(S.listed(F.col("base")), 256).alias("base_sha256"), S.listed(whole).alias("spans"))
