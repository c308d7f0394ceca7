"""Operator 1: personal data. Regular expressions propose spans, checksums confirm them, context words adjust scores.

All of it is built from Spark's own functions. ``regexp_extract_all`` gives the matches of a pattern and ``split``
the gaps between them; summing their lengths gives the places. The patterns are written so that Java's engine
takes linear time and constant stack on any text: possessive loops, and a look-behind (or ``\\G``, the end of
the last match) that keeps it from trying each place inside a run again. They match what the plain forms match.

Base kinds (a match either passes or is dropped): email; ip (four parts up to 255); card (12 to 19 digits, Luhn);
phone (``+`` and 9 to 15 digits). Scored kinds, kept from ``KEEP`` on: iban (mod-97 confirms), ssn
(area, group and serial that can be issued), secret (long token after a key word). A score is the kind's prior, plus the checksum's, plus ``CONTEXT``
where one of the kind's context words stands within ``NEAR`` code points before the span.

Defined results: a null text counts as empty and has no spans; places are code points, the end exclusive; spans are ordered by start, then by kind
as in ``KINDS``; repeated rows give repeated results. ``with_spans`` raises an error where its new column is there already; ``redact`` keeps every column and null texts as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm.common import free_names

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE = KINDS[:4]
NEAR = 40
CONTEXT = 0.3
KEEP = 0.8

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a whole run of digits with single separators, if it has 12 to 19 of them
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{24,}+",
}
#: What a text must hold at least, so that most texts skip a pattern.
HINTS = {"email": "@", "phone": "+", "ssn": "-"}
PRIOR = {"iban": 0.2, "ssn": 0.5, "secret": 0.5}
CHECKED = {"iban": 0.7, "ssn": 0.1, "secret": 0.1}
WORDS = {
    "iban": r"(?i)\b(?:iban|account|konto|compte|cuenta|bank)\b",
    "ssn": r"(?i)\b(?:ssn|social|security)\b",
    "secret": r"(?i)(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|private[_-]?key|bearer|credential)",
}


def _literal(text: str) -> Column:
    return F.lit(text)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    length = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), length),
        F.lit(0),
        lambda acc, i: acc + F.when((length - i) % 2 == 0, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substr(digits, i, F.lit(1)).cast("int") + 1)
        ),
    )
    return (length > 0) & (total % 10 == 0)


def mod97(account: Column) -> Column:
    """Whether an account number (upper case, no spaces) leaves 1 modulo 97 in the ISO 7064 way."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    code = lambda c: F.ascii(c)
    rest = F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        F.lit(0),
        lambda acc, c: F.when(code(c) < 65, acc * 10 + code(c) - 48).otherwise(acc * 100 + code(c) - 55) % 97,
    )
    return rest == 1


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _passes(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9]?)"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        plain = F.replace(match, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & mod97(plain)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9)") & ~match.rlike("-00-") & ~match.rlike("-0000$")
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]")


def _proposed(text: Column, kind: str) -> Column:
    """Matches of the kind with their places: array of struct(kind, rank, start, end, match)."""
    pattern = PATTERNS[kind]
    matches = F.regexp_extract_all(text, _literal(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    empty = F.array().cast("array<struct<rank:int,start:int,end:int,match:string>>")

    def placed(found: Column, spaces: Column) -> Column:
        zipped = F.zip_with(found, F.slice(spaces, 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
        start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        summed = F.aggregate(
            zipped,
            start,
            lambda acc, x: F.struct(
                (acc["at"] + x["g"] + F.length(x["m"])).alias("at"),
                F.concat(acc["out"], F.array(F.struct(F.lit(KINDS.index(kind)).alias("rank"), (acc["at"] + x["g"]).alias("start"), (acc["at"] + x["g"] + F.length(x["m"])).alias("end"), x["m"].alias("match")))).alias("out"),
            ),
        )
        return summed["out"]

    able = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else text.rlike(pattern)
    return F.when(able, F.filter(placed(matches, gaps), lambda s: _passes(kind, s["match"]))).otherwise(empty)


def _scored(text: Column, spans: Column, kind: str) -> Column:
    """Of spans that passed their check, those whose score with the context reaches KEEP."""
    before = lambda s: F.substr(text, F.greatest(s["start"] + 1 - NEAR, F.lit(1)), F.least(s["start"], F.lit(NEAR)))
    score = lambda s: F.lit(PRIOR[kind] + CHECKED[kind]) + F.when(before(s).rlike(WORDS[kind]), CONTEXT).otherwise(0.0)
    return F.filter(spans, lambda s: score(s) >= KEEP - 1e-9)


def with_spans(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``df`` with an array of struct(rank, start, end, match), ordered by start, then kind, in a new column."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"there is a column {out} already")
    work = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    base = F.concat(*(_proposed(work, kind) for kind in BASE))
    more = F.concat(*(_scored(work, _proposed(work, kind), kind) for kind in KINDS[4:]))
    ordered = lambda spans: F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["match"]))), lambda s: F.struct(s["rank"], s["start"], s["end"], s["match"]))
    return df.withColumn(out, ordered(F.concat(base, more)))


def _text_of(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Spans replaced by ``<KIND>``; where spans overlap, the first keeps its place and the others' rest goes with it."""
    (own,) = free_names(df, "__spans")
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    source = F.col(f"`{text}`")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.substr(source, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["rank"] + 1))).alias("out"),
    )
    built = F.aggregate(F.col(own), start, step, lambda acc: F.concat(acc["out"], F.substr(source, acc["at"] + 1)))
    clean = F.when(source.isNull() | (F.size(own) == 0), source).otherwise(built)
    return with_spans(df, text, own).withColumn(text, clean).drop(own)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_spans(docs).withColumn("base", F.filter("spans", lambda s: s["rank"] < len(BASE)))
    of_rank = lambda k: F.filter("spans", lambda s: s["rank"] == k)
    counts = [F.size(of_rank(k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_text_of(F.col("base")).cast("binary"), 256).alias("base_sha256"), _text_of(F.col("spans")).alias("spans"))
