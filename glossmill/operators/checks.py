"""Audits of entries: findings by rule, cleanup candidates with reasons and severity, and their counts.

Input: entries (pos, title, url, plain, details). Rules are columns of one pass; several may hold for one entry.
Null texts have no findings but those about short ones; titles are compared folded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.keys import fold

FATAL = ("gallery-credit", "maintenance-text", "source-artifact", "truncated")
WARNING = ("short", "unresolved-forward")


def _rules(rules: list[tuple[str, Column, Column]]) -> Column:
    made = F.array(*[F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(kind).alias("kind"), detail.alias("detail"))) for kind, when, detail in rules])
    return F.filter(made, lambda x: x.isNotNull())


def audit(entries: DataFrame) -> DataFrame:
    """(kind, title, detail): findings that deserve a human look."""
    e = entries.withColumn("to", X.forward_target(F.col("plain"))).withColumn("word", fold("to"))
    titles = entries.select(fold("title").alias("word"), F.lit(True).alias("known")).distinct()
    e = e.join(titles, "word", "left")
    text = F.coalesce("plain", F.lit(""))
    rules = [
        ("unresolved-forward", F.col("to").isNotNull() & F.col("known").isNull(), F.col("to")),
        ("gallery-credit", text.rlike(r"(?iU)\b(?:official\s+art|art)\s+by\b"), text),
        ("maintenance-text", text.rlike(r"(?iU)duplicate page|for more information|please see"), text),
        ("source-artifact", text.rlike(r"(?U)\bisa\b|\bof\s+\.|\s+,|\s+\."), text),
        ("truncated", X.trails_off(text), text),
        ("short", (F.length(text) < 80) & (F.coalesce(F.size("details"), F.lit(0)) <= 0) & F.col("to").isNull(), text),
    ]
    return e.select("title", F.explode(_rules(rules)).alias("f")).select("f.kind", "title", "f.detail")


def audit_counts(entries: DataFrame) -> DataFrame:
    return audit(entries).groupBy("kind").agg(F.count("*").alias("n"))


def audit_severity(entries: DataFrame) -> DataFrame:
    """(severity, n): findings that stop a release and findings that don't."""
    return audit(entries).groupBy(F.when(F.col("kind").isin(*WARNING), "warning").otherwise("fatal").alias("severity")).agg(F.count("*").alias("n"))


def cleanup(entries: DataFrame) -> DataFrame:
    """(title, reasons, severity, detail, url): entries whose source page deserves cleanup."""
    text, title = X.squeezed(F.coalesce("plain", F.lit(""))), F.trim(F.col("title"))
    quoted = F.concat(F.lit(r"(?iU)^(?:the\s+)?\Q"), title, F.lit(r"\E\s+(?:is|are)\s+(?:a|an)\s+(?:item|race|spell|loot box|box|mob)\.?$"))
    generic = F.regexp_like(text, quoted)
    trails = X.trails_off(text) | ((F.length(text) < 120) & ~text.rlike("(?U)[.!?:;\"”']\\s*$"))
    lead = text.endswith(":") & text.rlike(r"(?iU)\b(?:describes?|description|message|voice|from|part of|as part of|of [^:]{1,80})\s*:\s*$")
    rules = [
        ("malformed-wiki-markup", text.rlike("'''|‘’’|’’’|‘‘‘")),
        ("title-only-definition", F.lower(F.trim(F.regexp_replace(text, r"[.!?]+$", ""))) == F.lower(title)),
        ("generated-section-label", text.rlike(r"(?U)\bSection of\s+[^:]{1,160}:\s*$")),
        ("generic-type-definition", generic),
        ("truncated-looking-definition", trails & ~generic),
        ("short-definition-without-sidebar", (F.length(text) < 80) & (F.coalesce(F.size("details"), F.lit(0)) <= 0)),
        ("quote-or-description-leadin-ending", lead),
    ]
    reasons = F.array_compact(F.array(*[F.when(F.coalesce(when, F.lit(False)), F.lit(name)) for name, when in rules]))
    e = entries.where(text != "").withColumn("reasons", reasons).where(F.size("reasons") > 0)
    has = lambda *names: F.arrays_overlap("reasons", F.array(*[F.lit(n) for n in names]))
    severity = F.when(has("malformed-wiki-markup", "title-only-definition", "truncated-looking-definition", "generated-section-label"), 0).when(has("generic-type-definition"), 1).when(has("short-definition-without-sidebar"), 2).otherwise(3)
    return e.select("title", F.array_join("reasons", "|").alias("reasons"), severity.alias("severity"), X.snippet(text).alias("detail"), "url")


def title_collisions(entries: DataFrame) -> DataFrame:
    """(word, n): folded titles of more than one entry; must be empty before an index is built."""
    return entries.groupBy(fold("title").alias("word")).agg(F.count("*").alias("n")).where("n > 1")
