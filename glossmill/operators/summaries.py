"""Summaries of pages from their HTML: parsing once per page in Arrow batches, the choice among blocks in Catalyst.

A page without any summary is empty. Null HTML is an empty page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..functions import text as X
from ..plans.lineage import cut

STATLINE = r"(?iU)\b(?:loot|reward|cost|target|duration|range|cooldown|type|source)\s*:"


def _bare(fragment: Column) -> Column:
    """Plain text of safe inline HTML."""
    t = F.regexp_replace(fragment, "</?[bi]>", "")
    return X.squeezed(F.replace(F.replace(F.replace(t, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&")))


def lower_first(fragment: Column) -> Column:
    """First visible ASCII capital in lower case."""
    head, letter = F.regexp_extract(fragment, r"^((?:<[^>]+>|\s)*)([A-Z])", 1), F.regexp_extract(fragment, r"^((?:<[^>]+>|\s)*)([A-Z])", 2)
    return F.when(letter != "", F.concat(head, F.lower(letter), F.substring(fragment, F.length(head) + 2, F.length(fragment)))).otherwise(fragment)


def summaries(pages: DataFrame, most: int | None = None) -> DataFrame:
    """(pageid, title, status, summary): status is ok, or empty where nothing was found."""
    p = pages.select("pageid", "title", "raw_html").distinct()
    # the parsers' output is written once: what follows uses each column several times
    p = cut(p.select("pageid", "title", markup.blocks("raw_html").alias("b"), markup.ai_description("raw_html").alias("ai"), markup.infobox_line("title", "raw_html").alias("box")), "blocks")
    intro, later = F.col("b.intro"), F.filter("b.later", lambda x: ~_bare(x).rlike(STATLINE))
    first, second, third = F.get(intro, F.lit(0)), F.get(intro, F.lit(1)), F.get(later, F.lit(0))
    p = p.select("pageid", "title", "ai", "box", first.alias("first"), second.alias("second"), third.alias("third"))
    low, name = F.regexp_replace(F.lower(_bare(F.col("first"))), r"\.+$", ""), X.squeezed(F.lower(F.col("title")))
    said = lambda *tails: low.isin(*[F.concat(name, F.lit(t)) for t in tails])
    stub = said(" is", " was", " are")
    generic = (F.length(low) < markup.SHORT) & said(" is a spell", " is an item", " is a loot box", " is a box", " are loot boxes")
    trails = X.trails_off(_bare(F.col("first")))
    short = lambda c: F.length(_bare(c)) < markup.SHORT
    more = F.when((short(F.col("first")) | trails) & F.col("second").isNotNull(), X.squeezed(F.concat_ws(" ", "first", F.when(trails, lower_first(F.col("second"))).otherwise(F.col("second"))))).otherwise(F.col("first"))
    p = p.withColumn("s", F.when((stub | generic | trails) & (F.col("ai") != ""), F.col("ai")).otherwise(more))
    low2 = F.regexp_replace(F.lower(_bare(F.col("s"))), r"\.+$", "")
    broken = low2.isin(F.concat(name, F.lit(" is")), F.concat(name, F.lit(" was")), F.concat(name, F.lit(" are")))
    p = p.withColumn("s", F.when(broken & F.col("third").isNotNull(), F.col("third")).otherwise(F.col("s")))
    p = p.withColumn("s", F.when(short(F.col("s")) & F.col("third").isNotNull() & (F.col("s") != F.col("third")), X.squeezed(F.concat_ws(" ", "s", "third"))).otherwise(F.col("s")))
    summary = F.coalesce(F.nullif(F.col("s"), F.lit("")), F.nullif(F.col("box"), F.lit("")), F.lit(""))
    summary = X.without_artifacts(markup.trimmed(summary, most) if most else summary)
    return p.select("pageid", "title", F.when(summary != "", "ok").otherwise("empty").alias("status"), summary.alias("summary"))


def reextracted(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Summaries of the stored HTML of pages that didn't fail."""
    return summaries(pages.where((F.col("status") != "error") & (F.coalesce("raw_html", F.lit("")) != "")), most)
