"""Dictionary entries from the page store: clean, filter, redirects, titles, forwarding.

Defined cases: of several rows of a page the newest that is ok, in scope and has a paragraph counts; stores
without ``source_category`` or ``in_scope`` are read as if all pages were in scope and had none; unresolvable,
missing and circular forwards stay as they are; order is the ASCII-lower order of the stored titles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..functions import text as X
from ..functions.keys import collapse, fold
from ..plans.lineage import cut
from ..sources.tables import optional
from .index import ranked


def usable_pages(pages: DataFrame) -> DataFrame:
    """The newest usable row of each page; only six columns are read."""
    p = optional(optional(optional(pages, "source_category", "string"), "in_scope", "int", 1), "fetched_at", "timestamp")
    p = p.where((F.col("status") == "ok") & (F.coalesce("first_paragraph", F.lit("")) != "") & (F.col("in_scope") == 1))
    key = F.coalesce(F.col("pageid").cast("string"), F.col("title")) if "pageid" in pages.columns else F.col("title")
    row = ("title", "url", "first_paragraph", "raw_html", "source_category")
    newest = F.max_by(F.struct(*row), F.struct("fetched_at", F.xxhash64(*row)))  # of equal times one, told by its hash
    return p.groupBy(key.alias("_key")).agg(newest.alias("x")).select("x.*")


def categories_from(column: Column) -> Column:
    """A comma-separated list as an array without prefixes, and without what repeats but for case (the first stays)."""
    parts = F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), ","), lambda c: F.trim(F.regexp_replace(X.squeezed(c), "^Category:", ""))), lambda c: c != "")
    return F.aggregate(parts, F.array().cast("array<string>"), lambda acc, c: F.when(F.exists(acc, lambda a: F.lower(a) == F.lower(c)), acc).otherwise(F.array_append(acc, c)))


def redirect_aliases(redirects: DataFrame) -> DataFrame:
    """(word, redirect_aliases): for each folded target its distinct sources in ASCII-lower order."""
    r = redirects.where((F.col("status") == "ok") & (F.coalesce("source_title", F.lit("")) != "") & (F.coalesce("target_title", F.lit("")) != "")).select("source_title", "target_title").distinct()
    r = r.select(X.ascii_lower(F.col("source_title")).alias("o"), "source_title", collapse("source_title").alias("s"), collapse("target_title").alias("t")).where("s <> '' AND t <> ''")
    return r.select(fold("t").alias("word"), F.struct("o", "source_title", "s").alias("x")).groupBy("word").agg(F.array_distinct(F.transform(F.sort_array(F.collect_set("x")), lambda y: y.s)).alias("redirect_aliases"))


def munged_titles(entries: DataFrame) -> DataFrame:
    """Titles without a trailing parenthetical where only one title strips to that and no title is that."""
    e = entries.withColumn("_bare", X.without_parenthetical(F.col("title")))
    bare = e.where("_bare IS NOT NULL").select(fold("_bare").alias("_word")).groupBy("_word").agg(F.count("*").alias("_n"))
    taken = e.select(fold("title").alias("_word")).distinct()
    free = bare.where("_n = 1").join(taken, "_word", "left_anti").select("_word", F.lit(True).alias("_free"))
    j = e.withColumn("_word", fold("_bare")).join(free, "_word", "left")
    return j.withColumn("title", F.when(F.col("_free"), F.col("_bare")).otherwise(F.col("title"))).drop("_bare", "_word", "_free")


def forwarding(entries: DataFrame, rounds: int = 30) -> DataFrame:
    """(pos, final): for each forwarding entry the pos of the entry its chain ends at, where that forwards no more.

    Chains are followed by pointer doubling, so their length costs its logarithm in joins; ``rounds`` of it are
    more than any chain can need. Cycles and missing targets have no row.
    """
    e = entries.select("pos", "title", X.forward_target(F.col("plain")).alias("to"))
    exact = e.groupBy("title").agg(F.max("pos").alias("exact")).withColumnRenamed("title", "to")
    folded = e.select(fold("title").alias("w"), "pos").groupBy("w").agg(F.max("pos").alias("folded"))
    link = e.where("to IS NOT NULL").select("pos", "to", fold("to").alias("w")).join(exact, "to", "left").join(folded, "w", "left")
    link = cut(link.select("pos", F.coalesce("exact", "folded").alias("next")).where("next IS NOT NULL"), "links")
    ends = e.where("to IS NULL").select("pos")
    done = link.join(ends.withColumnRenamed("pos", "next"), "next", "left_semi").select("pos", F.col("next").alias("final"))
    open_ = link.join(done.select("pos"), "pos", "left_anti")
    for _ in range(rounds):
        open_ = cut(open_, "open")
        if open_.isEmpty():
            break
        done = cut(done, "done")
        more = open_.join(done.select(F.col("pos").alias("next"), "final"), "next").select("pos", "final")
        left = open_.join(more.select("pos"), "pos", "left_anti")
        hop = open_.select(F.col("pos").alias("next"), F.col("next").alias("hop"))
        jumped = left.join(hop, "next").select("pos", F.col("hop").alias("next")).where("pos <> next")
        if more.isEmpty() and jumped.isEmpty():
            break
        done, open_ = done.unionByName(more), jumped
    return done


def resolved(entries: DataFrame) -> DataFrame:
    """Forwarding entries with the definition, notice and details of where they lead."""
    final = forwarding(entries)
    source = entries.select(F.col("pos").alias("final"), F.struct("definition", "plain", "spoiler_notice", "details").alias("_to"))
    j = entries.join(final.join(source, "final").select("pos", "_to"), "pos", "left")
    take = lambda c: F.when(F.col("_to").isNotNull(), F.col(f"_to.{c}")).otherwise(F.col(c)).alias(c)
    return j.select("pos", "title", "url", take("definition"), take("plain"), take("spoiler_notice"), take("details"), "source_categories", "redirect_aliases")


def is_leftover(title: Column, plain: Column, details: Column) -> Column:
    """Whether a definition is no more than ``Title is``."""
    t, d = F.lower(title), F.regexp_replace(F.lower(plain), r"\.+$", "")
    return (F.size(details) <= 0) & X.forward_target(plain).isNull() & d.isin(F.concat(t, F.lit(" is")), F.concat(t, F.lit(" was")), F.concat(t, F.lit(" are")))


def assembled(pages: DataFrame, redirects: DataFrame, least: int = 8, strip_parenthetical: bool = True, most: int | None = None) -> DataFrame:
    """(pos, title, url, definition, plain, spoiler_notice, details, source_categories, redirect_aliases)."""
    p = usable_pages(pages)
    clean = markup.sanitized(X.without_artifacts(F.col("first_paragraph")))
    p = p.select(F.col("title").alias("_stored"), collapse("title").alias("title"), "url", (markup.trimmed(clean, most) if most else clean).alias("definition"), markup.details("raw_html").alias("details"), markup.spoiler("raw_html").alias("spoiler_notice"), categories_from(F.col("source_category")).alias("source_categories"))
    p = p.withColumn("plain", markup.plain("definition"))
    p = p.where((F.length("plain") >= least) | X.forward_target(F.col("plain")).isNotNull() | (F.size("details") > 0))
    p = p.withColumn("word", fold("title")).join(redirect_aliases(redirects), "word", "left").drop("word")
    p = p.withColumn("redirect_aliases", F.coalesce("redirect_aliases", F.array().cast("array<string>")))
    # of entries whose titles fold alike the last in this order is the one that forwards lead to
    p = ranked(p, [X.ascii_lower(F.col("_stored")), F.col("_stored"), F.col("url"), F.col("definition")], "pos")
    p = cut(p.select(F.col("pos").cast("bigint").alias("pos"), *[c for c in p.columns if c not in ("pos", "_stored")]), "entries")
    if strip_parenthetical:
        p = munged_titles(p)
    p = resolved(cut(p, "titles"))
    return p.where(~is_leftover(F.col("title"), F.col("plain"), F.col("details")))


def ordered(entries: DataFrame) -> DataFrame:
    """Entries with ``rank`` from 1 in ASCII-lower order of their titles, numbered without one task sorting all."""
    return ranked(entries, [X.ascii_lower(F.col("title")), F.col("title"), F.col("pos")], "rank")


def out_of_scope(entries: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """Entries with categories none of which is configured."""
    plain = lambda c: F.lower(F.replace(F.regexp_replace(c, "^Category:", ""), F.lit("_"), F.lit(" ")))
    wanted = F.array(*[F.lit(c.removeprefix("Category:").replace("_", " ").lower()) for c in categories])
    return entries.where((F.size("source_categories") > 0) & ~F.arrays_overlap(F.transform("source_categories", plain), wanted))
