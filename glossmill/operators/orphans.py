"""References to records that do not exist.

References and parents are brought to one title key, co-partitioned and sorted by it, and merged in one
pass (a sort-merge join). A parent is one row per key with its validity intervals, so a reference's own
time decides between a key that never was (missing), one that was deleted, and one that came later (late).
Hot reference keys are salted; the parent side is unique by key and never grows with the references.

Defined cases: references without a target are none; the empty key is a key like any other; equal
references of a month count once; a null time leaves only list pages as parents; a null source gives a
null ``from_key``; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import title_key, unescape
from ..plans.lineage import cut, salted_join

#: The forms of a definition that only sends the reader on, in the order they are tried.
POINTERS = (
    r"(?:siehe|voir|véase|see)(?: also| auch| aussi)?\s*:\s*(.+)",
    r"duplicate page\s*-\s*please see\s*:?\s+(.+)",
    r"(?:system message:\s*)?for .+?,\s*(?:please )?see\s+(.+)",
    r"please see\s*:?\s+(.+)",
    r"(?:→|⇒|->|=>)\s*(.+)",
    r"(?:this (?:entry|page|article) (?:has been|was) )?(?:moved|merged|redirected)\s+(?:in)?to\s+(.+)",
    r"(?:#\s*)?redirects?(?: to)?\s*:?\s+(.+)",
)


#: How a pointer begins: only texts that begin so are held against the forms.
BEGINS = r"(?iu)^(?:siehe|voir|véase|see|duplicate|system message|for |please|→|⇒|->|=>|moved|merged|redirect|#|this (?:entry|page|article))"


def pointer_target(definition: Column) -> Column:
    """The title that a definition sends the reader to, or null where it says more than that.

    Markup and a final full stop are not part of it. A target with a sentence end inside is no pointer.
    """
    plain = F.trim(F.regexp_replace(F.regexp_replace(definition, r"</?[A-Za-z][^<>]*>", ""), r"(?U)\s+", " "))
    found = F.coalesce(*[F.nullif(F.regexp_extract(plain, rf"(?iu)^{p}$", 1), F.lit("")) for p in POINTERS])
    found = F.regexp_replace(F.regexp_replace(found, r"^\[\[|\]\]\s*\.?$", ""), r"\s*\.\s*$", "")
    one = ~found.rlike(r"[.!?]\s+\S") | found.rlike(r"^(?:\S+ )?(?:Mr|Mrs|Ms|Dr|St)\. \S+( \S+)?$")
    return F.when(plain.rlike(BEGINS) & one, F.nullif(found, F.lit("")))


def references(redirects: DataFrame, entries: DataFrame) -> DataFrame:
    """(rec_table, from_key, to_key, at): each distinct reference."""
    r = redirects.where(F.col("target_title").isNotNull()).select(F.lit("redirects").alias("rec_table"), "source_title", F.col("target_title").alias("to_title"), F.col("fetched_at").alias("at"))
    e = entries.where(F.col("definition").isNotNull()).select(F.lit("entries").alias("rec_table"), F.col("title").alias("source_title"), pointer_target(F.col("definition")).alias("to_title"), F.col("built_at").alias("at"))
    e = e.where(F.col("to_title").isNotNull()).withColumn("to_title", unescape("to_title"))
    both = r.unionByName(e).distinct()
    return both.select("rec_table", title_key("source_title").alias("from_key"), title_key("to_title").alias("to_key"), "at").distinct()


def parents(pages: DataFrame, list_pages: DataFrame, redirects: DataFrame, deletions: DataFrame) -> DataFrame:
    """One row per title key: is_list, redirect_from, page_from, gone (its deletions, overlapping ones united); null where there is none.

    All sides are reduced by partial aggregation before they are shuffled; ``gone`` has disjoint intervals only.
    """
    page = pages.groupBy("title").agg(F.min("fetched_at").alias("page_from")).select(title_key("title").alias("key"), F.lit(False).alias("is_list"), F.lit(None).cast("timestamp_ntz").alias("redirect_from"), F.col("page_from").cast("timestamp_ntz"))
    listed = list_pages.select(title_key("title").alias("key"), F.lit(True).alias("is_list"), F.lit(None).cast("timestamp_ntz").alias("redirect_from"), F.lit(None).cast("timestamp_ntz").alias("page_from"))
    pairs = redirects.select(title_key("source_title").alias("key"), title_key("target_title").alias("to"), "fetched_at")
    source = pairs.where(F.col("to").isNull() | (F.col("key") != F.col("to"))).groupBy("key").agg(F.min("fetched_at").cast("timestamp_ntz").alias("redirect_from"))
    source = source.select("key", F.lit(False).alias("is_list"), "redirect_from", F.lit(None).cast("timestamp_ntz").alias("page_from"))
    have = page.unionByName(listed).unionByName(source).where("key IS NOT NULL").groupBy("key").agg(F.max("is_list").alias("is_list"), F.min("redirect_from").alias("redirect_from"), F.min("page_from").alias("page_from"))
    return have.join(deletion_intervals(deletions), "key", "full")  # a title that was deleted was there, crawled or not


def deletion_intervals(deletions: DataFrame) -> DataFrame:
    """key, gone: array of disjoint struct(deleted_at, restored_at) in order; restored_at is null while it lasts."""
    from pyspark.sql import Window

    d = deletions.where("deleted_at IS NOT NULL").select("title", "deleted_at", "restored_at").distinct()
    d = d.select(title_key("title").alias("key"), F.col("deleted_at").cast("timestamp_ntz").alias("a"), F.col("restored_at").cast("timestamp_ntz").alias("b")).where("key IS NOT NULL AND (b IS NULL OR b > a)").distinct()
    endless = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    order = Window.partitionBy("key").orderBy("a", "b")
    before = F.max(F.coalesce("b", endless)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("new", F.when(before.isNull() | (F.col("a") > before), 1).otherwise(0)).withColumn("run", F.sum("new").over(order))
    d = d.groupBy("key", "run").agg(F.min("a").alias("deleted_at"), F.when(F.max(F.col("b").isNull()), F.lit(None).cast("timestamp_ntz")).otherwise(F.max("b")).alias("restored_at"))
    return d.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("deleted_at", "restored_at"))).alias("gone"))


def judged_references(pages: DataFrame, list_pages: DataFrame, redirects: DataFrame, entries: DataFrame, deletions: DataFrame) -> DataFrame:
    """Each reference with ``cause``: null where its target exists, else missing, deleted or late."""
    ref = cut(references(redirects, entries).withColumn("at", F.col("at").cast("timestamp_ntz")).withColumnRenamed("to_key", "key"), "references")
    par = parents(pages, list_pages, redirects, deletions)
    both = salted_join(ref, par.hint("merge"), "key")
    at = F.col("at")
    is_gone = F.coalesce(F.exists("gone", lambda g: (g.deleted_at <= at) & (g.restored_at.isNull() | (g.restored_at > at))), F.lit(False))
    alive = F.coalesce(F.col("is_list"), F.lit(False)) | F.coalesce(F.col("redirect_from") <= at, F.lit(False)) | (F.coalesce(F.col("page_from") <= at, F.lit(False)) & ~is_gone)
    cause = F.when(alive, F.lit(None).cast("string")).when(is_gone, "deleted").when((F.col("redirect_from") > at) | (F.col("page_from") > at), "late").otherwise("missing")
    return both.select("rec_table", "from_key", F.col("key").alias("to_key"), F.date_format(at, "yyyy-MM").alias("ref_month"), cause.alias("cause"))


def orphans(*tables: DataFrame) -> DataFrame:
    """Orphan references (rec_table, from_key, to_key, ref_month), once each."""
    return judged_references(*tables).where("cause IS NOT NULL").drop("cause").distinct()


def orphan_report(*tables: DataFrame) -> DataFrame:
    """Per table and month: references, orphans, and orphans by cause."""
    j = judged_references(*tables)
    by = lambda c: F.count_if(F.col("cause") == c)
    return j.groupBy("rec_table", "ref_month").agg(F.count("*").alias("n_references"), F.count("cause").alias("n_orphans"), by("missing").alias("n_missing"), by("deleted").alias("n_deleted"), by("late").alias("n_late"))
