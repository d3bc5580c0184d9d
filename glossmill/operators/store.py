"""State of the page store: upserts, last-known-good content, scope, redirects, crawl lists and counts.

All are batch transforms of whole tables; each key's rows meet in one aggregation with partial aggregation, so a
page that was fetched a million times is reduced before it is shuffled. Null keys are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import fold

KEPT = ("ok", "empty")


def _time(rows: DataFrame, order: str) -> Column:
    """Ties of time are broken by the rest of the row, so that a result doesn't depend on row order."""
    rest = [c for c, kind in rows.dtypes if c != order and not kind.startswith(("map", "variant"))]
    return F.struct(F.col(order), *[F.col(c) for c in sorted(rest)])


def upsert(stored: DataFrame, incoming: DataFrame, key: str = "pageid", order: str = "fetched_at") -> DataFrame:
    """``stored`` with the latest row of each key of both."""
    both = stored.unionByName(incoming, allowMissingColumns=True).where(F.col(key).isNotNull())
    return both.groupBy(key).agg(F.max_by(F.struct(*[c for c in both.columns if c != key]), _time(both, order)).alias("x")).select(key, "x.*").select(*both.columns)


def last_known_good(attempts: DataFrame, key: str = "pageid", order: str = "fetched_at") -> DataFrame:
    """Per key the content of the latest attempt that was kept, with the address of the latest of all.

    A failed attempt never erases content: it only leaves its message in ``last_attempt_error``. A key that only
    failed is an error.
    """
    a = attempts.where(F.col(key).isNotNull())
    good = F.col("status").isin(*KEPT)
    content = F.struct("status", "raw_json", "raw_html", "first_paragraph", "error", F.col(order).alias("good_at"))
    place = F.struct("title", "url", "status", "error", F.col(order).alias("tried_at"))
    g = a.groupBy(key).agg(F.max_by(F.when(good, content), F.when(good, _time(a, order))).alias("g"), F.max_by(place, _time(a, order)).alias("p"))
    failed_later = ~F.coalesce(F.col("p.status"), F.lit("error")).isin(*KEPT)
    return g.select(key, "p.title", "p.url", F.coalesce("g.status", F.lit("error")).alias("status"), "g.raw_json", "g.raw_html", "g.first_paragraph", F.when(F.col("g").isNull(), F.col("p.error")).otherwise(F.col("g.error")).alias("error"), F.when(failed_later & F.col("g").isNotNull(), F.coalesce("p.error", F.lit("error"))).alias("last_attempt_error"), F.col("p.tried_at").alias("fetched_at"))


def listed_categories(listing: DataFrame) -> DataFrame:
    """(pageid, source_category, first_seen) of a listing (pageid, category, seq): categories in first-seen order, once each."""
    each = listing.where("pageid IS NOT NULL AND category IS NOT NULL").groupBy("pageid", "category").agg(F.min("seq").alias("seq"))
    return each.groupBy("pageid").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "category"))), lambda x: x.category), ", ").alias("source_category"), F.min("seq").alias("first_seen"))


def synced_scope(pages: DataFrame, listed: DataFrame, replace: bool = True) -> DataFrame:
    """Pages with scope and categories of the latest listing; pages that aren't listed leave the scope if ``replace``."""
    now = listed.select("pageid", F.col("source_category").alias("_now"), F.lit(True).alias("_listed")).dropDuplicates(["pageid"])
    j = pages.join(now, "pageid", "left")
    scope = F.when(F.col("_listed"), F.lit(1)).otherwise(F.lit(0) if replace else F.col("in_scope"))
    return j.withColumn("in_scope", scope.cast("int")).withColumn("source_category", F.coalesce("_now", "source_category")).select(*pages.columns)


def still_to_fetch(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """Targets without a page that is ok; empty and failed pages are fetched again."""
    return targets.join(pages.where("status = 'ok'").select("pageid").distinct(), "pageid", "left_anti")


def classified_redirects(redirects: DataFrame, titles: DataFrame) -> DataFrame:
    """Redirects with status ok, ignored (target isn't a target of the crawl) or error (unresolved); the target's
    spelling becomes the canonical one."""
    t = titles.where("title IS NOT NULL").groupBy(fold("title").alias("_word")).agg(F.max("title").alias("_title"))
    j = redirects.withColumn("_word", fold("target_title")).join(t, "_word", "left")
    status = F.when(F.coalesce("target_title", F.lit("")) == "", "error").when(F.col("_title").isNull(), "ignored").otherwise("ok")
    return j.withColumn("status", status).withColumn("target_title", F.coalesce("_title", "target_title")).select(*redirects.columns)


def crawl_counts(pages: DataFrame) -> DataFrame:
    """One row of counts of a store by status, scope and kept error."""
    n = lambda c: F.count_if(c)
    return pages.agg(
        F.count("*").alias("n_pages"), n(F.col("status") == "ok").alias("n_ok"), n(F.col("status") == "empty").alias("n_empty"), n(F.col("status") == "error").alias("n_error"),
        n(F.col("in_scope") == 1).alias("n_in_scope"), n(F.col("last_attempt_error").isNotNull()).alias("n_kept_error"),
    )


def capped(listing: DataFrame, group: str, order: str, most: int) -> DataFrame:
    """The first rows of each group: a crawl's page limit per category. The window keeps no more than ``most`` a group."""
    w = Window.partitionBy(group).orderBy(order)
    return listing.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def chunks(values: DataFrame, column: str, size: int) -> DataFrame:
    """(chunk, values): distinct values in order, ``size`` to a chunk."""
    from .index import ranked

    r = ranked(values.select(column).where(F.col(column).isNotNull()).distinct(), [F.col(column)], "_r")
    return r.groupBy(F.floor((F.col("_r") - 1) / size).alias("chunk")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", column))), lambda x: x[column]), "|").alias("values"))


def metadata_upsert(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Key and value rows with ``incoming`` winning."""
    new = incoming.select("meta_key", "meta_value").groupBy("meta_key").agg(F.max("meta_value").alias("meta_value"))
    return stored.select("meta_key", "meta_value").join(new.select("meta_key"), "meta_key", "left_anti").unionByName(new)


def fetched_pages(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """``stored`` with pages that were fetched: they are in scope again and no longer have the kept error of an earlier attempt."""
    fresh = fetched.withColumn("in_scope", F.lit(1)).withColumn("last_attempt_error", F.lit(None).cast("string"))
    return upsert(stored, fresh).select(*stored.columns)


def replaced_redirects(stored: DataFrame, listing: DataFrame | None, titles: DataFrame, most: bool = False) -> DataFrame:
    """The redirects after a listing: all of them anew, ``stored`` as it was if the listing failed (None), or, of a
    listing that was stopped early (``most``), ``stored`` with the listed sources replaced."""
    if listing is None:
        return stored
    new = classified_redirects(listing, titles)
    if most:
        new = stored.join(new.select("source_title").distinct(), "source_title", "left_anti").select(*stored.columns).unionByName(new, allowMissingColumns=True)
    return new


def run_counts(targets: DataFrame, stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """One row: pages fetched, of these empty and failed, and targets skipped as they were ok."""
    got = fetched.agg(F.count("*").alias("n_fetched"), F.count_if(F.col("status") == "empty").alias("n_empty"), F.count_if(F.col("status") == "error").alias("n_failed"), F.lit(0).cast("bigint").alias("n_skipped"))
    kept = targets.select("pageid").distinct().join(still_to_fetch(targets, stored).select("pageid"), "pageid", "left_anti")
    skipped = kept.agg(*[F.lit(0).cast("bigint").alias(c) for c in ("n_fetched", "n_empty", "n_failed")], F.count("*").alias("n_skipped"))
    return got.unionByName(skipped).agg(*[F.sum(c).alias(c) for c in ("n_fetched", "n_empty", "n_failed", "n_skipped")])
