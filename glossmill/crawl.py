"""One run of a crawl: list the wiki's categories, fetch what isn't ok yet, make summaries, refresh the redirects.

A run that stops is taken up by the next: pages that are ok aren't fetched again, a failed attempt never erases
content, and each table is replaced in one step. Fetches are spread over ``partitions`` readers that keep the wiki's
pause each; the list of page ids goes to them in ``batch`` pieces, so that no more than one piece is in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .functions.keys import fold
from .operators import store, summaries
from .plans.lineage import cut
from .sources import files, mediawiki


def _listed(spark: SparkSession, api: str, categories: tuple[str, ...], options: dict) -> DataFrame:
    return cut(mediawiki.read_wiki(spark, api, "categories", categories=list(categories), **options), "listing")


def attempts(spark: SparkSession, api: str, base: str, todo: DataFrame, most: int | None, options: dict) -> DataFrame:
    """Fetched pages of ``todo`` (pageid, title, ns) with their summaries and states."""
    ids = [r[0] for r in todo.select("pageid").orderBy("pageid").collect()]
    raw = mediawiki.read_wiki(spark, api, "pages", pageids=ids, **options)
    raw = cut(raw.join(todo.select("pageid", "title", "ns"), "pageid"), "fetched")
    made = summaries.summaries(raw.where("error IS NULL AND coalesce(raw_html, '') <> ''"), most).select("pageid", "status", F.col("summary").alias("first_paragraph"))
    j = raw.join(made, "pageid", "left")
    status = F.when(F.col("error").isNotNull(), "error").otherwise(F.coalesce("status", F.lit("empty")))
    return j.select("pageid", "title", "ns", X.page_url(F.lit(base), F.col("title")).alias("url"), "raw_json", "raw_html", "first_paragraph", status.alias("status"), "error", F.current_timestamp().cast("timestamp_ntz").alias("fetched_at"))


def run(spark: SparkSession, folder: str, api: str, categories: tuple[str, ...], agent: str, most: int | None = None, batch: int = 10_000, redirects: bool = True, **options) -> dict[str, int]:
    """Brings the store in ``folder`` up to date; returns counts. Raises PermissionError where robots.txt forbids it."""
    mediawiki.assert_allowed(api, agent)
    options = {"agent": agent, **options}
    base = api.rsplit("/", 1)[0]
    place = lambda name: f"{folder}/{name}.parquet"
    listing = _listed(spark, api, categories, options)
    targets = listing.groupBy("pageid").agg(F.max("title").alias("title"), F.max("ns").alias("ns"))
    listed = store.listed_categories(listing)
    pages = files.open_store(spark, folder)["pages"]
    todo = cut(store.still_to_fetch(targets, pages).withColumn("part", F.pmod(F.xxhash64("pageid"), F.greatest(F.lit(1), F.ceil(F.lit(targets.count() / batch))))), "todo")
    counts: dict[str, int] = dict.fromkeys(("n_fetched", "n_empty", "n_failed"), 0)
    counts["n_skipped"] = targets.count() - todo.count()
    for part in [r[0] for r in todo.select("part").distinct().orderBy("part").collect()]:  # as many as there are batches
        pages = files.open_store(spark, folder)["pages"]
        got = cut(attempts(spark, api, base, todo.where(F.col("part") == part), most, options), "attempts")
        for name, n in store.run_counts(targets, pages, got).first().asDict().items():
            counts[name] += n if name != "n_skipped" else 0
        kept = got.where(F.col("status").isin(*store.KEPT)).withColumn("source_category", F.lit(None).cast("string"))
        failed = got.where("status = 'error'").select("pageid", "title", "ns", "url", "error", "fetched_at")
        known = store.fetched_pages(pages, kept.select(*[c for c in pages.columns if c in kept.columns]))
        known = known.join(failed.select("pageid", F.col("error").alias("_error")), "pageid", "left").withColumn("last_attempt_error", F.coalesce("_error", "last_attempt_error")).drop("_error")
        new = failed.join(pages.select("pageid"), "pageid", "left_anti").withColumn("status", F.lit("error")).withColumn("in_scope", F.lit(1))
        files.replace(known.unionByName(new, allowMissingColumns=True).select(*pages.columns), place("pages"))
    tables = files.open_store(spark, folder)
    files.replace(store.synced_scope(tables["pages"], listed), place("pages"))
    if redirects:
        try:
            found = cut(mediawiki.read_wiki(spark, api, "redirects", **options), "redirects")
        except Exception:  # the listing failed: the former redirects stay
            found = None
        counts["redirects_complete"] = int(found is not None)
        if found is not None:
            found = found.select("source_title", "target_title", X.page_url(F.lit(base), F.col("source_title")).alias("source_url"), F.lit(None).cast("string").alias("status"), F.current_timestamp().cast("timestamp_ntz").alias("fetched_at"))
        new = store.replaced_redirects(tables["redirects"], found, targets, most="max_redirects" in options)
        files.replace(new.select(*tables["redirects"].columns), place("redirects"))
    meta = spark.createDataFrame([(k, str(v)) for k, v in counts.items()], "meta_key string, meta_value string")
    files.replace(store.metadata_upsert(tables["crawl_meta"], meta), place("crawl_meta"))
    return counts
