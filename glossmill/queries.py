"""Queries of the core by name, and DuckDB SQL for those that SQL can express on whole tables.

Texts that are compared with SQL are brought to plain text by expressions alone (``bare``), since SQL has no
compatibility normalisation; the dictionary's own build uses the exact parser instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import markup
from .functions import text as X
from .operators import checks, entries, index, links, lookup, orphans, store, summaries
from .plans.config import LookupRules
from .plans.lineage import cut
from .sources import dictionaries
from .sources.tables import host_of, table

Query = Callable[[SparkSession, str], DataFrame]

RULES = LookupRules(ignore_words=("Achievement", "Box", "Company", "Golem", "Guild", "Item", "Kin", "Potion", "Ring", "Spell", "Swarm"))
CATEGORIES = ("Characters", "Groups", "Spells", "Achievements")
TERMS = ("Carl", "Golem", "1000 Minor Delvers", "Babex", "Ring of Zeme Libram", "Bagrorn-Drebol")


def _orphan_tables(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [table(spark, folder, t) for t in ("pages", "list_pages", "redirects", "entries", "deletions")]


def bare(fragment: Column) -> Column:
    """A fragment without tags, with the five XML references decoded and white space squeezed."""
    t = F.regexp_replace(F.coalesce(fragment, F.lit("")), r"</?[A-Za-z][^<>]*>", "")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return X.squeezed(t)


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    """Entries once each, with ``plain``."""
    return lookup.once(table(spark, folder, "entries")).withColumn("plain", bare(F.col("definition")))


def _lookups(spark: SparkSession, folder: str) -> tuple[DataFrame, lookup.Lookups]:
    e = table(spark, folder, "entries")
    return e, lookup.lookups(e, RULES)


def _alias_rows(make: Callable[[], Column]) -> Query:
    """(title, source, alias) of one row-wise generator."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        e = lookup.once(table(spark, folder, "entries"))
        return e.select("title", F.explode(make()).alias("c")).select("title", "c.source", "c.alias")

    return run


def _plural_rows() -> Column:
    return lookup.plural_candidates(F.col("title"), lookup.categories_of())


def _title_rows() -> Column:
    return lookup.title_candidates(F.col("title"), LookupRules())


def _sidebar_rows() -> Column:
    return lookup.sidebar_candidates(F.col("details"), ("Aliases",))


def _human_rows() -> Column:
    return lookup.human_candidates(F.col("title"), F.col("details"))


def _possessive_rows() -> Column:
    first = lookup.first_name(F.col("title"))
    forms = F.array_distinct(F.concat(lookup.possessives(F.col("title")), lookup.possessives(first)))
    return F.when(F.array_contains(lookup.categories_of(), lookup.CHARACTERS), F.transform(forms, lambda a: F.struct(a.alias("alias"), F.lit("character-possessive").alias("source"))))


def entries_scan(s: SparkSession, d: str) -> DataFrame:
    return entries.usable_pages(table(s, d, "pages")).select("title", "url", "first_paragraph", "source_category")


def artifacts(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pages").where("first_paragraph IS NOT NULL").select("pageid", F.concat("first_paragraph", F.element_at(F.array(*[F.lit(x) for x in (" [1] , and", " isa god of .", " Official art by X Y", " For more information: Z")]), F.pmod("pageid", F.lit(4)).cast("int") + 1)).alias("t")).distinct()
    return p.select("pageid", X.without_artifacts(F.col("t")).alias("cleaned"))


def text_forms(s: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return table(s, d, "documents").select("doc_id", X.snippet(t).alias("snippet"), X.slug(F.coalesce("about_title", F.lit(""))).alias("slug"), X.trails_off(X.squeezed(t)).alias("trails_off"))


def first_sentences(s: SparkSession, d: str) -> DataFrame:
    return _entries(s, d).select("pos", X.first_sentence(F.col("plain")).alias("sentence"))


def parentheticals(s: SparkSession, d: str) -> DataFrame:
    e = lookup.once(table(s, d, "entries"))
    m = entries.munged_titles(e)
    return e.select("pos", "title", X.without_parenthetical(F.col("title")).alias("bare")).join(m.select("pos", F.col("title").alias("munged")), "pos")


def forwards(s: SparkSession, d: str) -> DataFrame:
    return _entries(s, d).select("pos", X.forward_target(F.col("plain")).alias("target")).where("target IS NOT NULL")


def forwards_resolved(s: SparkSession, d: str) -> DataFrame:
    return entries.forwarding(_entries(s, d))


def assembled(s: SparkSession, d: str) -> DataFrame:
    e = entries.assembled(table(s, d, "pages"), table(s, d, "redirects"), most=600)
    return e.select("title", "url", "definition", "spoiler_notice", F.size("details").alias("n_details"), F.array_join("source_categories", "|").alias("categories"), F.array_join("redirect_aliases", "|").alias("aliases"))


def out_of_scope(s: SparkSession, d: str) -> DataFrame:
    return entries.out_of_scope(lookup.once(table(s, d, "entries")), CATEGORIES).select("pos", "title")


def lookup_accepted(s: SparkSession, d: str) -> DataFrame:
    return _lookups(s, d)[1].accepted.select("target", "alias", "source")


def lookup_shared(s: SparkSession, d: str) -> DataFrame:
    return _lookups(s, d)[1].shared


def lookup_omitted(s: SparkSession, d: str) -> DataFrame:
    return _lookups(s, d)[1].omitted


def lookup_forms(s: SparkSession, d: str) -> DataFrame:
    return lookup.alias_forms(*_lookups(s, d))


def lookup_counts(s: SparkSession, d: str) -> DataFrame:
    return lookup.counts(*_lookups(s, d))


def format_health(s: SparkSession, d: str) -> DataFrame:
    return lookup.format_health(*_lookups(s, d))


def alias_quality(s: SparkSession, d: str) -> DataFrame:
    return lookup.quality_findings(_lookups(s, d)[1])


def term_status(s: SparkSession, d: str) -> DataFrame:
    return lookup.term_statuses(s.createDataFrame([(t,) for t in TERMS], "term string"), *_lookups(s, d))


def lookup_lines(s: SparkSession, d: str) -> DataFrame:
    return lookup.debug_lines(_lookups(s, d)[1])


def usability(s: SparkSession, d: str) -> DataFrame:
    e = lookup.once(table(s, d, "entries")).select("pos", F.explode("redirect_aliases").alias("alias")).where("alias IS NOT NULL")
    return e.select("pos", "alias", lookup.unusable(F.col("alias"), F.lit("wiki-redirect")).alias("reason"))


def page_latest(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pages").select("pageid", "title", "url", "source_category", "status", "in_scope", "fetched_at")
    return store.upsert(p, p)


def known_good(s: SparkSession, d: str) -> DataFrame:
    return store.last_known_good(table(s, d, "pages")).select("pageid", "title", "status", "error", "last_attempt_error", "fetched_at")


def scope_synced(s: SparkSession, d: str) -> DataFrame:
    p = store.upsert(table(s, d, "pages").limit(0), table(s, d, "pages"))
    listing = table(s, d, "entries").select("title", F.posexplode("source_categories").alias("seq", "category"))
    listing = listing.join(p.select("title", "pageid"), "title").select("pageid", "category", "seq")
    return store.synced_scope(p, store.listed_categories(listing)).select("pageid", "in_scope", "source_category")


def resume(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pages")
    return store.still_to_fetch(p.select("pageid", "title").distinct(), p)


def redirect_statuses(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "redirects").select("source_title", "target_title", "source_url", "status", "fetched_at")
    return store.classified_redirects(r, table(s, d, "pages").select("title")).groupBy("status").agg(F.count("*").alias("n"))


def crawl_counts(s: SparkSession, d: str) -> DataFrame:
    return store.crawl_counts(table(s, d, "pages"))


def listing_categories(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pages").where("source_category IS NOT NULL").select("pageid", F.posexplode(F.split("source_category", ", ")).alias("seq", "category"))
    return store.listed_categories(p)


def pages_per_category(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pages").where("source_category IS NOT NULL").select("pageid", F.explode(F.split("source_category", ", ")).alias("category")).distinct()
    return store.capped(p, "category", "pageid", 25)


def title_chunks(s: SparkSession, d: str) -> DataFrame:
    return store.chunks(table(s, d, "redirects"), "source_title", 50)


def metadata(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "crawl_meta")
    return store.metadata_upsert(m, m.select("meta_key", F.upper("meta_value").alias("meta_value")).where("meta_value IS NOT NULL"))


def audit_findings(s: SparkSession, d: str) -> DataFrame:
    return checks.audit(_entries(s, d))


def audit_counts(s: SparkSession, d: str) -> DataFrame:
    return checks.audit_counts(_entries(s, d))


def audit_severity(s: SparkSession, d: str) -> DataFrame:
    return checks.audit_severity(_entries(s, d))


def cleanup(s: SparkSession, d: str) -> DataFrame:
    return checks.cleanup(_entries(s, d))


def title_collisions(s: SparkSession, d: str) -> DataFrame:
    return checks.title_collisions(table(s, d, "redirects").select(F.col("source_title").alias("title")).where("title IS NOT NULL"))


def index_rows(s: SparkSession, d: str) -> DataFrame:
    e = _entries(s, d).where("definition IS NOT NULL").groupBy("title").agg(F.max("definition").alias("definition"))
    return index.index_rows(e, "title")


def index_synonyms(s: SparkSession, d: str) -> DataFrame:
    forms = lookup_forms(s, d)
    e = _entries(s, d).groupBy("title").agg(F.max(F.coalesce("definition", F.lit(""))).alias("definition"))
    return index.synonym_rows(forms, index.index_rows(e, "title"))


def index_violations(s: SparkSession, d: str) -> DataFrame:
    forms = cut(lookup_forms(s, d), "forms")
    e = _entries(s, d).groupBy("title").agg(F.max(F.coalesce("definition", F.lit(""))).alias("definition"))
    rows = cut(index.index_rows(e, "title"), "index")
    size = rows.agg(F.sum("size")).first()[0] or 0
    return index.index_violations(rows, index.synonym_rows(forms, rows), size)


def alias_lists(s: SparkSession, d: str) -> DataFrame:
    return lookup.single_aliases(_lookups(s, d)[1])


def duplicate_records(s: SparkSession, d: str) -> DataFrame:
    e, found = _lookups(s, d)
    e = lookup.once(e)
    return dictionaries.kindle_duplicates(e.withColumn("rank", F.col("pos")), found.shared, "Delver Wiki").select("rank", "word", "ord")


def lookup_order(s: SparkSession, d: str) -> DataFrame:
    return lookup.ordered_lines(_lookups(s, d)[1])


def health_lines(s: SparkSession, d: str) -> DataFrame:
    e, found = _lookups(s, d)
    return lookup.health_lines(_entries(s, d), found)


def ranks(s: SparkSession, d: str) -> DataFrame:
    return entries.ordered(lookup.once(table(s, d, "entries")).select("pos", "title"))


def sections(s: SparkSession, d: str) -> DataFrame:
    return index.sections(ranks(s, d))


def shards(s: SparkSession, d: str) -> DataFrame:
    e = lookup.once(table(s, d, "entries"))
    forms = e.select(F.col("title").alias("target"), F.col("title").alias("form")).unionByName(e.select(F.col("title").alias("target"), F.explode("redirect_aliases").alias("form")))
    return index.shards(forms.where("form IS NOT NULL"))


def headwords(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", index.valid_headword(F.coalesce("text", F.lit(""))).alias("valid"))


def definitions(s: SparkSession, d: str) -> DataFrame:
    return lookup.once(table(s, d, "entries")).select("pos", index.rendered("Delver Wiki").alias("html"))


def combined(s: SparkSession, d: str) -> DataFrame:
    e, found = _lookups(s, d)
    html = lookup.once(e).select("title", index.rendered("Delver Wiki").alias("html"))
    return index.combined(found.shared, html)


def title_mentions(s: SparkSession, d: str) -> DataFrame:
    return links.mentions(_entries(s, d))


def linked_definitions(s: SparkSession, d: str) -> DataFrame:
    return links.linked(_entries(s, d).withColumn("definition", markup.sanitized("definition")))


def tag_inventory(s: SparkSession, d: str) -> DataFrame:
    return index.tag_inventory(table(s, d, "pages").select("pageid", "raw_html").distinct(), "raw_html")


def page_summaries(s: SparkSession, d: str) -> DataFrame:
    # whole documents are stored here; a summary is made from the body
    p = table(s, d, "pages").withColumn("raw_html", F.regexp_replace("raw_html", r"(?is)<head\b.*?</head\s*>", ""))
    return summaries.reextracted(p, 600)


def page_details(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pages").where("raw_html IS NOT NULL").select("pageid", "raw_html").distinct()
    return p.select("pageid", F.explode(markup.details("raw_html")).alias("x")).select("pageid", "x.label", "x.value")


def hosts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").groupBy(host_of(F.col("url")).alias("host")).agg(F.count("*").alias("n_rows"), F.countDistinct("pageid").alias("n_pages"))


def digests(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text IS NOT NULL").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


def page_json(s: SparkSession, d: str) -> DataFrame:
    j = table(s, d, "pages").where("raw_json IS NOT NULL").select("pageid", "raw_json").distinct()
    v = F.try_parse_json("raw_json")
    return j.select("pageid", F.try_variant_get(v, "$.parse.revid", "bigint").alias("revid"), F.try_variant_get(v, "$.parse.title", "string").alias("title"))


def page_urls(s: SparkSession, d: str) -> DataFrame:
    e = lookup.once(table(s, d, "entries"))
    return e.select("pos", X.page_url(F.regexp_extract("url", r"^(https?://[^/]+)", 1), F.col("title")).alias("made"), "url")


def badges(s: SparkSession, d: str) -> DataFrame:
    """Number of usable entries per category as badges."""
    e = lookup.once(table(s, d, "entries")).select(F.explode("source_categories").alias("category"), "pos").distinct()
    n = e.where("category IS NOT NULL").groupBy("category").agg(F.count("*").alias("n"))
    colour = X.band_colour(F.col("n"), ((1000, "brightgreen"), (500, "green"), (1, "yellow")), "red")
    return n.select("category", X.badge(F.col("category"), F.format_number("n", 0), colour).alias("badge"))


def inflections(s: SparkSession, d: str) -> DataFrame:
    e = lookup.once(table(s, d, "entries"))
    return e.select("pos", F.explode(X.extra_inflections(F.col("title"))).alias("form"))


def lookup_words(s: SparkSession, d: str) -> DataFrame:
    """(word, ord, target): titles and redirect names as words with all their entries, exact titles first."""
    e = lookup.once(table(s, d, "entries"))
    w = e.select("pos", F.col("title").alias("word"), F.col("title").alias("target"), F.lit(0).alias("rank")).unionByName(e.select("pos", F.explode("redirect_aliases").alias("word"), F.col("title").alias("target"), F.lit(1).alias("rank")))
    w = w.where("word IS NOT NULL AND word <> ''").withColumn("key", F.lower("word")).groupBy("key", "target").agg(F.min(F.struct("rank", "pos")).alias("k"), F.min_by("word", F.struct("rank", "pos", "word")).alias("word"))
    shown = w.groupBy("key").agg(F.min_by("word", F.struct("k", "word")).alias("shown"))
    order = Window.partitionBy("key").orderBy("k")
    return w.join(shown, "key").select(F.col("shown").alias("word"), F.row_number().over(order).alias("ord"), "target")


QUERIES: dict[str, Query] = {
    "p2_found": lambda s, d: orphans.orphans(*_orphan_tables(s, d)),
    "p2_report": lambda s, d: orphans.orphan_report(*_orphan_tables(s, d)),
    "title_aliases": _alias_rows(_title_rows),
    "plural_aliases": _alias_rows(_plural_rows),
    "sidebar_aliases": _alias_rows(_sidebar_rows),
    "human_aliases": _alias_rows(_human_rows),
    "possessive_aliases": _alias_rows(_possessive_rows),
} | {f.__name__: f for f in (
    entries_scan, artifacts, text_forms, first_sentences, parentheticals, forwards, forwards_resolved, assembled, out_of_scope,
    lookup_accepted, lookup_shared, lookup_omitted, lookup_forms, lookup_counts, format_health, alias_quality, term_status, lookup_lines, usability, alias_lists, duplicate_records, lookup_order, health_lines,
    page_latest, known_good, scope_synced, resume, redirect_statuses, crawl_counts, listing_categories, pages_per_category, title_chunks, metadata,
    audit_findings, audit_counts, audit_severity, cleanup, title_collisions,
    index_rows, index_synonyms, index_violations, ranks, sections, shards, headwords, definitions, combined,
    page_urls, badges, inflections, lookup_words, title_mentions, linked_definitions, tag_inventory, page_summaries, page_details, hosts, digests, page_json,
)}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return dict(SQL)
