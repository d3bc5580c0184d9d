"""Lookup words of dictionary entries.

Candidates come from titles, definitions, sidebars, categories and redirects, each with its place in generation
order. Unusable ones are omitted with the first reason that holds; the rest meet the canonical titles and each
other: a word for one entry is accepted, a word that several may share becomes a lookup of several targets, and a
word that not all may share is omitted. All of it is one plan of expressions, joins on folded words and
aggregations; first-wins order is an explicit sequence, never row order.

Input: entries (pos, title, definition, details, source_categories, redirect_aliases). Exact duplicates of a pos
count once. Null arrays and null definitions give no candidates; entries without a title are left out; extra
columns are ignored; of titles that fold alike the last is the canonical one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.keys import collapse, collapse_of, fold, unescape_of
from ..functions.markup import bold_phrases, plain_inline, sanitize_inline
from ..plans.config import LookupRules
from .index import ranked, ranked_within

# Words and categories that lookup words are made from or kept from.
CHARACTERS = "characters"
PLURAL_CATEGORIES = ("groups", "items", "mob_types", "races")
PLURAL_ITEM_WORDS = tuple("Badge Bandage Beanie Biscuit Bolt Box Card Chest Chip Cloak Condom Guide Grenade Kit Pass Patch Pen Potion Scroll Sigil Tab Table Tattoo Ticket Workshop".split())
PLURAL_GROUP_WORDS = tuple("Army Club Company Corporation Court Empire Front Guild Militia Sultanate Syndicate".split())
PLURAL_SKIP_WORDS = tuple("Blue Chee Controls Daughters Experience Limited Male Series".split())
IRREGULAR_PLURALS = {"Dwarf": ("Dwarfs", "Dwarves"), "Elf": ("Elves",)}
GENERIC_WORDS = tuple("achievement box captain class club commander company corporation doctor duke duchess group item king lady lord militia potion prince princess queen race scroll spell system".split())
STOP_WORDS = tuple("a about all an and are as at be been being by can did do does for from have how i in into is it it's its just my not of on or out that the then these this those to was what when where who why with you your".split())
FIRST_NAME_SKIPS = tuple("A An Captain Commander Count Crown Doctor Dr Duchess Duke King Lady Lord Prince Princess Queen Ser Sir The".split())
KNOWN_RULES = {" Spell": "title-suffix-spell", " Box": "title-suffix-box", " Achievement": "title-suffix-achievement", " Potion": "title-suffix-potion", " Scroll": "title-suffix-scroll", "Potion of ": "title-prefix-potion-of", "Scroll of ": "title-prefix-scroll-of", "Ring of ": "title-prefix-ring-of", "Wand of ": "title-prefix-wand-of"}
SHARED_SOURCES = ("category-plural", "character-first-name", "character-possessive", "bold-intro", "description-leading-article", "description-parenthetical", "wiki-redirect")

_PAREN = re.compile(r"\(([^)]{1,160})\)")
_SAID = (re.compile(r"\s*(?:or|aka)\s+(.+?)\s*$", re.I), re.compile(r'\s*actually named\s+["“]([^"”]+)["”]', re.I), re.compile(r'\s*shortened to\s+["“]([^"”]+)["”]', re.I))


def _facts_of(title: str | None, definition: str | None) -> dict:
    """What a definition says about an entry's names."""
    safe = sanitize_inline(definition)
    plain, bold = plain_inline(safe), bold_phrases(safe)
    end = re.search(r"(?<=[.!?])\s+", plain)
    said = []
    for inside in _PAREN.findall(plain[: end.start() + 1] if end else plain[:500]):
        found = next((m[1] for p in _SAID if (m := p.match(inside))), None)
        if found is not None:
            name = collapse_of((unescape_of(found) or "").strip().strip("'\"“”")) or ""
            name = next((b for b in bold if b.casefold() in name.casefold()), name)
            if name:
                said.append(name)
    leads = bool(bold) and bold[0].casefold() == (title or "").casefold()
    article = re.match(rf"(The|A|An)\s+{re.escape(title or '')}\b", plain, re.I) if leads else None
    return {"plain": plain, "said": said, "bold": bold[0] if bold and not leads else None, "led": collapse_of(f"{article[1]} {title}") if article else None}


_FACTS = pa.struct([("plain", pa.string()), ("said", pa.list_(pa.string())), ("bold", pa.string()), ("led", pa.string())])


def _facts(titles: pa.Array, definitions: pa.Array) -> pa.Array:
    return pa.array([_facts_of(t, d) for t, d in zip(titles.to_pylist(), definitions.to_pylist())], _FACTS)


_facts_udf = F.arrow_udf(_facts, T.StructType([T.StructField("plain", T.StringType()), T.StructField("said", T.ArrayType(T.StringType())), T.StructField("bold", T.StringType()), T.StructField("led", T.StringType())]))


def _one(alias: Column, source: str, when: Column | None = None) -> Column:
    """An array of at most one candidate."""
    kept = alias.isNotNull() & (alias != "")
    kept = kept if when is None else kept & F.coalesce(when, F.lit(False))
    item = F.struct(alias.alias("alias"), F.lit(source).alias("source"))
    return F.when(kept, F.array(item)).otherwise(F.array().cast("array<struct<alias:string,source:string>>"))


def _many(aliases: Column, source: str) -> Column:
    return F.transform(F.coalesce(aliases, F.array().cast("array<string>")), lambda a: F.struct(a.alias("alias"), F.lit(source).alias("source")))


def categories_of(column: str = "source_categories") -> Column:
    """Category names in lower case without their prefix."""
    return F.filter(F.transform(F.coalesce(F.col(column), F.array().cast("array<string>")), lambda c: F.regexp_replace(F.lower(F.trim(c)), "^category:", "")), lambda c: c.isNotNull() & (c != ""))


def title_candidates(title: Column, rules: LookupRules) -> Column:
    parts = [_one(F.trim(F.regexp_replace(title, re.escape(s).replace(r"\ ", " ") + "$", "")), KNOWN_RULES.get(s, "title-suffix-custom"), title.endswith(s)) for s in rules.suffixes]
    parts += [_one(F.trim(F.regexp_replace(title, "^" + re.escape(p).replace(r"\ ", " "), "")), KNOWN_RULES.get(p, "title-prefix-custom"), title.startswith(p)) for p in rules.prefixes]
    if rules.strip_parenthetical:
        parts.append(_one(X.without_parenthetical(title), "title-parenthetical"))
    return F.concat(*parts) if parts else F.array().cast("array<struct<alias:string,source:string>>")


def sidebar_candidates(details: Column, labels: tuple[str, ...]) -> Column:
    """Each alias of the flagged fields, then the alias without its article where that differs."""
    values = F.filter(F.coalesce(details, F.array().cast("array<struct<label:string,value:string>>")), lambda d: d.label.isin(*labels) & d.value.isNotNull())
    split = F.flatten(F.transform(values, lambda d: F.split(F.regexp_replace(F.translate(d.value, ";|", ",,"), r"(?iU)\s+or\s+", ","), ",")))
    names = F.filter(F.transform(split, lambda a: X.squeezed(a)), lambda a: a != "")
    pair = lambda a: F.when(X.without_article(a) != a, F.array(F.struct(a.alias("alias"), F.lit("sidebar").alias("source")), F.struct(X.without_article(a).alias("alias"), F.lit("sidebar-leading-article").alias("source")))).otherwise(F.array(F.struct(a.alias("alias"), F.lit("sidebar").alias("source"))))
    return F.flatten(F.transform(names, pair))


def first_name(title: Column) -> Column:
    """First name of a title of two name words, else null."""
    words = F.split(title, " ")
    a, b = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    name = r"^\p{Lu}[\p{L}'-]+$"
    return F.when((F.size(words) == 2) & ~a.isin(*FIRST_NAME_SKIPS) & a.rlike(name) & b.rlike(name), a)


def possessives(base: Column) -> Column:
    forms = F.array(F.concat(base, F.lit("'s")), F.concat(base, F.lit("’s")))
    more = F.when(base.rlike("[sS]$"), F.array(F.concat(base, F.lit("'")), F.concat(base, F.lit("’")))).otherwise(F.array().cast("array<string>"))
    return F.when(base.isNotNull() & (base != ""), F.concat(forms, more)).otherwise(F.array().cast("array<string>"))


def final_word(title: Column) -> Column:
    """The last word of a title if it may be put in the plural, else null."""
    last = F.regexp_replace(F.element_at(F.split(title, " "), -1), r"^['\"]+|['\"]+$", "")
    fits = ~title.rlike(r"[(),:]") & last.rlike(r"^[A-Z][A-Za-z'-]*$") & ~last.isin(*PLURAL_SKIP_WORDS) & ~last.endswith("ii") & ~last.rlike("[sS]$")
    return F.when(fits, last)


def plurals(title: Column) -> Column:
    last = final_word(title)
    stem = F.substring(title, F.lit(1), F.length(title) - F.length(last))
    forms = F.array(X.plural(last))
    for word, irregular in IRREGULAR_PLURALS.items():
        forms = F.when(last == word, F.array(*[F.lit(x) for x in irregular])).otherwise(forms)
    return F.when(last.isNotNull() & title.endswith(last), F.transform(forms, lambda w: F.concat(stem, w))).otherwise(F.array().cast("array<string>"))


def plural_candidates(title: Column, categories: Column) -> Column:
    last = final_word(title)
    has = lambda c: F.array_contains(categories, c)
    fits = F.arrays_overlap(categories, F.array(*[F.lit(c) for c in PLURAL_CATEGORIES]))
    fits &= ~has("items") | last.isin(*PLURAL_ITEM_WORDS)
    fits &= has("items") | ~title.rlike(r"(?i)\bof\b")
    fits &= ~has("groups") | last.isin(*PLURAL_GROUP_WORDS)
    return _many(F.when(fits, plurals(title)), "category-plural")


def human_candidates(title: Column, details: Column) -> Column:
    words = F.split(title, " ")
    fits = (F.size(words) == 2) & F.forall(words, lambda w: w.rlike(r"^[A-Z][A-Za-z'-]{2,}$"))
    fits &= F.exists(F.coalesce(details, F.array().cast("array<struct<label:string,value:string>>")), lambda d: (d.label == "Race") & F.lower(d.value).contains("human"))
    return _many(F.when(fits, words), "human-name")


def once(entries: DataFrame) -> DataFrame:
    """Entries without exact duplicates of a pos."""
    return entries.where(F.col("title").isNotNull() & (F.col("title") != "")).dropDuplicates(["pos"])


def raw_candidates(entries: DataFrame, rules: LookupRules) -> DataFrame:
    """(pos, seq, target, alias, source) of the row-wise generators, in generation order."""
    e = once(entries).select("pos", "title", "definition", "details", "source_categories", "redirect_aliases").withColumn("f", _facts_udf("title", F.coalesce("definition", F.lit(""))))
    title, cats = F.col("title"), categories_of()
    character = F.array_contains(cats, CHARACTERS)
    first = F.when(character, first_name(title))
    owners = F.when(character, F.concat(possessives(title), possessives(first))).otherwise(F.array().cast("array<string>"))
    parts = [title_candidates(title, rules), _many(F.col("f.said"), "description-parenthetical"), _one(F.col("f.bold"), "bold-intro"), _one(F.col("f.led"), "description-leading-article")]
    if rules.sidebar_aliases:
        parts.append(sidebar_candidates(F.col("details"), rules.alias_labels))
    parts += [_one(first, "character-first-name"), _many(F.array_distinct(owners), "character-possessive"), plural_candidates(title, cats), _many(F.col("redirect_aliases"), "wiki-redirect")]
    if rules.human_names:
        parts.append(human_candidates(title, F.col("details")))
    return e.select("pos", F.col("title").alias("target"), F.posexplode(F.concat(*parts)).alias("seq", "c")).select("pos", "seq", "target", F.coalesce("c.alias", F.lit("")).alias("alias"), "c.source")


def unusable(alias: Column, source: Column) -> Column:
    """The first reason that an alias can't be a lookup word, or null."""
    return (
        F.when(alias == "", "empty").when(F.length(alias) < 2, "too-short").when(alias.rlike(r"\[\d+\]"), "citation-marker")
        .when(alias.rlike(r"[()]"), "parenthetical-note").when(alias.contains(":"), "not-a-name").when(alias.rlike("[\"“”]"), "quoted-noise")
        .when(~alias.rlike(r"^[\p{Lu}\p{Lt}\p{Nd}]"), "not-title-like").when(F.lower(alias).isin(*GENERIC_WORDS), "generic-word")
        .when(source.startswith("sidebar") & (F.length(alias) > 80), "suspiciously-long")
    )


def tokens_of(title: Column) -> Column:
    return F.regexp_extract_all(title, F.lit("[A-Za-z0-9][A-Za-z0-9'’-]*"), F.lit(0))


def component_candidates(entries: DataFrame, raw: DataFrame, rules: LookupRules) -> DataFrame:
    """(pos, seq, target, alias, source): one word of a title of one or two telling words, the one that fewer titles
    and lookup words have. Every word is counted over all entries before it is joined back."""
    titles = once(entries).select("pos", F.col("title").alias("target"))
    words = titles.select(F.explode(tokens_of(F.col("target"))).alias("w"), "target")
    normal = raw.select(collapse("alias").alias("w"), "target")
    words = words.unionByName(normal.where(unusable(F.col("w"), F.lit("")).isNull() & ~F.col("w").contains(" ")))
    counts = words.select(fold("w").alias("w"), "target").distinct().groupBy("w").agg(F.count("*").alias("n"))
    base = F.col("target")
    if rules.strip_parenthetical:
        base = F.coalesce(X.without_parenthetical(base), base)
    cut = base
    for p in reversed(rules.prefixes):
        cut = F.when(F.lower(base).startswith(p.lower()), F.trim(F.substring(base, F.lit(len(p) + 1), F.length(base)))).otherwise(cut)
    bare = cut
    for s in reversed(rules.suffixes):
        bare = F.when(F.lower(cut).endswith(s.lower()), F.trim(F.substring(cut, F.lit(1), F.length(cut) - len(s)))).otherwise(bare)
    ignored = sorted({w.casefold() for w in (*rules.ignore_words, *STOP_WORDS, *GENERIC_WORDS)})
    kept = F.filter(tokens_of(X.squeezed(bare)), lambda t: ~F.lower(t).isin(*ignored) & (F.length(t) >= 2) & ~t.rlike("['’]") & t.rlike("^[A-Z0-9]"))
    few = titles.select("pos", "target", kept.alias("k")).where(F.size("k").between(1, 2))
    each = few.select("pos", "target", F.posexplode("k").alias("i", "alias")).withColumn("w", F.lower("alias"))
    best = each.join(counts, "w", "left").groupBy("pos", "target").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "i", "alias")).alias("b"))
    # after all other generators of all entries
    return best.select((F.col("pos") + F.lit(1 << 62)).alias("pos"), F.lit(0).alias("seq"), "target", F.col("b.alias").alias("alias"), F.lit("title-component").alias("source"))


@dataclass(frozen=True)
class Lookups:
    """accepted (target, alias, source, at), unordered (word, own, target, shown, rank), shared (word, ord, target), omitted (alias, target, source, reason)."""

    accepted: DataFrame
    unordered: DataFrame
    omitted: DataFrame

    @cached_property
    def shared(self) -> DataFrame:
        """Ordering writes a table, so only who asks for it pays."""
        return ranked_within(self.unordered, "word", [F.col("rank"), F.col("own")], "ord").select(F.col("shown").alias("word"), "ord", "target")


def candidates(entries: DataFrame, rules: LookupRules) -> DataFrame:
    """All candidates with ``at`` (their place), folded words and titles, and why they are omitted, if so by themselves."""
    raw = raw_candidates(entries, rules)
    if rules.ignore_words:
        raw = raw.unionByName(component_candidates(entries, raw, rules))
    c = raw.select(F.struct("pos", "seq").alias("at"), "target", collapse("alias").alias("alias"), "source")
    c = c.select("*", fold("alias").alias("word"), fold("target").alias("own"))
    return c.withColumn("reason", F.coalesce(unusable(F.col("alias"), F.col("source")), F.when(F.col("word") == F.col("own"), "self-alias")))


def canonical_titles(entries: DataFrame) -> DataFrame:
    """(word, title): for each folded title its last spelling."""
    t = once(entries).select("pos", "title", fold("title").alias("word"))
    return t.groupBy("word").agg(F.max_by("title", "pos").alias("title"))


def lookups(entries: DataFrame, rules: LookupRules = LookupRules()) -> Lookups:
    from ..plans.lineage import cut

    found = cut(candidates(entries, rules), "candidates")
    left = found.where("reason IS NULL").join(canonical_titles(entries), "word", "left")
    clash = left.where("title IS NOT NULL AND title <> target")
    free = left.where("title IS NULL OR title = target")
    first = free.groupBy("target", "word").agg(F.min_by(F.struct("alias", "source", "at", "own"), "at").alias("c")).select("target", "word", "c.*")
    shareable = F.col("source").startswith("title-") | F.col("source").isin(*SHARED_SOURCES)
    groups = cut(first.groupBy("word").agg(F.count("*").alias("n"), F.bool_and(shareable).alias("shared"), F.min_by("alias", "at").alias("shown")), "words")
    each = first.join(groups, "word")
    accepted = each.where("n = 1").select("target", "alias", "source", "at")
    refused = each.where("n > 1 AND NOT shared").select("alias", "target", "source", F.lit("alias-collision").alias("reason"))
    omitted = found.where("reason IS NOT NULL").select("alias", "target", "source", "reason").unionByName(refused)
    # shared words: alone among aliases, ordered by folded title; with a canonical title, that one first
    alone = each.where("n > 1 AND shared").groupBy("word", "own").agg(F.max_by("target", "at").alias("target"), F.min("shown").alias("shown")).withColumn("rank", F.lit(1))
    heads = clash.groupBy("word").agg(F.min_by("alias", "at").alias("shown"), F.min("title").alias("title"))
    tails = clash.groupBy("word", "own").agg(F.max_by("target", "at").alias("target")).where("own <> word").join(heads.select("word", "shown"), "word").withColumn("rank", F.lit(1))
    tops = heads.select("word", F.col("word").alias("own"), F.col("title").alias("target"), "shown", F.lit(0).alias("rank"))
    rows = reduce(DataFrame.unionByName, [x.select("word", "own", "target", "shown", "rank") for x in (alone, tails, tops)])
    return Lookups(accepted, rows, omitted)


def alias_forms(entries: DataFrame, found: Lookups) -> DataFrame:
    """(target, ord, form): each title, then its accepted words in order, without what folds alike."""
    words = found.accepted.select("target", "at", F.col("alias").alias("form"))
    t = once(entries).select(F.col("title").alias("target"), F.lit(None).cast("struct<pos:bigint,seq:int>").alias("at"), F.col("title").alias("form")).distinct()
    rows = t.unionByName(words).withColumn("folded", fold("form"))
    first = F.struct(F.lit(-1).cast("bigint").alias("pos"), F.lit(-1).alias("seq"))
    rows = rows.withColumn("at", F.coalesce("at", first)).groupBy("target", "folded").agg(F.min_by("form", "at").alias("form"), F.min("at").alias("at"))
    return ranked_within(rows, "target", [F.col("at.pos"), F.col("at.seq")], "ord").select("target", (F.col("ord") - 1).cast("int").alias("ord"), "form")


def counts(entries: DataFrame, found: Lookups) -> DataFrame:
    """One row: entries, accepted aliases, shared words, omissions."""
    names = ("n_entries", "n_accepted", "n_shared", "n_omitted")
    parts = (once(entries), found.accepted, found.shared.where("ord = 1"), found.omitted)
    each = [p.agg(*[F.count("*").alias(x) if x == name else F.lit(0).cast("bigint").alias(x) for x in names]) for name, p in zip(names, parts)]
    return reduce(DataFrame.unionByName, each).agg(*[F.sum(x).alias(x) for x in names])


def format_health(entries: DataFrame, found: Lookups) -> DataFrame:
    """(format, n_entries, n_records): records that each dictionary format shows."""
    e = once(entries)
    words = found.shared.groupBy("word").agg(F.count("*").alias("n")).withColumn("w", fold("word"))
    titles = e.select(fold("title").alias("w")).distinct().withColumn("is_title", F.lit(True))
    j = words.join(titles, "w", "left")
    more = j.agg(F.coalesce(F.sum(F.when(F.col("is_title"), F.col("n") - 1).otherwise(F.col("n"))), F.lit(0)).alias("more"), F.count_if(F.col("is_title").isNull()).alias("extra"), F.lit(0).cast("bigint").alias("n_entries"))
    all_ = e.agg(F.lit(0).cast("bigint").alias("more"), F.lit(0).cast("bigint").alias("extra"), F.count("*").alias("n_entries"))
    both = more.unionByName(all_).agg(*[F.sum(c).alias(c) for c in ("more", "extra", "n_entries")])
    rows = F.explode(F.array(F.struct(F.lit("Kindle").alias("format"), (F.col("n_entries") + F.col("more")).alias("n_records")), *[F.struct(F.lit(f).alias("format"), (F.col("n_entries") + F.col("extra")).alias("n_records")) for f in ("StarDict", "Kobo")]))
    return both.select("n_entries", rows.alias("r")).select("r.format", "n_entries", "r.n_records")


def term_statuses(terms: DataFrame, entries: DataFrame, found: Lookups) -> DataFrame:
    """(term, status, shown, targets) of expected words: shared before canonical before alias before missing."""
    t = terms.select("term", fold("term").alias("w")).distinct()
    shared = found.shared.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("ord", "target"))).alias("x")).select(fold("word").alias("w"), F.col("word").alias("s_word"), F.concat_ws("|", F.transform("x", lambda y: y.target)).alias("s_targets"))
    titles = canonical_titles(entries).select(F.col("word").alias("w"), F.col("title").alias("c_title"))
    forms = alias_forms(entries, found).where("ord > 0").select(fold("form").alias("w"), F.struct("target", "ord").alias("k"), "form", "target")
    alias = forms.groupBy("w").agg(F.max_by("form", "k").alias("a_form"), F.max_by("target", "k").alias("a_target"))
    j = t.join(shared, "w", "left").join(titles, "w", "left").join(alias, "w", "left")
    status = F.when(F.col("s_word").isNotNull(), "multi-target").when(F.col("c_title").isNotNull(), "canonical").when(F.col("a_form").isNotNull(), "alias").otherwise("missing")
    return j.select("term", status.alias("status"), F.coalesce("s_word", "c_title", "a_form", "term").alias("shown"), F.coalesce("s_targets", "c_title", "a_target", F.lit("")).alias("targets"))


def quality_findings(found: Lookups) -> DataFrame:
    """(kind, alias, targets): accepted words that are long or look joined, and words of more than eight targets."""
    a = found.accepted
    kind = F.when(F.length("alias") > 60, "long-accepted-alias").when(F.col("source").startswith("sidebar") & ~F.col("alias").contains(" ") & (F.length("alias") > 10) & F.col("alias").rlike("[a-z][A-Z]"), "possibly-joined-sidebar-alias")
    one = a.select(kind.alias("kind"), "alias", F.col("target").alias("targets")).where("kind IS NOT NULL")
    broad = found.shared.groupBy("word").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("ord", "target"))).alias("x")).where("n > 8")
    return one.unionByName(broad.select(F.lit("broad-multi-target-lookup").alias("kind"), F.col("word").alias("alias"), F.concat_ws("|", F.transform("x", lambda y: y.target)).alias("targets")))


def single_aliases(found: Lookups, ignore: tuple[str, ...] = ()) -> DataFrame:
    """(target, ord, alias): the accepted words of each entry in order, from 1."""
    a = found.accepted.where(~F.col("source").isin(*ignore)) if ignore else found.accepted
    return ranked_within(a, "target", [F.col("at.pos"), F.col("at.seq")], "ord").select("target", "ord", "alias")


def ordered_lines(found: Lookups) -> DataFrame:
    """``debug_lines`` with their place from 1: without regard to case, equal ones by their own letters."""
    return ranked(debug_lines(found).withColumn("folded", fold("line")), [F.col("folded"), F.col("line")], "ord").select("ord", "line")


def first_lines(lines: DataFrame, order: list[Column], kind: str, most: int, level: str) -> DataFrame:
    """(level, kind, ord, line): the first ``most`` of ``lines`` and, after them, how many more there are."""
    top = lines.orderBy(*order).limit(most)
    shown = top.select(F.row_number().over(Window.orderBy(*order)).alias("ord"), "line")  # no more than ``most`` rows
    rest = lines.agg(F.count("*").alias("n")).where(F.col("n") > most).select(F.lit(most + 1).alias("ord"), F.format_string("... %d more", F.col("n") - most).alias("line"))
    return shown.unionByName(rest).select(F.lit(level).alias("level"), F.lit(kind).alias("kind"), "ord", "line")


def health_lines(entries: DataFrame, found: Lookups, most: int = 25) -> DataFrame:
    """(level, kind, ord, line) of a health report: records of each format, counts, and the first findings of each kind."""
    from . import checks

    formats = format_health(entries, found).select(F.format_string("%s: entries=%d, lookup records=%d", "format", "n_entries", "n_records").alias("line"))
    n = counts(entries, found)
    totals = n.select(F.explode(F.array(*[F.format_string(f"{label}: %d", c).alias("line") for label, c in (("canonical entries", "n_entries"), ("single-target aliases", "n_accepted"), ("multi-target lookups", "n_shared"), ("omitted aliases", "n_omitted"))])).alias("line"))
    audit = checks.audit(entries).select(F.concat_ws(": ", "kind", "title", "detail").alias("line"))
    quality = quality_findings(found).select(F.concat_ws(": ", "kind", "alias", "targets").alias("line"))
    line = [fold(F.col("line")), F.col("line")]
    parts = [first_lines(totals, line, "counts", 10, "info"), first_lines(formats, line, "formats", 10, "info"), first_lines(audit, line, "audit", most, "warning"), first_lines(quality, line, "alias quality", most, "warning")]
    return reduce(DataFrame.unionByName, parts)


def debug_lines(found: Lookups) -> DataFrame:
    """(line) of every decision about lookup words."""
    a = found.accepted.select(F.format_string('alias: alias="%s" main="%s" source=%s', "alias", "target", "source").alias("line"))
    o = found.omitted.select(F.format_string('omitted alias: alias="%s" main="%s" source=%s reason=%s', "alias", "target", "source", "reason").alias("line"))
    m = found.shared.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("ord", "target"))).alias("x"))
    m = m.select(F.format_string('multi-target lookup: lookup="%s" targets=%s', "word", F.array_join(F.transform("x", lambda y: F.concat(F.lit('"'), y.target, F.lit('"'))), " | ")).alias("line"))
    return a.unionByName(o).unionByName(m)
