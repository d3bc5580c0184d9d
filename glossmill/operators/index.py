"""Dictionary indexes: orders, ordinals, byte offsets, sections, shards, and checks of their integrity.

Global ranks and running sums are made in two steps, inside range partitions and then over the partitions' totals,
so that no task sorts or sums the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.keys import ascii_fold, fold
from ..plans.lineage import cut

LIMIT = 0xFFFFFFFF  # of 32-bit offsets


def _parted(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-partitioned by ``order`` with the partition's number in ``_part`` (cut, so that the numbers stay)."""
    named = df.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    by = [F.col(f"_o{i}") for i in range(len(order))]
    return cut(named.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "ranges")


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its rank from 1 under ``order`` (which must be total)."""
    p = _parted(df, order)
    sizes = p.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*[f"_o{i}" for i in range(len(order))]))
    return p.withColumn("_in", inside).join(F.broadcast(before), "_part").withColumn(name, F.col("_in") + F.col("_before")).select(*df.columns, name)


def ranked_within(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``df`` with its rank from 1 in its group under ``order``; a group may lie in any number of partitions."""
    by = [F.col(group), *order]
    p = _parted(df, by)
    sizes = p.groupBy("_part", F.col(group).alias("_group")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a group has no more rows here than there are partitions
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).where("_before > 0").select("_part", "_group", "_before")
    inside = F.row_number().over(Window.partitionBy("_part", group).orderBy(*[f"_o{i}" for i in range(1, len(by))]))
    j = p.withColumn("_in", inside).join(before, (p["_part"] == before["_part"]) & p[group].eqNullSafe(before["_group"]), "left")
    return j.withColumn(name, (F.col("_in") + F.coalesce("_before", F.lit(0))).cast("int")).select(*df.columns, name)


def running_before(df: DataFrame, order: list[Column], size: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``size`` over the rows before each under ``order``."""
    p = _parted(df.withColumn("_size", size), order)
    sums = p.groupBy("_part").agg(F.sum("_size").alias("_n"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = F.coalesce(F.sum("_size").over(Window.partitionBy("_part").orderBy(*[f"_o{i}" for i in range(len(order))]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return p.withColumn("_in", inside).join(F.broadcast(before), "_part").withColumn(name, F.col("_in") + F.col("_before")).select(*df.columns, name)


def index_order(word: Column) -> list[Column]:
    """Order of an index: ASCII-lower bytes, then bytes."""
    return [X.ascii_lower(word), word]


def valid_headword(word: Column) -> Column:
    """1 to 255 bytes without NUL and line ends."""
    return F.octet_length(word).between(1, 255) & ~word.rlike(r"[\x00\n\r]")


def index_rows(words: DataFrame, word: str = "word", definition: str = "definition") -> DataFrame:
    """(word, ordinal, offset, size) of an index with running byte offsets."""
    order = index_order(F.col("word"))
    p = _parted(words.select(F.col(word).alias("word"), F.octet_length(definition).alias("size")), order)
    totals = p.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("size").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_n", "_size")])  # a row for each partition
    inside = Window.partitionBy("_part").orderBy(*[f"_o{i}" for i in range(len(order))])
    sums = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    p = p.withColumn("_row", F.row_number().over(inside) - 1).withColumn("_bytes", sums).join(F.broadcast(before), "_part")
    return p.select("word", (F.col("_row") + F.col("_n")).alias("ordinal"), (F.col("_bytes") + F.col("_size")).alias("offset"), "size")


def synonym_rows(forms: DataFrame, index: DataFrame) -> DataFrame:
    """(word, ordinal) of each form that isn't its entry's title, with its entry's place in the index."""
    f = forms.where("form <> target").select(F.col("form").alias("alias"), F.col("target").alias("word"))
    return f.join(index.select("word", "ordinal"), "word").select(F.col("alias").alias("word"), "ordinal")


def index_violations(index: DataFrame, synonyms: DataFrame, blob_size: int) -> DataFrame:
    """(check, word): what breaks an index; must be empty."""
    from functools import reduce

    dup = lambda df, name: df.groupBy(fold("word").alias("w")).agg(F.count("*").alias("n"), F.min("word").alias("word")).where("n > 1").select(F.lit(name).alias("check"), "word")
    heads = index.select(fold("word").alias("w"))
    parts = [
        index.where(~valid_headword(F.col("word"))).select(F.lit("invalid headword").alias("check"), "word"),
        index.where((F.col("size") <= 0) | (F.col("offset") + F.col("size") > blob_size) | (F.col("offset") + F.col("size") > LIMIT)).select(F.lit("definition outside the data").alias("check"), "word"),
        dup(index, "headwords fold alike"),
        dup(synonyms, "synonyms fold alike"),
        synonyms.withColumn("w", fold("word")).join(heads.distinct(), "w", "left_semi").select(F.lit("synonym is a headword").alias("check"), "word"),
        synonyms.join(index.select("ordinal"), "ordinal", "left_anti").select(F.lit("synonym without entry").alias("check"), "word"),
    ]
    return reduce(DataFrame.unionByName, parts)


def section_label(title: Column) -> Column:
    """First letter of a title as an ASCII capital; # before it comes a digit, or without any."""
    first = F.regexp_extract(title, r"[\p{L}\p{Nd}]", 0)
    plain = F.upper(F.substring(ascii_fold(first), 1, 1))
    return F.when((first == "") | first.rlike(r"^\p{Nd}"), "#").when(plain != "", plain).otherwise(F.upper(first))


def sections(entries: DataFrame, rank: str = "rank") -> DataFrame:
    """(rank, title, label) of each entry that opens a section: its label isn't that of the entry before."""
    e = entries.select(rank, "title", section_label(F.col("title")).alias("label"))
    # the entry before is found by its rank, not by a window over all rows
    before = e.select((F.col(rank) + 1).alias(rank), F.col("label").alias("last"))
    return e.join(before, rank, "left").where(~F.col("label").eqNullSafe(F.col("last"))).select(rank, "title", "label")


def shards(forms: DataFrame) -> DataFrame:
    """(prefix, word, n_forms): each entry once in each shard of its title and of its variants."""
    f = forms.select(F.col("target").alias("word"), X.kobo_prefix(F.col("form")).alias("prefix"))
    return f.groupBy("prefix", "word").agg(F.count("*").alias("n_forms"))


def escaped(text: Column, quote: bool = False) -> Column:
    t = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.replace(F.replace(t, F.lit('"'), F.lit("&quot;")), F.lit("'"), F.lit("&#x27;")) if quote else t


def rendered(source_name: str) -> Column:
    """An entry's definition as a dictionary page; definition, notice and details must be safe inline HTML."""
    d = F.coalesce("details", F.array().cast("array<struct<label:string,value:string>>"))
    items = F.array_join(F.transform(d, lambda x: F.concat(F.lit("<li><b>"), escaped(x.label), F.lit(":</b> "), escaped(x.value), F.lit("</li>"))), "")
    note = F.when(F.coalesce("spoiler_notice", F.lit("")) != "", F.concat(F.lit('<p class="spoiler-note"><b>Spoiler note:</b> '), escaped(F.col("spoiler_notice")), F.lit("</p>"))).otherwise("")
    head = F.concat(F.lit('<div class="entry"><p class="headword"><b>'), escaped(F.col("title")), F.lit("</b></p>"))
    foot = F.concat(F.lit('</ul><p class="source">Source: '), escaped(F.col("title")), F.lit(f" on {source_name}<br />"), escaped(F.coalesce("url", F.lit(""))), F.lit("</p></div>"))
    return F.concat(head, note, F.lit('<ul class="definition"><li>'), F.coalesce("definition", F.lit("")), F.lit("</li>"), items, foot)


def combined(shared: DataFrame, definitions: DataFrame) -> DataFrame:
    """(word, definition): the pages of all targets of each shared word, in order, as one."""
    j = shared.join(definitions.select(F.col("title").alias("target"), F.col("html")), "target")
    pages = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "html"))), lambda x: x.html), "")
    return j.groupBy("word").agg(F.concat(F.lit('<div class="multi-lookup">'), pages, F.lit("</div>")).alias("definition"))


def tag_inventory(pages: DataFrame, column: str) -> DataFrame:
    """(tag, n): start tags in a column of HTML."""
    tags = F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit("<([A-Za-z][A-Za-z0-9]*)"), F.lit(1))
    return pages.select(F.explode(F.transform(tags, lambda t: F.lower(t))).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def shard_violations(scanned: DataFrame, allowed_tags: tuple[str, ...] = ("a", "b", "br", "div", "i", "li", "p", "ul", "var", "variant", "w", "html"), hrefs: tuple[str, ...] = ()) -> DataFrame:
    """(check, word): what breaks a prefix-sharded dictionary (prefix, headword, variants, html); must be empty."""
    from functools import reduce

    words = scanned.select("prefix", "headword", F.explode(F.concat(F.array("headword"), "variants")).alias("form"))
    placed = words.groupBy("headword", "prefix").agg(F.bool_or(X.kobo_prefix(F.col("form")) == F.col("prefix")).alias("ok"))
    heads = words.select(fold("form").alias("w"), "headword").distinct().groupBy("w").agg(F.count("*").alias("n"), F.min("headword").alias("word"))
    tags = F.transform(F.regexp_extract_all("html", F.lit("</?([A-Za-z][A-Za-z0-9]*)"), F.lit(1)), lambda t: F.lower(t))
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    fits = (lambda h: reduce(lambda a, b: a | b, [h.startswith(p) for p in hrefs])) if hrefs else (lambda h: F.lit(False))
    parts = [
        placed.where("NOT ok").select(F.lit("wrong shard").alias("check"), F.col("headword").alias("word")),
        heads.where("n > 1").select(F.lit("word of two headwords").alias("check"), "word"),
        scanned.where("headword IS NULL OR trim(headword) = ''").select(F.lit("no headword").alias("check"), F.col("headword").alias("word")),
        scanned.where(F.size(F.array_except(tags, F.array(*[F.lit(t) for t in allowed_tags]))) > 0).select(F.lit("tag not allowed").alias("check"), F.col("headword").alias("word")),
        scanned.where(F.exists(links, lambda h: ~fits(h))).select(F.lit("link not allowed").alias("check"), F.col("headword").alias("word")),
    ]
    return reduce(DataFrame.unionByName, parts)
