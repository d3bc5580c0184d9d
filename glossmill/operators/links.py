"""Mentions of entries' titles in other entries' definitions.

A text's word n-grams (up to the longest title) meet the titles in an equi-join, so there is no comparison of
every title with every text. Hits of one text are then taken from left to right, of those that begin at one place the
longest; a hit that begins before the last taken one ends isn't taken. An entry's own title takes its place as well,
but is no mention; only the first mention of a title counts. A mention neither follows nor precedes a word character.
Titles of fewer than four characters need a blank, hyphen or apostrophe to be looked for. The n-grams of a text are
bounded by its words times the number of lengths of titles.

Defined cases: null and empty texts have no mentions; null titles are never found, and an entry without one links to all.
"""

from __future__ import annotations

import re
from html import escape, unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]"
WORD = r"^[\p{L}\p{N}_]"


def linkable(title: Column) -> Column:
    return (F.length(title) >= 4) | title.rlike(r"[ \-']")


def pieces(text: Column) -> Column:
    """A text as runs of word characters and single other characters; a mention begins and ends on such a border."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def _taken(spans: pa.Array) -> pa.Array:
    """Of each list of spans (at, n, target) in order those that are taken from left to right."""
    out = []
    for row in spans.to_pylist():
        end, kept = 0, []
        for s in row:
            if s["at"] >= end:
                end = s["at"] + s["n"]
                kept.append(s)
        out.append(kept)
    return pa.array(out, spans.type)


_SPANS = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("less", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("target", T.StringType())]))
_taken.__annotations__ = {"spans": pa.Array, "return": pa.Array}
_taken_udf = F.arrow_udf(_taken, _SPANS)


def spans(texts: DataFrame, titles: DataFrame) -> DataFrame:
    """(pos, node, at, n, target): the titles taken in each text (pos, node, text), ``at`` and ``n`` in pieces."""
    titles = titles.where(F.col("title").isNotNull() & linkable(F.col("title"))).select(F.col("title").alias("target"), F.size(pieces(F.col("title"))).alias("n")).distinct()
    sizes = [r[0] for r in titles.groupBy("n").count().orderBy("n").collect()]  # numbers of pieces that titles have
    words = texts.select("pos", "node", pieces(F.col("text")).alias("p"))
    if not sizes:
        return texts.select("pos", "node", F.lit(0).alias("at"), F.lit(0).alias("n"), F.col("text").alias("target")).where(F.lit(False))
    # only pieces that some title begins with are begins; the texts' own arrays stay out of the semi-join
    firsts = titles.select(F.get(pieces(F.col("target")), F.lit(0)).alias("piece")).distinct()
    mine = words.select(F.col("pos").alias("_pos"), F.col("node").alias("_node"), F.explode(F.array_distinct("p")).alias("piece")).join(firsts, "piece", "left_semi")
    mine = mine.groupBy("_pos", "_node").agg(F.collect_set("piece").alias("firsts"))
    words = words.join(mine, F.col("pos").eqNullSafe(F.col("_pos")) & F.col("node").eqNullSafe(F.col("_node")))
    apart = lambda i: ~F.coalesce(F.get("p", i), F.lit("")).rlike(WORD)
    begins = F.filter(F.sequence(F.lit(0), F.greatest(F.size("p") - 1, F.lit(0))), lambda i: F.array_contains("firsts", F.get("p", i)) & ((i == 0) | ~F.get("p", i - 1).rlike(WORD)))
    words = words.select("pos", "node", "p", F.explode(begins).alias("at"))
    inside = lambda n: (F.col("at") + n <= F.size("p")) & apart(F.col("at") + n)
    grams = F.array(*[F.struct(F.lit(n).alias("n"), F.when(inside(n), F.array_join(F.slice("p", F.col("at") + 1, n), "")).alias("target")) for n in sizes])
    each = words.select("pos", "node", "at", F.explode(grams).alias("g")).select("pos", "node", "at", "g.n", "g.target").where("target IS NOT NULL")
    hits = each.join(titles.select("target"), "target")
    listed = hits.groupBy("pos", "node").agg(F.sort_array(F.collect_list(F.struct("at", (-F.col("n")).alias("less"), "n", "target"))).alias("s"))
    return listed.select("pos", "node", F.explode(_taken_udf("s")).alias("s")).select("pos", "node", "s.at", "s.n", "s.target")


def mentions(entries: DataFrame) -> DataFrame:
    """(pos, target, at): first mention of each other title in each plain definition; ``at`` is its piece number."""
    found = spans(entries.select("pos", F.lit(0).alias("node"), F.col("plain").alias("text")), entries)
    own = entries.select("pos", "title")
    others = found.join(own, "pos").where(~F.col("target").eqNullSafe(F.col("title")))
    return others.groupBy("pos", "target").agg(F.min("at").alias("at"))


_TAG = re.compile(r"(</?[bi]>)")
_PIECE = re.compile(r"\w+|\W", re.S)


def _with_links(definitions: pa.Array, places: pa.Array, prefix: str) -> pa.Array:
    out = []
    for text, found in zip(definitions.to_pylist(), places.to_pylist()):
        if not text or not found:
            out.append(text)
            continue
        parts = _TAG.split(text)  # texts at even places
        todo: dict[int, list] = {}
        for s in found:
            todo.setdefault(2 * s["node"], []).append(s)
        for i, these in todo.items():
            p, done, at = _PIECE.findall(unescape(parts[i])), [], 0
            for s in sorted(these, key=lambda s: s["at"]):
                name = escape(s["target"], quote=False)
                done += [escape("".join(p[at : s["at"]]), quote=False), f'<a href="{escape(prefix + s["target"], quote=True)}">{name}</a>']
                at = s["at"] + s["n"]
            parts[i] = "".join([*done, escape("".join(p[at:]), quote=False)])
        out.append("".join(parts))
    return pa.array(out, pa.string())


def linked(entries: DataFrame, prefix: str = "bword://") -> DataFrame:
    """(pos, definition): safe inline definitions in which the first mention of each other title is a link.

    Mentions are looked for in each stretch of text between tags, as a link can't hold a tag's one half.
    """

    def run(definitions: pa.Array, places: pa.Array) -> pa.Array:
        return _with_links(definitions, places, prefix)

    run.__annotations__ = {"definitions": pa.Array, "places": pa.Array, "return": pa.Array}
    stretches = F.split(F.coalesce("definition", F.lit("")), "</?[bi]>", -1)
    plain = lambda t: F.replace(F.replace(F.replace(t, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))
    texts = entries.select("pos", F.posexplode(stretches).alias("node", "t")).select("pos", "node", plain(F.col("t")).alias("text"))
    found = spans(texts, entries).join(entries.select("pos", "title"), "pos").where(~F.col("target").eqNullSafe(F.col("title")))
    first = found.groupBy("pos", "target").agg(F.min(F.struct("node", "at", "n")).alias("x")).select("pos", F.struct("x.node", "x.at", "x.n", "target").alias("x"))
    places = first.groupBy("pos").agg(F.collect_list("x").alias("places"))
    none = F.array().cast("array<struct<node:int,at:int,n:int,target:string>>")
    return entries.join(places, "pos", "left").select("pos", F.arrow_udf(run, T.StringType())("definition", F.coalesce("places", none)).alias("definition"))
