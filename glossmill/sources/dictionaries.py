"""Dictionary files: scans of StarDict bundles, prefix-sharded zips and Palm books, and writers of the first two,
of their source text, and of an e-reader's XHTML.

A scan reads files with Spark's binaryFile source and parses each in one Arrow batch. The formats themselves are
single files with 32-bit offsets, so a writer streams ordered rows through the driver, one at a time; everything
before that (order, offsets, rendering) is distributed.
"""

from __future__ import annotations

import gzip
import html
import io
import os
import re
import struct
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.keys import fold
from ..operators import index

# What the formats demand.
STARDICT_VERSION = "2.4.2"
PALM_HEADER, PALM_ENTRY, MOBI_AT, MOBI_UTF8, MOBI_VERSION, MOBI_UNUSED = 78, 8, 16, 65001, 7, 0xFFFFFFFF


def _binary(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def _records(data: bytes, numbers: int) -> Iterator[tuple]:
    """NUL-terminated words, each followed by big-endian 32-bit numbers."""
    at = 0
    while at < len(data):
        end = data.index(b"\0", at)
        tail = end + 1 + 4 * numbers
        yield (data[at:end].decode("utf-8"), *struct.unpack(f">{numbers}I", data[end + 1 : tail]))
        at = tail


def scan_index(spark: SparkSession, path: str) -> DataFrame:
    """(word, ordinal, offset, size) of a .idx file."""

    def run(batches):
        for batch in batches:
            for data in batch["content"].to_pylist():
                rows = list(_records(data, 2))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array(range(len(rows)), pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], names=["word", "ordinal", "offset", "size"])

    return _binary(spark, path).mapInArrow(run, "word string, ordinal bigint, offset bigint, size bigint")


def scan_synonyms(spark: SparkSession, path: str) -> DataFrame:
    """(word, ordinal) of a .syn file."""

    def run(batches):
        for batch in batches:
            for data in batch["content"].to_pylist():
                rows = list(_records(data, 1))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["word", "ordinal"])

    return _binary(spark, path).mapInArrow(run, "word string, ordinal bigint")


def scan_info(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a .ifo file; its first line names the format."""
    lines = spark.read.text(path).where("value LIKE '%=%'")
    return lines.select(F.substring_index("value", "=", 1).alias("key"), F.regexp_replace("value", "^[^=]*=", "").alias("value"))


_WORD = re.compile(r"<w>(.*?)</w>", re.S)


def scan_kobo(spark: SparkSession, path: str) -> DataFrame:
    """(prefix, headword, variants, html) of a prefix-sharded zip; members may be gzipped."""

    def run(batches):
        for batch in batches:
            rows = []
            for data in batch["content"].to_pylist():
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    for name in z.namelist():
                        if not name.endswith(".html"):
                            continue
                        body = z.read(name)
                        text = (gzip.decompress(body) if body[:2] == b"\x1f\x8b" else body).decode("utf-8")
                        for w in _WORD.findall(text):
                            head = re.search(r'<a name="([^"]*)"', w)
                            rows.append((name[:-5], html.unescape(head[1]) if head else None, [html.unescape(v) for v in re.findall(r'<variant name="([^"]*)"', w)], w.partition("</var>")[2] or w))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.list_(pa.string()), pa.string()))], names=["prefix", "headword", "variants", "html"])

    return _binary(spark, path).mapInArrow(run, "prefix string, headword string, variants array<string>, html string")


def palm_header(data: bytes) -> dict:
    """Header fields of a Palm book, with what is wrong with it (``errors``)."""
    errors: list[str] = []
    out = dict.fromkeys(("records", "text_records", "encryption", "encoding", "version", "orthographic", "inflection", "naming"))
    out |= {"size": len(data), "title": "", "errors": errors}
    if len(data) < 1024:
        errors.append("file is too small")
    if data[60:68] != b"BOOKMOBI":
        errors.append("not a Palm book")
    if len(data) < PALM_HEADER + 2 * PALM_ENTRY:
        return out
    n = out["records"] = struct.unpack_from(">H", data, 76)[0]
    offsets = [struct.unpack_from(">I", data, PALM_HEADER + PALM_ENTRY * i)[0] for i in range(n) if PALM_HEADER + PALM_ENTRY * i + 4 <= len(data)]
    if len(offsets) < 2 or offsets != sorted(set(offsets)) or offsets[-1] >= len(data):
        errors.append("record offsets are invalid")
        return out
    first = data[offsets[0] : offsets[1]]
    if len(first) < MOBI_AT + 92 or first[MOBI_AT : MOBI_AT + 4] != b"MOBI":
        errors.append("no MOBI header")
        return out
    at = lambda k: struct.unpack_from(">I", first, MOBI_AT + k)[0]
    out["text_records"], out["encryption"] = struct.unpack_from(">H", first, 8)[0], struct.unpack_from(">H", first, 12)[0]
    out["encoding"], out["version"], out["orthographic"], out["inflection"], out["naming"] = at(12), at(20), at(24), at(28), at(32)
    start, size = at(68), at(72)
    out["title"] = first[start : start + size].decode("utf-8", "replace") if start + size <= len(first) else ""
    checks = ((out["encoding"] != MOBI_UTF8, "encoding"), (out["version"] != MOBI_VERSION, "version"), (out["encryption"] != 0, "encryption"), (not 1 <= out["text_records"] < n, "text records"), (not out["title"], "title"))
    errors.extend(f"{what} is invalid" for bad, what in checks if bad)
    errors.extend(f"{k} index is missing" for k in ("orthographic", "naming") if out[k] == MOBI_UNUSED or out[k] >= n)
    return out


def scan_palm(spark: SparkSession, path: str) -> DataFrame:
    """One row per Palm book: header fields and errors."""
    names = ["path", "size", "records", "text_records", "encoding", "version", "encryption", "title", "orthographic", "inflection", "naming", "errors"]
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), *[pa.int64()] * 3, pa.list_(pa.string())]

    def run(batches):
        for batch in batches:
            rows = [{"path": p, **palm_header(d)} for p, d in zip(batch["path"].to_pylist(), batch["content"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

    return _binary(spark, path).mapInArrow(run, "path string, size bigint, records bigint, text_records bigint, encoding bigint, version bigint, encryption bigint, title string, orthographic bigint, inflection bigint, naming bigint, errors array<string>")


def write_stardict(folder: str | Path, name: str, title: str, author: str, words: DataFrame, forms: DataFrame) -> dict[str, int]:
    """A bundle from (word, definition) and (target, form); returns its counts. Raises ValueError on a bad headword,
    on words that fold alike, or on more data than 32-bit offsets reach."""
    rows = index.index_rows(words)
    synonyms = index.synonym_rows(forms, rows)
    bad = index.index_violations(rows, synonyms, index.LIMIT).limit(3).collect()
    if bad:
        raise ValueError(f"not a valid index: {bad}")
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    n = m = 0
    with open(folder / f"{name}.idx", "wb") as idx, open(folder / f"{name}.dict", "wb") as data:
        for r in rows.join(words, "word").orderBy("ordinal").select("word", "offset", "size", "definition").toLocalIterator():
            idx.write(r.word.encode() + b"\0" + struct.pack(">II", r.offset, r.size))
            data.write(r.definition.encode())
            n += 1
    with open(folder / f"{name}.syn", "wb") as syn:
        for r in synonyms.orderBy(*index.index_order(F.col("word"))).toLocalIterator():
            syn.write(r.word.encode() + b"\0" + struct.pack(">I", r.ordinal))
            m += 1
    size = os.path.getsize(folder / f"{name}.idx")
    info = {"version": STARDICT_VERSION, "bookname": title, "wordcount": n, "synwordcount": m, "idxfilesize": size, "author": author, "lang": "en-en", "sametypesequence": "h"}
    (folder / f"{name}.ifo").write_text("StarDict's dict ifo file\n" + "".join(f"{k}={v}\n" for k, v in info.items()), "utf-8")
    (folder / f"{name}.css").write_text(".headword { font-weight: bold; }\n.source { font-size: 0.8em; }\n", "utf-8")
    return {"words": n, "synonyms": m}


def word_blocks(words: DataFrame, forms: DataFrame) -> DataFrame:
    """(word, variants, block): each word's record of a prefix-sharded dictionary."""
    v = forms.where("form <> target").select(F.col("target").alias("word"), F.struct("ord", fold(F.trim(F.col("form"))).alias("v")).alias("x"))
    v = v.groupBy("word").agg(F.array_distinct(F.transform(F.sort_array(F.collect_list("x")), lambda y: y.v)).alias("variants"))
    j = words.join(v, "word", "left").withColumn("variants", F.coalesce("variants", F.array().cast("array<string>")))
    head = F.concat(F.lit('<w><p><a name="'), index.escaped(F.trim(F.col("word")), True), F.lit('" /><b>'), index.escaped(F.col("word")), F.lit("</b></p><var>"))
    tags = F.array_join(F.transform("variants", lambda x: F.concat(F.lit('<variant name="'), index.escaped(x, True), F.lit('"/>'))), "")
    return j.select("word", "variants", F.concat(head, tags, F.lit("</var>"), F.col("definition"), F.lit("</w>")).alias("block"))


def write_kobo(path: str | Path, words: DataFrame, forms: DataFrame) -> int:
    """A prefix-sharded zip; a word is in the shard of its headword and of each variant. Returns the shards' number."""
    blocks = word_blocks(words, forms)
    each = blocks.select("word", "block", F.explode(F.array_distinct(F.transform(F.concat(F.array("word"), "variants"), lambda w: X.kobo_prefix(w)))).alias("prefix"))
    names = blocks.select(F.explode(F.concat(F.array("word"), "variants")).alias("w")).distinct().select(fold("w").alias("k"), "w").orderBy("k", "w")
    n = 0
    with zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED) as z:
        with z.open("words", "w") as out:
            for i, r in enumerate(names.toLocalIterator()):
                out.write((("\n" if i else "") + r.w).encode())
        last, out = None, None
        for r in each.orderBy("prefix", *index.index_order(F.col("word"))).toLocalIterator():
            if r.prefix != last:
                if out is not None:
                    out.write(b"</html>")
                    out.close()
                out, last, n = z.open(f"{r.prefix}.html", "w"), r.prefix, n + 1
                out.write(b"<html>")
            out.write(r.block.encode())
        if out is not None:
            out.write(b"</html>")
            out.close()
    return n


def dictfile_lines(words: DataFrame, forms: DataFrame) -> DataFrame:
    """(word, block): source text of a prefix-sharded dictionary: headword, variants, definition."""
    v = forms.where("form <> target").groupBy(F.col("target").alias("word")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "form"))), lambda x: F.concat(F.lit("& "), x.form, F.lit("\n"))), "").alias("v"))
    return words.join(v, "word", "left").select("word", F.concat(F.lit("@ "), "word", F.lit("\n"), F.coalesce("v", F.lit("")), F.lit("::\n<html>"), "definition", F.lit("\n")).alias("block"))


def kindle_blocks(entries: DataFrame, forms: DataFrame, source_name: str) -> DataFrame:
    """(rank, block): each entry of an e-reader's dictionary with its inflections; entries have rank, title, url,
    definition, spoiler_notice, details."""
    v = forms.where("ord > 0").groupBy(F.col("target").alias("title")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "form"))), lambda x: F.concat(F.lit('<idx:iform value="'), index.escaped(x.form, True), F.lit('" />'))), "").alias("v"))
    j = entries.join(v, "title", "left")
    infl = F.when(F.col("v").isNotNull(), F.concat(F.lit("<idx:infl>"), "v", F.lit("</idx:infl>"))).otherwise("")
    head = F.concat(F.lit('<idx:entry name="default" scriptable="yes" spell="yes" id="entry-'), F.col("rank").cast("string"), F.lit('"><a id="entry-'), F.col("rank").cast("string"), F.lit('"></a><idx:orth value="'), index.escaped(F.col("title"), True), F.lit('"><b>'), index.escaped(F.col("title"), True), F.lit("</b>"), infl, F.lit("</idx:orth><idx:short>"))
    return j.select("rank", F.concat(head, index.rendered(source_name), F.lit("</idx:short></idx:entry>")).alias("block"))


def kindle_duplicates(entries: DataFrame, shared: DataFrame, source_name: str) -> DataFrame:
    """(rank, word, ord, block): under each shared word a further record of each of its entries, beside the first one's
    own record; the word's own entry needs none."""
    e = entries.select("title", "rank", index.rendered(source_name).alias("html"))
    first = shared.where("ord = 1").select("word", F.col("target").alias("first")).join(e.select(F.col("title").alias("first"), "rank"), "first")
    each = shared.join(e.drop("rank"), F.col("title") == F.col("target")).where(~((F.col("ord") == 1) & (fold("word") == fold("target"))))
    j = each.join(first.drop("first"), "word")
    name = F.concat(F.lit("entry-"), F.col("rank").cast("string"), F.lit("-lookup-"), F.hex(F.xxhash64("word")), F.lit("-"), (F.col("ord") - 1).cast("string"))
    head = F.concat(F.lit('<idx:entry name="default" scriptable="yes" spell="yes" id="'), name, F.lit('"><a id="'), name, F.lit('"></a><idx:orth value="'), index.escaped(F.col("word"), True), F.lit('"><b>'), index.escaped(F.col("title"), True), F.lit("</b></idx:orth><idx:short>"))
    return j.select("rank", "word", "ord", F.concat(head, F.col("html"), F.lit("</idx:short></idx:entry>")).alias("block"))


def missing_headwords(rows: DataFrame, synonyms: DataFrame, required: DataFrame) -> DataFrame:
    """(word) of ``required`` that is neither a headword nor a synonym of an index; letters must be equal."""
    known = rows.select("word").unionByName(synonyms.select("word"))
    return required.select("word").distinct().join(known.distinct(), "word", "left_anti")


def write_kindle(path: str | Path, title: str, blocks: DataFrame, sections: DataFrame, more: DataFrame | None = None) -> int:
    """The XHTML source of an e-reader's dictionary with section breaks, each entry followed by the further records of
    shared words; returns the number of records."""
    head = f'<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE html>\n<html xmlns="http://www.w3.org/1999/xhtml" xmlns:idx="http://www.mobipocket.com/idx" xmlns:mbp="http://www.mobipocket.com/mbp"><head><title>{html.escape(title)}</title></head><body><mbp:frameset>\n'
    n = 0
    rows = blocks.join(sections.select("rank", "label"), "rank", "left").withColumn("word", F.lit(None).cast("string")).withColumn("ord", F.lit(0))
    if more is not None:
        rows = rows.unionByName(more.select("rank", "block", F.lit(None).cast("string").alias("label"), "word", "ord"))
    with open(path, "w", encoding="utf-8") as out:
        out.write(head)
        for r in rows.orderBy("rank", F.col("word").asc_nulls_first(), "ord").toLocalIterator():
            if r.label:
                name = "number" if r.label == "#" else html.escape(r.label, quote=True)
                out.write(f'<mbp:pagebreak /><h1 class="letter-heading" id="letter-{name}">{"0-9" if r.label == "#" else r.label}</h1>\n')
            out.write(r.block + "\n<hr />\n")
            n += 1
        out.write("</mbp:frameset></body></html>\n")
    return n
