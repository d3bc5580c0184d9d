"""Text cut off by field limits.

A backward character n-gram model: for the characters before a value's end it compares how often the corpus
ends there with how often it goes on. Texts are masked first (names and numbers), so that contexts are about
wording. Contexts of several lengths are hashed; only contexts that end some value are counted, which a filter
decides while the corpus is scanned, and the counts are exact by a join afterwards. The filter has PER_CONTEXT bits
for each context that ends a value; where that would be more than MOST_BITS, contexts are dealt to several filters and
the corpus is scanned once for each. The longest
context with enough evidence gives the log-odds of an end, and a threshold per language and column decides.
Broken markup and half characters are exact signs of a cut. Signs of omission are taken off before scoring.

Defined cases: null, empty and blank values are no cases; equal texts count once as evidence, so a cut text
that another table inherited doesn't vouch for itself; values that end a sentence are no cases, but a full stop after
an abbreviation or initial ends none; pointers to other titles and the cases of operator 1 are none either; repeated rows give one row; empty tables give none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.orphans import pointer_target
from ..plans.lineage import cut
from ..sources.tables import host_of
from . import residue

ORDERS = (3, 6, 11, 18, 30)  # lengths of contexts
EVIDENCE = 3  # other occurrences that a context needs to be believed
PER_CONTEXT = 8  # bits of the filter
MOST_BITS = 1 << 26  # of one filter

_NAME = re.compile(r"(?<![.!?…:“\n>] )(?<!^)(?<![\w’'“>])[A-ZÀ-ÖØ-Þ][\w’'-]*(?: (?:the |of |von )?[A-ZÀ-ÖØ-Þ][\w’'-]*)*")
_NUMBER = re.compile(r"\d+(?:[.,:]\d+)*")
_HALF_NAME = re.compile(r"N (?:of?(?: t(?:he?)?)?|t(?:he?)?|v(?:on?)?)$")
_SIGN = re.compile(r"(?:\s*(?:\.{2,}|…|[\[(]\s*(?:\+|…|\.{3}|more|read more|cont(?:\.|inued|inue reading)?|truncated|cut|mehr|weiterlesen|suite|lire la suite|más|leer más)\s*[\])]))+\s*$", re.I)
_END = re.compile(r"[.!?]['\"”’»)\]]*$|[。！？]$")
# Abbreviations after which a sentence goes on.
_ABBREVIATED = re.compile(r"(?:^|[\s(“\"])(?:Mr|Mrs|Ms|Dr|Prof|Capt|Lt|Col|Gen|Sgt|St|Hr|Mme|Mlle|Sra|bzw|[A-Z])\.$")
_BROKEN = re.compile(r"<[A-Za-z/!][^<>]*$|<$|&(?:#?\w{0,8})$|�+$")
_TAGS = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?>")
# Function words that tell the four languages apart.
_TELL = {"en": {"the", "and", "of", "is", "was", "with", "that"}, "de": {"der", "die", "das", "und", "ist", "nicht", "mit"}, "fr": {"le", "et", "est", "les", "une", "qui", "dans"}, "es": {"el", "los", "que", "una", "por", "con", "no"}}


def mask_of(plain: str) -> str:
    """Wording with names and numbers masked; a name that stops inside is a name."""
    return _HALF_NAME.sub("N", _NUMBER.sub("0", _NAME.sub("N", plain)))


def language_of(plain: str) -> str:
    words = plain.lower().split()
    best = max(_TELL, key=lambda k: sum(w in _TELL[k] for w in words))
    return best if any(w in _TELL[best] for w in words) else "other"


def is_broken(text: str) -> bool:
    """Whether markup or a character stops in the middle."""
    if _BROKEN.search(text):
        return True
    if "<" not in text:
        return False
    depth: dict[str, int] = {}
    for close, tag in _TAGS.findall(text):
        tag = tag.lower()
        if tag not in ("br", "hr", "img", "wbr"):
            depth[tag] = depth.get(tag, 0) + (-1 if close else 1)
    return any(n > 0 for n in depth.values())


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def context_hashes(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions' text numbers, and for each order the hash of the context that ends with each position.

    Each text is preceded by as many blanks of its own as the longest context, so that none reaches another text.
    """
    pad = "\x02" * ORDERS[-1]
    joined = "".join(pad + t for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(points)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(points * _powers(_INVERSE, n), out=sums[1:])
    up = _powers(_BASE, n + 1)
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    begins = np.cumsum(sizes + len(pad)) - sizes  # first position of each text
    at = np.arange(sizes.sum()) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)
    hashes = []
    for order in ORDERS:
        h = (sums[at + 1] - sums[at + 1 - order]) * up[at]  # equal contexts have equal products whatever their place
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        hashes.append(((h << np.uint64(3)) | np.uint64(ORDERS.index(order))).view(np.int64))
    return np.repeat(np.arange(len(texts)), sizes), hashes


_TAILS = "rec_table string, rec_id bigint, host string, text string, lang string, signed boolean, broken boolean, text_hash bigint, contexts array<bigint>"


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values that don't end with a sentence, with their final contexts."""
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.list_(pa.int64())]
    names = ["rec_table", "rec_id", "host", "text", "lang", "signed", "broken", "text_hash", "contexts"]
    for batch in batches:
        rows, ends = [], []
        for kind, key, host, text, h in zip(*(batch[c].to_pylist() for c in ("rec_table", "rec_id", "host", "text", "text_hash"))):
            text = text.rstrip()
            broken = is_broken(text)
            plain = residue.plain_of(text).rstrip()
            bare = _SIGN.sub("", plain)
            signed = bare != plain
            if not broken and not signed and _END.search(plain) and not _ABBREVIATED.search(plain):
                continue
            rows.append((kind, key, host, text, language_of(bare), signed, broken, h))
            ends.append(mask_of(bare) or " ")
        if not rows:
            continue
        whose, hashes = context_hashes(ends)
        last = np.flatnonzero(np.append(whose[1:] != whose[:-1], True))
        contexts = np.stack([h[last] for h in hashes], 1).tolist()
        columns = [*zip(*rows), contexts]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _goings_on(bits: np.ndarray, part: int, parts: int):
    """(h, n): how often the corpus goes on after a context, for contexts of a part that pass its filter."""
    size = np.uint64(64 * len(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [mask_of(_SIGN.sub("", residue.plain_of(t.rstrip()))) or " " for t in batch["text"].to_pylist()]
            for at in range(0, len(texts), 2000):
                whose, hashes = context_hashes(texts[at : at + 2000])
                inside = np.append(whose[1:] == whose[:-1], False)
                found = []
                for h in hashes:
                    u = h.view(np.uint64) >> np.uint64(11)
                    b = (u // np.uint64(parts) % size).astype(np.int64)
                    passes = inside & ((bits[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
                    found.append(h[passes & (u % np.uint64(parts) == part)] if parts > 1 else h[passes])
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["h", "n"])

    return run


def goings_on(ends: DataFrame, texts: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(h, goes): how often distinct texts go on after each context of ``ends``, and after some others.

    Of a filter no more than most_bits / 64 rows reach the driver.
    """
    n = ends.count()
    size = 1 << max(12, min(most_bits, PER_CONTEXT * n) - 1).bit_length() if n else 1 << 12
    size = min(size, most_bits)
    parts = max(1, -(-PER_CONTEXT * n // size))
    u = F.shiftrightunsigned("h", 11)
    counted = None
    for part in range(parts):
        mine = ends.where(F.pmod(u, F.lit(parts)) == part).select(F.pmod(F.floor(u / F.lit(parts)) if parts > 1 else u, F.lit(size)).cast("bigint").alias("b"))
        words = mine.groupBy(F.shiftright("b", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 AS int)))").alias("bits")).toArrow()
        bits = np.zeros(size // 64, np.int64)
        bits[words["w"].to_numpy()] = words["bits"].to_numpy()
        found = texts.mapInArrow(_goings_on(bits.view(np.uint64), part, parts), "h bigint, n bigint")
        counted = found if counted is None else counted.unionByName(found)
    return counted.groupBy("h").agg(F.sum("n").alias("goes"))


def _values(pages: DataFrame, entries: DataFrame) -> DataFrame:
    r = residue.records(pages, entries)
    return r.select("rec_table", "rec_id", "title", host_of(F.col("url")).alias("host"), "text", F.xxhash64("text").alias("text_hash"))


def scored(pages: DataFrame, entries: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(rec_table, rec_id, host, text, lang, signed, broken, odds): log-odds of an end for values that don't end a sentence.

    What is joined grows with the data on both sides, so the joins are merge joins, whatever the sizes.
    """
    return _scored(cut(_values(pages, entries), "values"), most_bits)


def _scored(values: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    tails = cut(values.where(pointer_target(F.col("text")).isNull()).mapInArrow(_tails, _TAILS), "tails")
    events = tails.select("text_hash", F.explode("contexts").alias("h")).distinct()
    ends = cut(events.groupBy("h").agg(F.count("*").alias("ends")), "ends")
    goes = goings_on(ends, values.select("text_hash", "text").distinct().select("text"), most_bits)
    model = ends.join(goes.hint("merge"), "h", "left").select("h", F.col("ends") - 1, F.coalesce("goes", F.lit(0)).alias("goes")).toDF("h", "ends", "goes")
    # a tuple of contexts is scored once, however many values end with it
    tuples = tails.select("contexts").distinct()
    each = tuples.select("contexts", F.posexplode("contexts").alias("order", "h")).join(model.hint("merge"), "h")
    enough = F.when(F.col("ends") + F.col("goes") >= EVIDENCE, F.struct("order", (F.log(F.col("ends") + 0.5) - F.log(F.col("goes") + 0.5)).alias("odds")))
    best = each.groupBy("contexts").agg(F.max(enough).alias("best")).select("contexts", F.col("best.odds").alias("odds"))
    return tails.join(best.hint("merge"), "contexts", "left").drop("contexts", "text_hash")


def truncated(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """(rec_table, rec_id, host): truncated values, without the cases of operator 1."""
    values = cut(_values(pages, entries), "values")
    s = cut(_scored(values), "scored")
    # the threshold lies between the mean log-odds of likely ends and of likely goings-on, per language and column
    sides = s.groupBy("rec_table", "lang").agg(F.avg(F.when(F.col("odds") >= 0, F.col("odds"))).alias("high"), F.avg(F.when(F.col("odds") < 0, F.col("odds"))).alias("low"))
    limits = sides.select("rec_table", "lang", F.least(F.greatest((F.coalesce("high", F.lit(1.0)) + F.coalesce("low", F.lit(-1.0))) / 2, F.lit(-1.0)), F.lit(1.0)).alias("limit"))
    at = s.join(F.broadcast(limits), ["rec_table", "lang"])  # two columns by five languages
    cut_off = F.col("broken") | F.coalesce(F.col("odds") < F.col("limit"), F.col("signed"))
    found = at.where(cut_off).select("rec_table", "rec_id", "host").distinct()
    return found.join(residue.residue_of(values).hint("merge"), ["rec_table", "rec_id"], "left_anti")


def truncated_found(pages: DataFrame, entries: DataFrame) -> DataFrame:
    return truncated(pages, entries).select("rec_table", "rec_id").distinct()


def truncation_rates(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """Per host and column: values, truncated ones and their share."""
    all_values = residue.records(pages, entries).select("rec_table", "rec_id", host_of(F.col("url")).alias("host")).distinct()
    n = all_values.groupBy("host", "rec_table").agg(F.count("*").alias("n_values"))
    t = truncated(pages, entries).groupBy("host", "rec_table").agg(F.count("*").alias("n_truncated"))
    both = n.join(t, ["host", "rec_table"], "left").withColumn("n_truncated", F.coalesce("n_truncated", F.lit(0)))
    return both.withColumn("share", F.round(F.col("n_truncated") / F.col("n_values"), 6))
