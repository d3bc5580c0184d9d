"""Text expressions of the dictionary, as Catalyst columns.

Java's classes are ASCII unless (?U) is set, and its ``.`` stops at more line ends than LF unless (?d) is set;
both are set where a text may hold more than ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower case of ASCII letters only: the order of the page store and of dictionary indexes."""
    return F.translate(text, UPPER, LOWER)


def squeezed(text: Column) -> Column:
    """Runs of white space to one blank, trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f\x85\xa0]+", " "))


def without_markers(text: Column) -> Column:
    """Without citation markers such as [1]."""
    return F.regexp_replace(text, r"(?U)\s*\[\s*\d+\s*\]", "")


def without_artifacts(text: Column) -> Column:
    """Small source artifacts mended, in this order: markers, ``isa``, ``a god of .``, blanks before stops, a pointer
    to more information and an art credit at the end, white space."""
    t = without_markers(text)
    # The artifacts' wordings.
    t = F.regexp_replace(t, r"(?U)\bisa\b", "is a")
    t = F.regexp_replace(t, r"(?iU)\ba god of\s*\.", "a god.")
    t = F.regexp_replace(t, r"(?U)\s+([,.;:!?])", "$1")
    t = F.regexp_replace(t, r"(?iU)\s+For more information:\s*[^.]+\.?$", "")
    t = F.regexp_replace(t, r"(?idU)\s+(?:official\s+art|art)\s+by\b.*$", "")
    return squeezed(t)


def first_sentence(text: Column, most: int = 500) -> Column:
    """Up to the first sentence end, or ``most`` characters of a text without one."""
    head = F.regexp_extract(text, r"(?s)^(.*?[.!?])(?U:\s)+", 1)
    return F.when(head != "", head).otherwise(F.substring(text, 1, most))


def without_parenthetical(title: Column) -> Column:
    """A title without its trailing parenthetical; null if that leaves it unchanged or empty."""
    bare = F.trim(F.regexp_replace(title, r"(?U)\s+\([^()]{1,120}\)\s*$", ""))
    return F.when((bare != "") & (bare != title), bare)


def without_article(text: Column) -> Column:
    return squeezed(F.regexp_replace(text, r"(?iU)^(?:the|a|an)\s+", ""))


def snippet(text: Column, most: int = 220) -> Column:
    """One line of at most ``most`` characters."""
    t = squeezed(text)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, most - 1)), F.lit("…")))


def slug(text: Column) -> Column:
    """A file name's stem."""
    s = F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9]+", "-"), r"^-+|-+$", "")
    return F.when(s != "", s).otherwise("Dictionary")


def trails_off(text: Column) -> Column:
    """Whether a text ends with a connective."""
    # The connectives.
    return text.rlike(r"(?iU)\b(?:and|or|but|because|with|of|to)\s*$")


# Forms of a definition that only sends the reader on, as the dictionary's build follows them.
FORWARDS = (r"See:\s+(.+)", r"duplicate page\s*-\s*please see\s+(.+)", r"(?:System Message:\s*)?For .+?,\s*please see\s+(.+)", r"please see\s+(.+)")


def forward_target(plain: Column) -> Column:
    """The title that a plain definition forwards to, without its final stops; null if it doesn't."""
    found = F.coalesce(*[F.nullif(F.regexp_extract(plain, rf"(?idU)^{p}$", 1), F.lit("")) for p in FORWARDS])
    return F.regexp_replace(squeezed(found), r"\.+$", "")


def plural(word: Column) -> Column:
    """Regular plural of one word."""
    return (
        F.when(word.rlike(r"(?i)[^aeiou]y$"), F.concat(F.regexp_replace(word, r".$", ""), F.lit("ies")))
        .when(word.rlike(r"(?i)(?:s|x|z|ch|sh)$"), F.concat(word, F.lit("es")))
        .otherwise(F.concat(word, F.lit("s")))
    )


def kobo_prefix(word: Column) -> Column:
    """Shard of a word in the prefix-sharded format: its first two characters in lower case, padded with ``a``, or 11."""
    head = F.regexp_replace(F.substring(F.lower(word), 1, 2), r"\x00.*$", "")
    p = F.trim(head)
    padded = F.rpad(p, 2, "a")
    return F.when(p == "", "11").when(p.rlike(r"^\p{IsCyrillic}"), p).when(padded.rlike(r"^[\p{L}]{2}$"), padded).otherwise("11")


def page_url(base: Column, title: Column) -> Column:
    """Address of a wiki page: blanks to underscores, percent-encoded, slashes, colons and parentheses kept."""
    t = F.replace(F.url_encode(F.replace(title, F.lit(" "), F.lit("_"))), F.lit("+"), F.lit("%20"))
    for code, kept in (("%2F", "/"), ("%3A", ":"), ("%28", "("), ("%29", ")"), ("*", "%2A"), ("%7E", "~")):
        t = F.replace(t, F.lit(code), F.lit(kept))
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/wiki/"), t)


# Fixed value, the pattern of a release number: no leading zeros, numeric parts of a pre-release without them either.
VERSION = r"^v?(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)(?:-((?:0|[1-9]\d*|\d*[a-zA-Z-][0-9a-zA-Z-]*)(?:\.(?:0|[1-9]\d*|\d*[a-zA-Z-][0-9a-zA-Z-]*))*))?$"


def version(text: Column) -> Column:
    """struct(major, minor, patch, prerelease, tag) of a release number, or null where it isn't one."""
    part = lambda i: F.regexp_extract(text, VERSION, i)
    tail = F.when(part(4) != "", F.concat(F.lit("-"), part(4))).otherwise("")
    return F.when(text.rlike(VERSION), F.struct(part(1).cast("bigint").alias("major"), part(2).cast("bigint").alias("minor"), part(3).cast("bigint").alias("patch"), F.nullif(part(4), F.lit("")).alias("prerelease"), F.concat(F.lit("v"), part(1), F.lit("."), part(2), F.lit("."), part(3), tail).alias("tag")))


def identifier(folded: Column) -> Column:
    """A component of an identifier from ASCII text; an error where nothing is left of it."""
    s = F.regexp_replace(F.regexp_replace(folded, r"[^A-Za-z0-9.]+", "-"), r"^-+|-+$", "")
    return F.when(s != "", s).otherwise(F.raise_error(F.lit("empty identifier component")).cast("string"))


def extra_inflections(word: Column) -> Column:
    """Lower-case and possessive variants of a lookup word, without the word itself."""
    low = F.lower(word)
    return F.filter(F.array_distinct(F.array(low, F.concat(word, F.lit("'s")), F.concat(word, F.lit("’s")), F.concat(low, F.lit("'s")), F.concat(low, F.lit("’s")))), lambda x: x != word)


def band_colour(value: Column, bands: tuple[tuple[float, str], ...], rest: str) -> Column:
    """The first band whose floor ``value`` reaches."""
    out = F.lit(rest)
    for floor, colour in reversed(bands):
        out = F.when(value >= floor, colour).otherwise(out)
    return out


# Fixed value, the pattern of a line of a coverage summary: lines, per cent, module and file.
COVERED = r"^\s*(\d+)\s+(\d+(?:\.\d+)?)%\s+\S+\s+\((.+)\)\s*$"


def coverage(lines: DataFrame, root: str, without: str = "(?!)") -> DataFrame:
    """(n_covered, n_lines, per_cent) over the lines (value) of files below ``root`` that don't match ``without``; null without any."""
    size, share, path = (F.regexp_extract("value", COVERED, i) for i in (1, 2, 3))
    mine = lines.where(F.col("value").rlike(COVERED) & path.startswith(root.rstrip("/") + "/") & ~path.rlike(without))
    n = mine.agg(F.sum(F.bround(size.cast("int") * share.cast("double") / 100, 0)).cast("bigint").alias("n_covered"), F.sum(size.cast("bigint")).alias("n_lines"))
    return n.select("n_covered", "n_lines", F.round(100 * F.col("n_covered") / F.col("n_lines")).cast("int").alias("per_cent"))


def badge(label: Column, message: Column, colour: Column) -> Column:
    """A badge's JSON."""
    return F.to_json(F.struct(F.lit(1).alias("schemaVersion"), label.alias("label"), message.alias("message"), colour.alias("color")))
