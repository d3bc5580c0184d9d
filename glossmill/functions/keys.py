"""Title keys, case folding and Unicode normalisation.

Two titles are the same if their keys are equal: NFKC, cut at the first ``#``,
underscores to blanks, runs of white space to one blank, trimmed, case folded,
NFKC once more. Spark has no NFKC and its ``lower`` is no case folding, so the
keys are Arrow UDFs; nulls stay null, an empty title has the empty key.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as ``str.split`` sees it.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}]"


def title_key_of(title: str | None) -> str | None:
    """The key of one title (null for null)."""
    if title is None:
        return None
    if title.isascii():  # NFKC leaves ASCII as it is
        return " ".join(title.partition("#")[0].replace("_", " ").split()).lower()
    text = unicodedata.normalize("NFKC", title).partition("#")[0].replace("_", " ")
    return unicodedata.normalize("NFKC", " ".join(text.split()).casefold())


def collapse_of(text: str | None) -> str | None:
    """NFKC and collapsed white space."""
    if text is None:
        return None
    return " ".join((text if text.isascii() else unicodedata.normalize("NFKC", text)).split())


_ENTITY = re.compile(r"&(?:#\d|#[xX]|[A-Za-z])")


def unescape_of(text: str | None) -> str | None:
    """Decoded character references; text without any is returned as it is."""
    if text is None or not _ENTITY.search(text):
        return text
    from html import unescape

    return unescape(text)


def ascii_fold_of(text: str | None) -> str | None:
    """Compatibility decomposition without what is not ASCII."""
    if text is None or text.isascii():
        return text
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def fold_of(text: str | None) -> str | None:
    return None if text is None else text.casefold()


def per_value(function, out=None):
    """An Arrow UDF that applies ``function`` once to each distinct value of a batch."""
    kind = out or pa.string()

    def run(values: pa.Array) -> pa.Array:
        coded = values.dictionary_encode()
        done = [function(x) for x in coded.dictionary.to_pylist()]
        return pa.array([None if i is None else done[i] for i in coded.indices.to_pylist()], kind)

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return run


_title_key = F.arrow_udf(per_value(title_key_of), T.StringType())
_fold = F.arrow_udf(per_value(fold_of), T.StringType())
_collapse = F.arrow_udf(per_value(collapse_of), T.StringType())
_unescape = F.arrow_udf(per_value(unescape_of), T.StringType())
_ascii_fold = F.arrow_udf(per_value(ascii_fold_of), T.StringType())


def title_key(title: Column | str) -> Column:
    return _title_key(F.col(title) if isinstance(title, str) else title)


def fold(text: Column | str) -> Column:
    return _fold(F.col(text) if isinstance(text, str) else text)


def collapse(text: Column | str) -> Column:
    return _collapse(F.col(text) if isinstance(text, str) else text)


def unescape(text: Column | str) -> Column:
    return _unescape(F.col(text) if isinstance(text, str) else text)


def ascii_fold(text: Column | str) -> Column:
    return _ascii_fold(F.col(text) if isinstance(text, str) else text)
