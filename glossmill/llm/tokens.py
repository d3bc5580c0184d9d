"""Encoding of texts with a public byte-level BPE tokenizer.

Pre-tokenisation is vectorised over a whole Arrow batch. All texts become one array of code points, a table
gives each its class, shifts give what little look-ahead the pattern needs, and each symbol is a transition
function on the eight states of the scanner. Composition of such functions is associative: they are composed
inside blocks (for all blocks at once), the blocks' functions are scanned by doubling, and each position's
state follows. A start flag per position is then one table look-up; no regular expression is run. The slices
feed pair merging with a cache per worker. Offsets are kept, so ids decode to exact slices of the text.

Defined cases: the ids of an empty and of a null text are the empty list; strings that look like special
tokens are ordinary text; a lone surrogate can't occur in Arrow strings.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_50k"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public tokenizer's ranks; ``name`` may be a path itself."""
    if "/" in name:
        return name
    try:
        import public_tokenizers

        return public_tokenizers.path(f"{name}.tiktoken")
    except ImportError:
        return f"/opt/tokenizers/{name}.tiktoken"


# Classes of code points
LETTER, NUMBER, OTHER, QUOTE, BLANK, SPACE = range(6)
# Symbols: what the scanner reads. Look-ahead is part of a symbol.
S_LETTER, S_NUMBER, S_OTHER, S_CUT2, S_CUT3, S_LAST_BLANK, S_LAST_SPACE, S_MID_SPACE = range(8)
# States: what came before a position
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, HELD, IN_SPACE, TAIL2, TAIL1 = range(8)


def _scanner() -> tuple[np.ndarray, np.ndarray]:
    """next_state[symbol, state] and starts[symbol, state]."""
    go, start = np.zeros((8, 8), np.uint8), np.zeros((8, 8), bool)
    opens = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS, S_CUT2: TAIL1, S_CUT3: TAIL2, S_LAST_BLANK: HELD, S_LAST_SPACE: FREE, S_MID_SPACE: IN_SPACE}
    for symbol, state in opens.items():
        go[symbol], start[symbol] = state, True
    runs = [(S_LETTER, IN_LETTERS, IN_LETTERS), (S_NUMBER, IN_NUMBERS, IN_NUMBERS), (S_MID_SPACE, IN_SPACE, IN_SPACE)]
    runs += [(S_LETTER, HELD, IN_LETTERS), (S_NUMBER, HELD, IN_NUMBERS)]
    runs += [(s, before, IN_OTHERS) for s in (S_OTHER, S_CUT2, S_CUT3) for before in (IN_OTHERS, HELD)]
    runs += [(s, TAIL2, TAIL1) for s in range(8)] + [(s, TAIL1, FREE) for s in range(8)]
    for symbol, before, state in runs:
        go[symbol, before], start[symbol, before] = state, False
    return go, start


GO, START = _scanner()


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of each code point, from the Unicode database."""
    table = np.full(0x110000, OTHER, np.uint8)
    spaces = {*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
    table[list(spaces)] = SPACE
    table[0x20], table[0x27] = BLANK, QUOTE
    return table


def _symbols(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Symbol of each position; ``firsts`` are the positions where texts begin."""
    kind = _classes()[points]
    n = len(points)
    last = np.zeros(n + 1, bool)
    last[firsts] = True
    last[n] = True
    ends = last[1:]  # a text's last character
    after = np.append(kind[1:], np.uint8(OTHER))
    out = np.array([S_LETTER, S_NUMBER, S_OTHER, S_OTHER, S_LAST_BLANK, S_LAST_SPACE], np.uint8)[kind]
    white = kind >= BLANK
    out[white & (ends | (after >= BLANK))] = S_MID_SPACE
    at = np.flatnonzero(kind == QUOTE)
    if len(at):
        text_of = np.searchsorted(firsts, at, side="right")
        stop = np.append(firsts, n)[text_of]  # where the text of each quote ends
        one = np.where(at + 1 < stop, points[np.minimum(at + 1, n - 1)], 0)
        two = np.where(at + 2 < stop, points[np.minimum(at + 2, n - 1)], 0)
        out[at[np.isin(one, [ord(c) for c in "stmd"])]] = S_CUT2
        pairs = one.astype(np.int64) * 0x110000 + two
        out[at[np.isin(pairs, [ord(a) * 0x110000 + ord(b) for a, b in ("re", "ve", "ll")])]] = S_CUT3
    return out


def _states(symbols: np.ndarray, firsts: np.ndarray, block: int = 64) -> np.ndarray:
    """State before each position by an associative scan of the symbols' transition functions."""
    n = len(symbols)
    blocks = -(-n // block)
    step = np.broadcast_to(np.arange(8, dtype=np.uint8), (blocks * block, 8)).copy()
    step[:n] = GO[symbols]
    step[firsts] = GO[symbols[firsts], FREE][:, None]  # a text's first character forgets what came before
    step = step.reshape(blocks, block, 8)
    for j in range(1, block):  # compose inside all blocks at once
        step[:, j] = np.take_along_axis(step[:, j], step[:, j - 1].astype(np.intp), 1)
    whole, reach = step[:, -1].copy(), 1
    while reach < blocks:  # doubling over the blocks
        whole[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), 1)
        reach *= 2
    enter = np.concatenate([[FREE], whole[:-1, FREE]]).astype(np.intp)
    after = np.take_along_axis(step, enter[:, None, None], 2)[:, :, 0].reshape(-1)[:n]
    before = np.empty(n, np.uint8)
    before[1:] = after[:-1]
    before[:1] = FREE
    before[firsts] = FREE
    return before


def slices(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts as one string, the positions where slices begin, and for each text its first slice (and the end)."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    firsts = begins[sizes > 0]
    if not len(points):
        return joined, np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    symbols = _symbols(points, firsts)
    starts = np.flatnonzero(START[symbols, _states(symbols, firsts)])
    return joined, starts, np.searchsorted(starts, np.append(begins, len(points)))


class Encoder:
    """Pair merging over the ranks of a public vocabulary, with a cache of slices."""

    CACHE = 1 << 18  # slices kept; a full cache is emptied, results don't depend on it

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Ids of one slice: the adjacent pair of the lowest rank is merged first, the leftmost of equal ones."""
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return (whole,)
        n = len(data)
        right, left, size = [*range(1, n), -1], [*range(-1, n - 1)], [1] * n
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, length = heapq.heappop(heap)
            if not size[i] or (j := right[i]) < 0 or size[i] + size[j] != length:
                continue  # one of the two was merged meanwhile
            size[i], size[j], right[i] = length, 0, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            if (k := right[i]) >= 0 and (r := ranks.get(data[i : k + size[k]])) is not None:
                heapq.heappush(heap, (r, i, length + size[k]))
            if (k := left[i]) >= 0 and (r := ranks.get(data[k : i + length])) is not None:
                heapq.heappush(heap, (r, k, size[k] + length))
        out, i = [], 0
        while i >= 0:
            out.append(ranks[data[i : i + size[i]]])
            i = right[i]
        return tuple(out)

    def ids_of(self, piece: str) -> tuple[int, ...]:
        if (found := self.cache.get(piece)) is None:
            if len(self.cache) >= self.CACHE:
                self.cache.clear()
            found = self.merge(piece.encode())
            if len(piece) <= 256:
                self.cache[piece] = found
        return found

    def encode(self, texts: list[str]) -> list[list[tuple[int, ...]]]:
        """For each text the ids of each of its slices."""
        joined, starts, first = slices(texts)
        cuts = [*starts.tolist(), len(joined)]
        ids_of = self.ids_of
        done = [ids_of(joined[a:b]) for a, b in zip(cuts, cuts[1:])]
        bounds = first.tolist()
        return [done[a:b] for a, b in zip(bounds, bounds[1:])]


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


#: Characters that are scanned at once; longer batches are cut between texts.
STRETCH = 1 << 20


def _stretches(texts: list[str]):
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > STRETCH:
            yield texts[begin:i]
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield texts[begin:]


def _lists(values, sizes, kind) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _ids(path: str):
    def run(texts: pa.Array) -> pa.Array:
        flat, sizes = [], []
        for part in _stretches([x or "" for x in texts.to_pylist()]):
            for pieces in encoder(path).encode(part):
                before = len(flat)
                for p in pieces:
                    flat.extend(p)
                sizes.append(len(flat) - before)
        return _lists(flat, sizes, pa.int32())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, T.ArrayType(T.IntegerType(), False))


def _counts(path: str):
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for part in _stretches([x or "" for x in texts.to_pylist()]):
            out.extend(sum(map(len, pieces)) for pieces in encoder(path).encode(part))
        return pa.array(out, pa.int64())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, T.LongType())


def _spans(path: str):
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("begins", pa.list_(pa.int32()))])

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for part in _stretches([x or "" for x in texts.to_pylist()]):
            for text, pieces in zip(part, encoder(path).encode(part)):
                ids, begins, at = [], [], 0
                lengths = _token_lengths(path)
                for p in pieces:
                    for i in p:
                        ids.append(i)
                        begins.append(at)
                        at += lengths[i]
                out.append({"ids": ids, "begins": begins})
        return pa.array(out, kind)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("begins", T.ArrayType(T.IntegerType()))]))


@lru_cache(4)
def _token_lengths(path: str) -> dict[int, int]:
    return {i: len(b) for b, i in encoder(path).ranks.items()}


def _decoded(path: str):
    def run(ids: pa.Array) -> pa.Array:
        table = {i: b for b, i in encoder(path).ranks.items()}
        return pa.array([None if x is None else b"".join(table[i] for i in x).decode("utf-8", "replace") for x in ids.to_pylist()], pa.string())

    run.__annotations__ = {"ids": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, T.StringType())


def token_ids(documents: DataFrame, tokenizer: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of each document."""
    return documents.select("doc_id", _ids(vocabulary_path(tokenizer))("text").alias("ids"))


def token_counts(documents: DataFrame, tokenizer: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of each document."""
    return documents.select("doc_id", _counts(vocabulary_path(tokenizer))("text").alias("n_tokens"))


def token_spans(documents: DataFrame, tokenizer: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, begins): with each id the UTF-8 byte of the text where it begins."""
    return documents.select("doc_id", _spans(vocabulary_path(tokenizer))("text").alias("s")).select("doc_id", "s.ids", "s.begins")


def decoded(ids: DataFrame, tokenizer: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) back from ids."""
    return ids.select("doc_id", _decoded(vocabulary_path(tokenizer))("ids").alias("text"))


def round_trip(documents: DataFrame, tokenizer: str = VOCABULARY) -> DataFrame:
    """Per language: documents, tokens, and documents that don't decode to themselves (none)."""
    ids = documents.select("lang", F.coalesce("text", F.lit("")).alias("text"), _ids(vocabulary_path(tokenizer))("text").alias("ids"))
    back = ids.select("lang", F.size("ids").alias("n"), (_decoded(vocabulary_path(tokenizer))("ids") != F.col("text")).alias("bad"))
    return back.groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_tokens"), F.count_if("bad").alias("n_bad"))
