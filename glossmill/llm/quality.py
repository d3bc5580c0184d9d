"""Per-document text quality statistics, and which texts are natural prose.

Each text is read once. Basic counts are taken, lines (and, in texts of one line, its pieces) are told apart by their
shape into prose, list, table and junk, and two distributions are counted: of function words and of character classes.
Their profiles of prose per language are sums over all documents' lines of prose shape, which the same pass makes. Then
both distributions of each text are compared with its language's profile by Jensen-Shannon divergence, and the text
gets the nearest structural profile in the space of its shares of lines, its divergences and its repetition.

The structural profiles are centres that begin at SEEDS. Those of lists, tables and junk are fitted to the data: of all
documents, the ones that are clearly nearest to a centre move it to the mean of them and of its seed, which counts as
PRIOR documents and a share of all at least, until nothing changes or ROUNDS are over. Each round sums up the coordinates
where they are, as whole numbers, so that neither order nor partitions matter. Prose, to which most texts belong, stays
where it is: its centre fitted as well would move every border with it.

Defined cases: null, empty and blank texts have counts of zero, null ratios and no profile, and are no cases; all
texts are read whole; the language is the one whose function words fit best, so that a null or wrong ``lang``
doesn't matter; documents without any known function word are compared with the first language's profile.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut

LANGUAGES = ("en", "de", "fr", "es")
KINDS = ("prose", "list", "table", "junk")
CLASSES = ("lower", "upper", "digit", "space", "stop", "quote", "hyphen", "bracket", "cell", "other")
PRIOR = 200  # documents that a profile's seed counts for, at least
PRIOR_SHARE = 0.01  # and of all documents: else seeds would fade, and centres go together, as a table grows
CLEAR = 0.5  # a text is clearly a centre's if its squared distance is below this share of that to the next one
ROUNDS = 20
UNIT = 1 << 30  # coordinates are summed up as multiples of 1 / UNIT

# Characters of the classes that aren't told by Unicode alone.
_SIGNS = {4: ".,;:!?…", 5: "'\"“”‘’«»„", 6: "-–—", 7: "()", 8: "|\t<>{}=[]/\\_^~#*+@$%&§¿"}


@lru_cache(1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each code point, and whether it is a letter (1) or a capital (2)."""
    classes, marks = np.full(0x110000, 9, np.uint8), np.zeros(0x110000, np.uint8)
    for i in range(0x32400):  # there are no letters, digits or blanks beyond
        c = chr(i)
        if c.isupper():
            marks[i] = 2
        if c.isalpha():
            classes[i] = 0 if c.islower() else 1
            marks[i] |= 1
        elif c.islower() or c.isupper():
            classes[i] = 0 if c.islower() else 1
        elif c.isdigit():
            classes[i] = 2
        elif c.isspace():
            classes[i] = 3
    for k, signs in _SIGNS.items():
        for c in signs:
            classes[ord(c)] = k
    return classes, marks


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_LINES = re.compile(r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")
_MARK = re.compile(r"^\s*(?:[-*+•‣▪◦·–—○●■□✓✗►]\s+|\(?\d{1,4}[.):]\s+|\(?[a-zA-Z][.)]\s+|\(?[ivxlcIVXLC]{1,6}[.)]\s+|\[[ xX✓]?\]\s+|#\d+\s|(?:chapter|chapitre|kapitel|capítulo|part|step|item|no|day|level|section|act|scene|vol|volume|episode|task|rule|question)\.?\s+(?:\d+|[ivxlc]+)\s*[:.)–-]\s*)", re.I)
_ENDS = re.compile(r"[.!?…][\"”’»')\]*_]*\s*(?:\[\d+\]\s*)*(?:[\U0001F300-\U0001FAFF\u2600-\u27BF\uFE0F\u200D\s]+|[:;<][-^]?[\w)(/|3]|\^\^)?\s*$")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"”’»')\]]*\s+")
_CELLS = (re.compile(r"\|\|?"), re.compile(r"(?<![.!?…”’\"»)] )(?<![.!?…”’\"»)])\t"), re.compile(r"[│┃]"), re.compile(r"(?<=\S) {3,}(?=\S)"), re.compile(r";(?!\s*$)"), re.compile(r",(?=\S)"))
_SPECIAL = re.compile(r"<\|[^|<>\s]*\|>")
_BOND = frozenset("and so for oh o but we us me our my i und denn ach wir uns ich mich mein et car nous je mon ô y pues nosotros yo mi nos".split())
_OPENER = frozenset("and so for oh o but und denn ach doch et car ô mais y pues pero".split())


class Line:
    """A line with its words in lower case and what the whole batch's pass over code points counted in it."""

    __slots__ = ("text", "words", "known", "solid", "letters", "ends")

    def __init__(self, text: str, low: str, common: frozenset[str], solid: int, letters: int):
        self.text, self.solid, self.letters = text, solid, letters
        self.words = _WORD.findall(low)
        self.known = sum(map(common.__contains__, self.words))
        # nothing that may follow a stop is one, so only the last can be at the end
        self.ends = (at := max(map(text.rfind, ".!?…"))) >= 0 and _ENDS.match(text, at) is not None


def lines_of(texts: list[str], common: frozenset[str]) -> list[list[Line]]:
    """For each text its lines that aren't blank."""
    parts = [[x for x in _LINES.split(t) if x.strip()] for t in texts]
    flat = [x for p in parts for x in p]
    if not flat:
        return [[] for _ in parts]
    classes, marks = _classes()
    points = _points("".join(flat))
    begins = np.cumsum([0, *map(len, flat[:-1])])
    space = (classes[points] == 3) | (points == 9)
    sizes = (np.add.reduceat(x.astype(np.int64), begins).tolist() for x in (~space, (marks[points] & 1) > 0))
    made = iter([Line(x, x.lower(), common, *n) for x, *n in zip(flat, *sizes)])
    return [[next(made) for _ in p] for p in parts]


def _junk(line: Line) -> bool:
    """Whether a line is no wording at all: mostly symbols and numbers."""
    if line.letters < 0.55 * line.solid and not (line.words and line.ends and line.letters >= 0.45 * line.solid):
        return True
    return not line.words


# A sign without which a line has no cells of the kind.
_SIGN_OF = ("|", "\t", "│┃", "   ", ";", ",")


def _cells(line: str) -> tuple[int, int]:
    """The separator that a line has most of, and how many."""
    if "<|" in line:
        line = _SPECIAL.sub("", line)
    best = (-1, 0)
    for i, p in enumerate(_CELLS):
        if i == 2 and ("│" in line or "┃" in line) or i != 2 and _SIGN_OF[i] in line:
            n = len(p.findall(line))
            if n > best[1]:
                best = (i, n)
    return best


def _verse_like(w: list[str]) -> bool:
    """Whether a line without an end is bound to others as lines of verse are: it opens with a conjunction or speaks
    in the first person."""
    return bool(w) and (w[0] in _OPENER or any(x in _BOND and x not in _OPENER for x in w))


def _items(line: Line) -> bool:
    """Whether a line is short items one after the other, with a full stop at most at its end."""
    if line.known >= 0.15 * len(line.words):
        return False
    pieces = [p for p in re.split(r"[,;]\s+", line.text) if p.strip()]
    return len(pieces) >= 4 and len(line.words) <= 4 * len(pieces) and not _SENTENCE.search(line.text.rstrip())


def shapes(lines: list[Line]) -> list[str]:
    """prose, list, table or junk for each line of a text."""
    n = len(lines)
    cells = [_cells(x.text) for x in lines]
    same = Counter(cells)
    kinds: list[str] = []
    open_lines: list[int] = []  # unmarked, without an end: verse, items or headings
    for i, line in enumerate(lines):
        separator, count = cells[i]
        regular = same[cells[i]] >= max(3, 0.5 * n) and not (line.ends and separator >= 4) and (separator != 4 or not line.text.rstrip().endswith(";"))
        if count and (regular or separator in (0, 1, 2) and count >= 2 or separator == 3 and count >= 3):
            kinds.append("table")
        elif _junk(line):
            kinds.append("junk")
        elif _MARK.match(line.text):
            kinds.append("list")
        elif line.ends:
            wordy = len(line.words) >= 5 or line.known >= 0.3 * len(line.words) and len(line.words) >= 2
            kinds.append("prose" if wordy and not _items(line) else "list")
        else:
            kinds.append("open")
            open_lines.append(i)
    if open_lines:
        m = len(open_lines)
        bound = sum(_verse_like(lines[i].words) for i in open_lines)
        lengths = [len(lines[i].words) for i in open_lines]
        verse = m >= 2 and bound >= 0.2 * m and sum(lengths) >= 6 * m and max(lengths) <= 24
        for i in open_lines:
            kinds[i] = "prose" if verse else _open_shape(lines[i], m <= max(1, 0.34 * n))
    return kinds


def _open_shape(line: Line, few: bool) -> str:
    """The shape of a line without an end, by whether it is one of few in its text."""
    n_words = len(line.words)
    if n_words >= 6 and line.known >= 0.15 * n_words and _SENTENCE.search(line.text.strip()):
        return "prose"
    if n_words >= 20 and not re.search(r"[.!?;:,…]", line.text):
        return "junk"  # words without any sentence
    return "prose" if few and n_words >= 4 and line.known >= 0.2 * n_words else "list"


def moving_variety(words: list[list[str]], window: int = 50) -> np.ndarray:
    """For each text the mean share of distinct words in windows; of the whole where it is shorter, 1 without words.

    A word is new in the windows that hold it and not the equal word before it, so a window's distinct words are
    counted from where each word stood last, without moving the window.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    if not sizes.sum():
        return np.ones(len(words))
    code = pa.array([w for t in words for w in t], pa.string()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    whose = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((at, code, whose))
    before = np.full(len(code), -1)
    equal = (code[order[1:]] == code[order[:-1]]) & (whose[order[1:]] == whose[order[:-1]])
    before[order[1:][equal]] = at[order[:-1][equal]]
    wide = np.minimum(window, sizes)
    windows = np.maximum(sizes - wide, 0)  # the last one's begin
    new = np.minimum(at, windows[whose]) - np.maximum(before + 1, np.maximum(at - wide[whose] + 1, 0)) + 1
    distinct = np.bincount(whose, np.maximum(new, 0), len(words))
    return np.where(sizes > 0, distinct / np.maximum((windows + 1) * wide, 1), 1.0)


class Lexicon:
    """Function words of the languages, by rank."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        by = {k: [w for _, w in sorted((r, w.lower()) for lang, w, r in rows if lang == k and w)] for k in LANGUAGES}
        self.at = {k: {w: i for i, w in enumerate(v)} for k, v in by.items()}
        self.langs = {w: [i for i, k in enumerate(LANGUAGES) if w in self.at[k]] for v in by.values() for w in v}
        self.all = frozenset(self.langs)
        self.size = max([1, *(len(v) for v in by.values())]) + 1

    def best(self, counts: dict[str, int]) -> str:
        """The language whose words are the most; the first of equal ones."""
        sums = [0] * len(LANGUAGES)
        for w, n in counts.items():
            for i in self.langs[w]:
                sums[i] += n
        return LANGUAGES[sums.index(max(sums))]

    def vector(self, lang: str, counts: dict[str, int], total: int) -> list[int]:
        """Counts of each function word of a language, and of all other words."""
        out, at = [0] * self.size, self.at[lang]
        for w, n in counts.items():
            if (i := at.get(w)) is not None:
                out[i] = n
        out[-1] = total - sum(out)
        return out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence in bits of the rows of two arrays of counts; 1 where one has none."""
    a, b = p.sum(-1, keepdims=True), q.sum(-1, keepdims=True)
    p, q = p / np.where(a > 0, a, 1), q / np.where(b > 0, b, 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        both = np.where(p > 0, p * np.log2(p / m), 0.0) + np.where(q > 0, q * np.log2(q / m), 0.0)
    return np.where((a > 0)[..., 0] & (b > 0)[..., 0], np.maximum(0.0, both.sum(-1) / 2), 1.0)


def class_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the characters of each class, its capitals and its tabs."""
    classes, marks = _classes()
    points = _points("".join(texts))
    whose = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    counts = np.bincount(whose * len(CLASSES) + classes[points], minlength=len(texts) * len(CLASSES)).reshape(-1, len(CLASSES))
    of = lambda x: np.bincount(whose[x], minlength=len(texts))
    return counts, of((marks[points] & 2) > 0), of(points == 9)


_MEASURED = "doc_id bigint, of string, n_chars_read bigint, n_words bigint, n_lines bigint, letters_in_words bigint, solid bigint, symbols bigint, n_ended bigint, n_known bigint, variety double, capitals double, best_lang string, shares array<double>, words array<bigint>, classes array<bigint>"
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "array<double>": pa.list_(pa.float64()), "array<bigint>": pa.list_(pa.int64())}
_COLUMNS = [(x.split()[0], _ARROW[x.split()[1]]) for x in _MEASURED.split(", ")]
AT_ONCE = 2_000_000  # characters that are measured at once


def _stretches(ids: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > AT_ONCE:
            yield ids[begin:i], texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield ids[begin:], texts[begin:]


def _measure(lexicon: Lexicon):
    """Counts of each text (``of`` is doc), and after a partition's texts the sums over lines of prose shape per language."""

    def rows_of(ids: list, texts: list[str], prose_words: dict[str, np.ndarray], prose_classes: dict[str, np.ndarray]) -> list[tuple]:
        lines = lines_of(texts, lexicon.all)
        chars, capitals, tabs = (x.tolist() for x in class_counts(texts))
        words = [[w for x in each for w in x.words] for each in lines]
        variety = moving_variety(words)
        out, prose_lines, prose_langs = [], [], []
        for i, (key, each, mine) in enumerate(zip(ids, lines, words)):
            counts = Counter(filter(lexicon.all.__contains__, mine))
            n = len(mine)
            lang = lexicon.best(counts) if n else None
            size, prose = dict.fromkeys(KINDS, 0), []
            for line, kind in zip(each, shapes(each)):
                size[kind] += len(line.text.strip())
                if kind == "prose" and line.ends:
                    prose.append(line)
            if prose:
                told = counts if len(prose) == len(each) else Counter(w for x in prose for w in x.words if w in lexicon.all)
                total = sum(len(x.words) for x in prose)
                if total:
                    best = lexicon.best(told)
                    prose_words[best] += lexicon.vector(best, told, total)
                    prose_lines.append("\n".join(x.text for x in prose))
                    prose_langs.append(best)
            total = sum(size.values()) or 1
            c = chars[i]
            letters = sum(x.letters for x in each)
            solid = sum(x.solid for x in each)
            symbols = sum(c[4:]) - tabs[i]
            blank = not each
            out.append((
                key, "doc", len(texts[i]), n, len(each), sum(map(len, mine)), solid, symbols, sum(x.ends for x in each), sum(counts.values()), float(variety[i]),
                capitals[i] / letters if letters else 0.0, lang, None if blank else [size[k] / total for k in KINDS],
                None if blank else lexicon.vector(lang if counts else "en", counts, n), None if blank else c,
            ))
        if prose_lines:
            for lang, c in zip(prose_langs, class_counts(prose_lines)[0]):
                prose_classes[lang] += c
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _COLUMNS)], names=[k for k, _ in _COLUMNS])
        words = {k: np.zeros(lexicon.size, np.int64) for k in LANGUAGES}
        classes = {k: np.zeros(len(CLASSES), np.int64) for k in LANGUAGES}
        for batch in batches:
            for ids, texts in _stretches(batch["doc_id"].to_pylist(), [t or "" for t in batch["text"].to_pylist()]):
                yield made(rows_of(ids, texts, words, classes))
        none = (None,) * (len(_COLUMNS) - 6)
        yield made([(None, "prose", *none, k, None, words[k].tolist(), classes[k].tolist()) for k in LANGUAGES])

    return run


# Structural profiles before they are fitted: shares of prose, list, table and junk lines by characters, divergence of
# function words and of character classes from prose, and variety of words.
SEEDS = {
    "prose": (0.95, 0.02, 0.01, 0.02, 0.12, 0.02, 0.75),
    "prose with an insertion": (0.62, 0.19, 0.14, 0.05, 0.15, 0.04, 0.72),
    "list": (0.05, 0.92, 0.02, 0.01, 0.35, 0.06, 0.80),
    "list with an introduction": (0.35, 0.63, 0.01, 0.01, 0.25, 0.05, 0.75),
    "table": (0.03, 0.03, 0.92, 0.02, 0.50, 0.15, 0.75),
    "table with an introduction": (0.35, 0.01, 0.63, 0.01, 0.30, 0.10, 0.75),
    "junk": (0.02, 0.02, 0.03, 0.93, 0.70, 0.35, 0.70),
    "junk with an introduction": (0.35, 0.01, 0.01, 0.63, 0.45, 0.15, 0.70),
    "slogans": (1.00, 0.00, 0.00, 0.00, 0.22, 0.03, 0.05),
    "slogans in lines": (0.00, 1.00, 0.00, 0.00, 0.22, 0.03, 0.05),
    "function words alone": (1.00, 0.00, 0.00, 0.00, 0.45, 0.03, 0.65),
}
_WEIGHTS = np.array([1.0, 1.0, 1.0, 1.0, 1.0, 0.5, 1.5])
_NAMES = list(SEEDS)
_KIND = {"prose": "prose", "prose with an insertion": "prose", "list": "list", "list with an introduction": "list", "table": "table", "table with an introduction": "table"}

STATS = "n_chars_read bigint, n_words bigint, n_lines bigint, mean_word_length double, symbol_ratio double, punctuated_line_share double, common_word_share double, word_variety double, best_lang string, word_divergence double, class_divergence double, prose_share double, list_share double, table_share double, junk_share double, profile string"
_PLACED = STATS.replace("profile string", "varied double")
_PLACE = (*(f"{k}_share" for k in KINDS), "word_divergence", "class_divergence", "varied")  # a text's coordinates


_LISTS = ("shares", "words", "classes")


def _rows_of(lists: pa.Array) -> np.ndarray:
    """Lists of one length, without nulls, as rows."""
    flat = lists.drop_null().flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(lists) - lists.null_count, -1)


def distances(places: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all texts from each centre."""
    out = np.zeros((len(centres), len(places)))
    for weight, of_centres, of_texts in zip(_WEIGHTS, centres.T, places.T):
        out += weight * (of_centres[:, None] - of_texts) ** 2
    return out


def clear_sums(places: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For each centre the number of texts that are clearly its own, and the sums of their coordinates in UNITs; the last
    row has those that are clearly no one's."""
    far = distances(places, centres)
    first, second = np.partition(far, 1, axis=0)[:2]
    at, k = np.where(first < CLEAR * second, far.argmin(0), len(centres)), len(centres) + 1
    units = np.rint(places * UNIT)  # their sums are exact for 2^22 texts at once and more
    return np.stack([np.bincount(at, minlength=k), *(np.bincount(at, x, k) for x in units.T)], 1).astype(np.int64)


def clear_sums_of(placed: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The same of a table of coordinates; to the driver comes one row for each centre."""
    shape = len(centres) + 1, len(_PLACE) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape, np.int64)
        for batch in batches:
            out += clear_sums(np.column_stack([batch[k].to_numpy() for k in _PLACE]), centres)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(out)), pa.int64()), *map(pa.array, out.T)], names=["centre", "n", *_PLACE])

    rows = placed.select(*_PLACE).mapInArrow(run, ", ".join(f"{k} bigint" for k in ("centre", "n", *_PLACE)))
    sums = [F.sum(F.col(k).cast("decimal(19,0)")) for k in ("n", *_PLACE)]
    out = np.zeros(shape)
    for centre, *values in rows.groupBy("centre").agg(*sums).collect():
        out[centre] = [float(x) for x in values]
    return out


class Profiles:
    """Prose profiles of the languages, and the structural centres."""

    def __init__(self, words: dict[str, np.ndarray], classes: dict[str, np.ndarray]):
        self.words, self.classes = words, classes
        self.centres = np.array([SEEDS[k] for k in _NAMES])

    def places(self, rows: dict[str, list]) -> np.ndarray:
        """Coordinates of texts that aren't blank, from what was measured."""
        near = [lang if known else "en" for lang, known in zip(rows["best_lang"], rows["n_known"])]
        words = np.stack([self.words[k] for k in near]).astype(float)
        # some of the profile is added to the counts, so that short texts are not far from it by chance
        own = rows["words"] + 8 * words / np.maximum(words.sum(1, keepdims=True), 1)
        wd = divergence(own, words)
        cd = divergence(rows["classes"], np.stack([self.classes[k] for k in near]).astype(float))
        # repeated sentences have capitals, repeated slogans and menus hardly
        capitals = np.array(rows["capitals"])
        varied = np.array(rows["variety"]) + np.where((capitals > 0.005) & (capitals < 0.6), 0.1, -0.1)
        varied = np.where(np.array(rows["n_words"]) >= 30, varied, np.maximum(varied, 0.7))
        return np.column_stack([rows["shares"], wd, cd, varied])

    def fit(self, places, clear=clear_sums) -> None:
        """Centres other than prose's as means of the texts that are clearly theirs and of their seeds; ``clear`` sums up
        what ``places`` holds."""
        seeds, free = self.centres.copy(), np.array([_KIND.get(k) != "prose" for k in _NAMES])
        for _ in range(ROUNDS):
            found = clear(places, self.centres)
            n, sums, prior = found[:-1, :1], found[:-1, 1:] / UNIT, max(PRIOR, PRIOR_SHARE * found[:, 0].sum())
            before, self.centres = self.centres, np.where(free[:, None], (prior * seeds + sums) / (prior + n), seeds)
            if np.allclose(before, self.centres):
                break


def _place(profiles: Profiles):
    fields = [(f.split()[0], _ARROW[f.split()[1]]) for f in _PLACED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = {k: batch[k].to_pylist() for k in batch.schema.names if k not in _LISTS}
            full = np.flatnonzero(batch["shares"].is_valid().to_numpy(zero_copy_only=False)).tolist()
            out = {k: [None] * len(batch) for k, _ in fields} | {k: rows[k] for k in ("n_chars_read", "n_words", "n_lines")}
            if full:
                some = {k: [rows[k][i] for i in full] for k in rows} | {k: _rows_of(batch[k]) for k in _LISTS}
                places = profiles.places(some)
                ratio = lambda a, b: [x / y if y else None for x, y in zip(some[a], some[b])]
                found = {
                    "mean_word_length": ratio("letters_in_words", "n_words"), "symbol_ratio": ratio("symbols", "solid"), "punctuated_line_share": ratio("n_ended", "n_lines"),
                    "common_word_share": ratio("n_known", "n_words"), "word_variety": [v if n else None for v, n in zip(some["variety"], some["n_words"])], "best_lang": some["best_lang"],
                    "word_divergence": places[:, 4].tolist(), "class_divergence": places[:, 5].tolist(), "varied": places[:, 6].tolist(),
                } | {f"{k}_share": some["shares"][:, j].tolist() for j, k in enumerate(KINDS)}
                for k, values in found.items():
                    for i, v in zip(full, values):
                        out[k][i] = v
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(out[k], t) for k, t in fields)], names=["doc_id", *(k for k, _ in fields)])

    return run


def _nearest(centres: np.ndarray):
    """The profile of texts by their coordinates; none without them."""
    names = np.array([_KIND.get(k, "junk") for k in _NAMES], object)

    def run(*columns: pa.Array) -> pa.Array:
        full = columns[-1].is_valid().to_numpy(zero_copy_only=False)
        places = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])[full]
        out = np.full(len(full), None, object)
        out[full] = names[distances(places, centres).argmin(0)]
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")


def quality(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """(doc_id, statistics, profile) of each document.

    To the driver come the word list (a fixed table), the profiles (four languages by its length), and each round's
    sums for the centres.
    """
    lexicon = Lexicon([tuple(r) for r in common_words.where(F.col("lang").isin(*LANGUAGES) & F.col("word").isNotNull()).select("lang", "word", "freq_rank").collect()])
    measured = cut(documents.select("doc_id", "text").mapInArrow(_measure(lexicon), _MEASURED), "measured")
    docs = measured.where("of = 'doc'")
    words = {k: np.zeros(lexicon.size) for k in LANGUAGES}
    classes = {k: np.zeros(len(CLASSES)) for k in LANGUAGES}
    for part, into in (("words", words), ("classes", classes)):
        sums = measured.where("of = 'prose'").select("best_lang", F.posexplode(part).alias("slot", "n")).groupBy("best_lang", "slot").agg(F.sum("n"))
        for lang, slot, n in sums.collect():
            into[lang][slot] = n
    profiles = Profiles(words, classes)
    placed = cut(docs.drop("of").mapInArrow(_place(profiles), f"doc_id bigint, {_PLACED}"), "placed")
    profiles.fit(placed.where("varied IS NOT NULL"), clear_sums_of)
    return placed.withColumn("profile", _nearest(profiles.centres)(*_PLACE)).drop("varied")


def not_prose(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """(doc_id) of documents that are mostly no natural prose."""
    return quality(documents, common_words).where("profile <> 'prose'").select("doc_id")


def quality_report(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """Per source and profile: documents and words."""
    q = cut(quality(documents, common_words).select("doc_id", "profile", "n_words"), "quality")
    return q.join(documents.select("doc_id", "source"), "doc_id").groupBy("source", "profile").agg(F.count("*").alias("n_docs"), F.sum("n_words").alias("n_words"))
