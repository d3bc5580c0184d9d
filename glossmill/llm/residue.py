"""Template residue and error-page text.

The sentences of all texts are masked (numbers, hosts, names) and counted, so that a sentence that a third of all
records hold is one row. They are mined with a fixed-depth prefix tree: the first levels are the number of tokens and
the first tokens, a leaf holds templates, and a sentence joins the template it shares most positions with, where
differing positions become wildcards. Each partition grows its own tree, path by path; the trees are then merged.

Each template is classified once, by evidence. Patterns of wordings are seeds only: they name some sentences as
messages or filler, and from all distinct sentences, named and other, log-odds of tokens and of pairs of neighbours are
learned (naive Bayes over HASHED buckets). A template that no seed names is residue if the log-odds of its constants
are ODDS or more, records with different titles hold it, and no more than VARYING of its positions vary: it says the same
about different subjects in words that residue has and text about a subject has not. A template that a seed names is
residue unless its log-odds are below -ODDS. Seeds of different verdicts never share a template, and a sentence under a
learned template whose own words are more usual in ordinary text stays ordinary, so no wildcard hides a telling word.
Verdicts are propagated to the records by sentence. Unresolved slots inside otherwise ordinary records are found apart
from that, in the records' text. Texts that only send the reader to another title are left out.

Defined cases: null, empty and blank texts are no cases; repeated rows count once; a text of any length is
read whole; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html import unescape
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.orphans import pointer_target
from ..plans.lineage import cut

DEPTH = 3  # tokens of a path after the number of tokens
SIMILAR = 0.6  # least share of equal positions for a sentence to join a template
WILD = "<*>"
HASHED = 1 << 18  # buckets of tokens and pairs; what reaches the driver is bounded by them
ODDS = 5.0  # log-odds from which a template that no seed names is residue
VARYING = 0.25  # share of wildcards that such a template may have
SMOOTH = 2.0  # sentences of both kinds in proportion that each bucket counts besides those seen, so that what is new says nothing

_TAG = re.compile(r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"”’')\]]*\s+|\n+")
_HOST = re.compile(r"^(?:https?://)?[\w-]+(?:\.[\w-]+)*\.(?:example|com|org|net|wiki|io|de|fr|es)\b\S*$", re.I)
_NUMBER = re.compile(r"^[#(]?(?:[\w-]*\d[\w:.,%/-]*)[).,;!?]*$")
_DIGIT = re.compile(r"\d")
_BEFORE, _AFTER = "\"“”‘’'([«»", "\"“”’')].,;:!?»…"  # signs around a word


def plain_of(text: str) -> str:
    """A fragment without its tags and with its character references decoded; ``<b>``-like names of slots stay."""
    return unescape(_TAG.sub("", text)) if "<" in text or "&" in text else text


def masked(sentence: str) -> tuple[str, list[str]]:
    """Path and tokens of a sentence, in lower case. Numbers and hosts are masked, and in the path names too.

    The path is the inner levels of the prefix tree: the number of tokens, then the first tokens.
    """
    words = sentence.split()
    shouted, numbered = sentence.isupper(), not sentence.isascii() or _DIGIT.search(sentence) is not None
    tokens, path = [], [str(len(words))]
    for i, w in enumerate(words):
        if numbered and any(map(str.isdigit, w)) and _NUMBER.match(w):
            token = "<#>"
        elif "." in w and _HOST.match(w):
            token = "<host>"
        else:
            bare = w.lstrip(_BEFORE).rstrip(_AFTER)
            token = bare.casefold() or w
            if 0 < i < DEPTH and not shouted and bare[:1].isupper() and not bare.isupper():
                path.append(WILD)
        tokens.append(token)
        if i < DEPTH and len(path) < i + 2:
            path.append(token)
    return "|".join(path), tokens


class Leaf:
    """Templates of one path: [tokens, number of sentences, least and largest title hash, the seed of all of them]."""

    __slots__ = ("templates",)

    def __init__(self):
        self.templates: list[list] = []

    def add(self, tokens: list[str], n: int = 1, least: int = 0, most: int = 0, seed: str | None = None) -> None:
        best, best_same = None, -1
        for t in self.templates:
            if t[4] != seed:
                continue
            same = sum(map(eq, t[0], tokens))
            if same > best_same:
                best, best_same = t, same
                if same == len(tokens):
                    break
        if best is None or best_same < SIMILAR * len(tokens):
            self.templates.append([tokens, n, least, most, seed])
            return
        best[1:4] = best[1] + n, min(best[2], least), max(best[3], most)
        if best_same < len(tokens):
            best[0] = [a if a == b else WILD for a, b in zip(best[0], tokens)]


# Wording of messages of servers, sites, programs and browser checks, over masked lower-case text.
_SCRIPTS = r"(?:java ?script|js|scripts?|scripting|client[- ]side code|cookies)"
MESSAGES = [re.compile(p) for p in (
    rf"(?:enable|allow|turn on|switch on|activate|activer|aktivieren sie|aktiviere|activar?|active|habilitar?) (?:\w+ )?{_SCRIPTS}\b",
    rf"\b{_SCRIPTS} (?:is |are |was |were |may be |seems? to be |has been |est |ist |está )?(?:turned off|switched off|disabled|blocked|not enabled|required|did not load|failed to load|désactivé|deaktiviert|desactivado)",
    rf"\b(?:needs?|requires?) {_SCRIPTS} (?:to|for)\b|looks like {_SCRIPTS} did|without {_SCRIPTS}\b.*(?:page|site|view)",
    r"browser has \S+ turned off|unsupported browser|browser (?:is|version) (?:not supported|too old|outdated)|update to a newer version|device cannot (?:display|show)|check your ad ?blocker|please (?:update|upgrade) your browser",
    r"^(?:\S+ )?loading\b.*(?:if nothing happens|disabled)",
    r"(?:verifying|checking) (?:that )?(?:your|you are|if the)\b.*(?:browser|connection|human|secure)?|confirm that you are|(?:not a robot|are human to|you are human\b)|tick the box|just a moment\b|captcha|security check",
    r"^(?:\S+ ){0,2}(?:access denied|login required|log-in required|forbidden|unauthori[sz]ed)\b|\b(?:must|need to|have to|please) (?:log|sign) ?in\b|(?:sign|log) in (?:again )?to (?:continue|see|view|read)|session has expired|hidden from guests|(?:register|subscribe) to (?:continue|read|view)",
    r"network has been blocked|address has been blocked|blocked by the (?:owner|administrator)|too many requests|sent too many|rate limit|you have been (?:blocked|banned)|try again (?:in <#>|later|in a few)",
    r"^(?:\S+ ){0,2}(?:error|http status|status|http error|code|erreur|fehler)\b:? (?:code )?<#>|^(?:\S+ )?<#> (?:bad|forbidden|not|gone|too|gateway|internal|service|unauthori|moved|request)|bad gateway|gateway time-?out|service (?:is )?(?:temporarily )?unavailable|internal server error|not found$|^(?:\S+ )?gone$",
    r"server (?:was|is) unable|complete your request|server error|fatal error|uncaught \S+|on line <#>|stack trace|traceback|lua error|script error|parse error|syntax error|attempt to (?:index|call)|(?:database|mysql|sql|connection) error|query failed|connection (?:was|has been) (?:lost|reset|refused)|upstream did not|something (?:broke|went wrong)|unexpected error|exception in",
    r"(?:could not|cannot|can not|couldn't|can't|unable to) (?:find|load|show|display|open|serve) (?:that|this|the|your) (?:page|article|entry|summary|content|site|file)|could not be (?:served|found|loaded|shown|displayed)|address you (?:asked|requested|entered)|(?:page|article|entry|file|link) (?:you \w+ )?(?:may|might|does not|doesn't|no longer|could not|cannot|was not)\b.*(?:broken|removed|exist|found|deleted|moved)|link may be broken|go back to the main page|use the search box",
    r"page est introuvable|n'existe plus|page (?:demandée|introuvable)|seite wurde nicht gefunden|nicht gefunden werden|seite (?:existiert nicht|ist nicht verfügbar)|prüfen sie die adresse|página (?:\w+ )?(?:no existe|no encontrada|no se (?:ha )?enc\w+|no está disponible)|pour afficher cette page|um diese seite zu lesen|para ver esta página|acceso denegado|zugriff verweigert|accès refusé",
    r"scheduled (?:upkeep|maintenance)|(?:upkeep|maintenance) in progress|read-only mode|will be back (?:by|soon|at|shortly)|(?:down|closed|offline) for (?:scheduled )?maintenance$|under maintenance|wartungsarbeiten|vorübergehend nicht erreichbar|nicht erreichbar|maintenance en cours|temporairement indisponible|en mantenimiento|thank you for your patience|while we move servers|temporarily (?:down|offline|unavailable)",
    r"if you are the owner|contact the (?:site |server )?administrator|you (?:do not|don't) have permission|^served by <host>$",
)]
# Wording of filler and of authors' stand-ins.
_STAND_IN = r"(?:sample|dummy|placeholder|filler|example|test|stand-?in|blind|demo)"
_PIECE = r"(?:text|texts|paragraph|copy|sentence|article|description|summary|intro|content|line|entry|page|words)"
FILLERS = [re.compile(p) for p in (
    rf"^(?:(?:an?|the|this|here|is|comes|only|quick|some|just) )*{_STAND_IN} {_PIECE}\b|\b{_STAND_IN} {_PIECE} (?:number|no|so that|goes|here|only|to be|for now)\b|quick {_STAND_IN}",
    r"\b(?:text|copy|summary|description|intro|content|place|name|paragraph|title|definition|\S+) goes here\b|\b(?:will|to) fill (?:it|this) in\b|shows how the layout|not for publication|so that the box is not empty",
    rf"^(?:\S+ ){{0,2}}(?:write|replace|insert|add|enter|type|describe|put|edit) (?:an?|the|this|your|some|here) (?:\w+ )?{_PIECE}\b.*\b(?:here|for|with|of)\b",
    r"^(?:todo|fixme|tbd|tba|xxx)\b|^(?:to be (?:written|added|done|announced|completed)|coming soon|work in progress|under construction)\b",
    r"\bblah,? blah\b|\basdf\b|\bqwer(?:ty)?\b|^test,? test\b|please ignore$",
    r"beispieltext|platzhalter|blindtext|mustertext|texte (?:d'exemple|de remplissage)|faux texte|texto de (?:ejemplo|relleno|prueba)",
)]
# Words of the usual filler text.
LOREM = frozenset("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split())
# Words of sites and programs; several in one short template mark a message.
MACHINE = frozenset("browser javascript server website webpage request error http cookies login password account session expired reload refresh connection url unavailable maintenance loading disabled captcha verify administrator permission unauthorized timeout gateway proxy database query exception plugin cache network address wiki site page retry download upload serveur navigateur seite fehler página navegador servidor".split())
# Names of fields; a short sentence made of them is a form that nobody filled in.
FIELDS = frozenset("name race class place origin reason species subject author profession rank city country date year person character location group hometown faction occupation floor".split())


#: What any pattern needs, for the engine that tries them all at once: word borders left out, words of any signs.
_MAYBE = "|".join(p.pattern.replace(r"\b", "").replace(r"[\w", r"[^\s").replace(r"\w", r"\S") for p in (*FILLERS, *MESSAGES))


def seed_of(tokens: list[str], maybe: bool = True) -> str | None:
    """``message``, ``filler`` or null (no seed names it) for a masked sentence; patterns are tried if ``maybe``."""
    if not LOREM.isdisjoint(tokens) or not FIELDS.isdisjoint(tokens):
        words = [t for t in tokens if t[0].isalpha()]
        lorem, fields = sum(w in LOREM for w in words), sum(w in FIELDS for w in words)
        if lorem >= 4 and lorem >= 0.6 * len(words) or fields >= 4 and fields >= 0.4 * len(words):
            return "filler"
    if maybe and any(t[0].isalpha() for t in tokens):
        text = " ".join(tokens)
        if any(p.search(text) for p in FILLERS):
            return "filler"
        if any(p.search(text) for p in MESSAGES):
            return "message"
    if not MACHINE.isdisjoint(tokens):
        words = [t for t in tokens if t[0].isalpha()]
        machine = sum(w in MACHINE for w in words)
        return "message" if machine >= 3 and machine >= 0.3 * len(words) else None
    return None


def seeds_of(sentences: list[list[str]]) -> list[str | None]:
    maybe = pc.match_substring_regex(pa.array([" ".join(t) for t in sentences], pa.string()), _MAYBE).to_pylist()
    return [seed_of(t, m) for t, m in zip(sentences, maybe)]


# Shapes of unresolved slots in a text without tags.
_NAME = r"[A-Za-z][A-Za-z0-9_.]*"
_LOW = r"[a-z][a-z0-9_.]*"
SLOTS = re.compile("|".join((
    r"\{\{\{?[^{}]*\}\}\}?", r"\{%[^{}]*%\}", r"<%[^<>]*%>", rf"[$#]\{{\s*{_NAME}\s*\}}", rf"\{{{_LOW}\}}",
    rf"@@{_NAME}@@", r"%[A-Z][A-Z0-9_.]{2,}%", r"__[A-Z][A-Z0-9_.]*__", rf"\${_LOW}\$", rf"\[\[{_LOW}\]\]", rf"<{_LOW}>",
    r"\[(?:[a-z][\w.]*|your [\w ]+) here\]", r"\[(?:INSERT|ADD|ENTER|YOUR|TODO|TBD|PLACEHOLDER)\b[^\[\]]*\]", r"\[(?:[Ee]ditor|[Aa]uthor|[Ww]riter|[Nn]ote to \w+): [^\[\]]*\]?", r"\[object \w+\]", r"(?<!\w)(?:X{3,}|Y{3,}|Z{3,})(?!\w)",
)))
_SLOTTY = re.compile(r"[{}%<>@$_\[\]]|XXX|YYY|ZZZ")  # what any slot has
_VOIDS = re.compile(r"(?<!\w)(?:undefined|null|NaN|None|\(none\)|\(null\)|N/A)(?!\w)")


def has_slot(plain: str) -> bool:
    """Whether a text without tags holds an unresolved slot, or values that were never filled."""
    if _SLOTTY.search(plain) and SLOTS.search(plain):
        return True
    return len(_VOIDS.findall(plain)) >= 2


def sentences_of(plain: str) -> Iterator[tuple[str, list[str]]]:
    for s in _SENTENCE.split(plain):
        if s and not s.isspace():
            yield masked(s)


def records(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """(rec_table, rec_id, title, text, url) of all texts that aren't blank."""
    p = pages.select(F.lit("pages").alias("rec_table"), F.col("pageid").alias("rec_id"), "title", F.col("first_paragraph").alias("text"), "url")
    e = entries.select(F.lit("entries").alias("rec_table"), F.col("pos").alias("rec_id"), "title", F.col("definition").alias("text"), "url")
    return p.unionByName(e).where(F.col("rec_id").isNotNull() & (F.trim("text") != "")).dropDuplicates(["rec_table", "rec_id", "text"])


_SENTENCES = "rec_table string, rec_id bigint, title_hash bigint, slot boolean, path string, tokens array<string>"
_COUNTED = "path string, tokens array<string>, n bigint, least bigint, most bigint, seed string, bucket int, message bigint, filler bigint, other bigint"
_TEMPLATES = "path string, tokens array<string>, n bigint, least bigint, most bigint, seed string"
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [x.split() for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _ARROW[kind]) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def _to_sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for kind, key, title, text, pointer in zip(*(batch[c].to_pylist() for c in ("rec_table", "rec_id", "title_hash", "text", "pointer"))):
            plain = plain_of(text)
            if has_slot(plain):
                out.append((kind, key, title, True, None, None))
            elif not pointer:
                out += [(kind, key, title, False, path, tokens) for path, tokens in sentences_of(plain)]
        yield _batch(out, _SENTENCES)


def buckets(sentences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the tokens and of the pairs of neighbours of sentences or templates, and whose they are.

    A begin and an end are neighbours as well; wildcards and their pairs have no bucket.
    """
    flat = pa.array([t for x in sentences for t in ("", *x)] + [""], pa.string()).dictionary_encode()
    words = flat.dictionary.to_pylist()
    hashes = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words))
    wild = np.fromiter((w == WILD for w in words), bool, len(words))
    codes = flat.indices.to_numpy(zero_copy_only=False)
    h, none, border = hashes[codes], wild[codes], codes == codes[-1]
    whose = np.cumsum(border) - 1
    single, pair = ~none & ~border, ~none[:-1] & ~none[1:]
    both = (h[:-1] * 0x9E3779B1 + h[1:] * 0x85EBCA6B) >> 7
    return np.concatenate([h[single] % HASHED, both[pair] % HASHED]), np.concatenate([whose[single], whose[:-1][pair]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct sentences with their seeds, then how many sentences of each kind have each bucket (the last one is all)."""
    kinds = {"message": 0, "filler": 1, None: 2}
    counts = np.zeros((len(kinds), HASHED + 1), np.int64)
    none = lambda n: [pa.nulls(n, _ARROW[x.split()[1]]) for x in _COUNTED.split(", ")[6:]]
    names = [x.split()[0] for x in _COUNTED.split(", ")]
    for batch in batches:
        if not len(batch):
            continue
        tokens = batch["tokens"].to_pylist()
        seeds = seeds_of(tokens)
        kind = np.fromiter((kinds[x] for x in seeds), np.int64, len(seeds))
        found, whose = buckets(tokens)
        counts += np.bincount(kind[whose] * (HASHED + 1) + found, minlength=counts.size).reshape(counts.shape)
        counts[:, -1] += np.bincount(kind, minlength=len(kinds))
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in names[:5]), pa.array(seeds, pa.string()), *none(len(batch))], names=names)
    yield _batch([(*[None] * 6, i, *counts[:, i].tolist()) for i in np.flatnonzero(counts.any(0)).tolist()], _COUNTED)


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Templates of rows that come path by path; rows have a count, so that grown trees can be merged by the same step."""
    path, leaf = None, Leaf()
    for batch in batches:
        done = []
        for at, *row in zip(*(batch[c].to_pylist() for c in ("path", "tokens", "n", "least", "most", "seed"))):
            if at != path:
                done += [(path, *t) for t in leaf.templates]
                path, leaf = at, Leaf()
            leaf.add(*row)
        yield _batch(done, _TEMPLATES)
    yield _batch([(path, *t) for t in leaf.templates], _TEMPLATES)


def sentences(found: DataFrame) -> DataFrame:
    """Masked sentences of (rec_table, rec_id, title, text); a record with an unresolved slot has one row with ``slot`` true instead."""
    texts = found.select("rec_table", "rec_id", F.xxhash64("title").alias("title_hash"), "text", pointer_target(F.col("text")).isNotNull().alias("pointer"))
    return cut(texts.mapInArrow(_to_sentences, _SENTENCES), "sentences")


def counted(found: DataFrame) -> DataFrame:
    """Each distinct sentence (path, tokens) with its number, two of its titles' hashes and its seed; and rows of buckets."""
    each = found.where("NOT slot").groupBy("path", "tokens").agg(F.count("*").alias("n"), F.min("title_hash").alias("least"), F.max("title_hash").alias("most"))
    return cut(each.mapInArrow(_count, _COUNTED), "counted")


def weights(distinct: DataFrame) -> np.ndarray:
    """Log-odds of each bucket: of residue against other sentences, and of messages against filler."""
    counts = np.zeros((3, HASHED + 1))
    for i, *n in distinct.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("message"), F.sum("filler"), F.sum("other")).collect():
        counts[:, i] = n

    def odds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        part = (a[-1] + 1) / (a[-1] + b[-1] + 2)
        return np.log((a[:-1] + SMOOTH * part) / (b[:-1] + SMOOTH * (1 - part))) - np.log(part / (1 - part))

    return np.stack([odds(counts[0] + counts[1], counts[2]), odds(counts[0], counts[1])])


def templates(distinct: DataFrame) -> DataFrame:
    """(path, tokens, n, least, most, seed): the templates mined from all sentences."""
    grown = distinct.where("path IS NOT NULL").select("path", "tokens", "n", "least", "most", "seed").sortWithinPartitions("path").mapInArrow(_grow, _TEMPLATES)
    return grown.where("path IS NOT NULL").repartition("path").sortWithinPartitions("path", F.desc("n"), "tokens").mapInArrow(_grow, _TEMPLATES).where("path IS NOT NULL")


def _sums(log_odds: np.ndarray, sentences: list[list[str]]) -> np.ndarray:
    found, whose = buckets(sentences)
    return np.stack([np.bincount(whose, w[found], len(sentences)) for w in log_odds])


def _classify(log_odds: np.ndarray):
    def verdict(tokens: list[str], least: int, most: int, seed: str | None, odds: float, kind: float) -> str | None:
        if seed is not None:
            return seed if odds > -ODDS else None
        if odds >= ODDS and least != most and tokens.count(WILD) <= VARYING * len(tokens):
            return "message" if kind >= 0 else "filler"
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("path", "tokens", "least", "most", "seed")]
            odds = _sums(log_odds, columns[1]).tolist()
            yield _batch([(p, t, s, v) for p, t, a, b, s, o, k in zip(*columns, *odds) if (v := verdict(t, a, b, s, o, k))], "path string, template array<string>, seed string, verdict string")

    return run


def _own(log_odds: np.ndarray):
    """Sentences (path, h, tokens, seed, verdict) whose own words don't speak for ordinary text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("path", "h", "tokens", "seed", "verdict")]
            odds = _sums(log_odds, columns[2])[0].tolist()
            yield _batch([(p, h, v) for p, h, t, s, v, o in zip(*columns, odds) if s is not None or o >= 0], "path string, h bigint, verdict string")

    return run


def judged_sentences(found: DataFrame) -> DataFrame:
    """(rec_table, rec_id, verdict) for each sentence that is residue."""
    distinct = counted(found)
    log_odds = weights(distinct)
    bad = cut(templates(distinct).mapInArrow(_classify(log_odds), "path string, template array<string>, seed string, verdict string"), "verdicts")
    fits = F.forall(F.zip_with("tokens", "template", lambda a, b: (a == b) | (b == WILD)), lambda x: x)
    named = distinct.where("path IS NOT NULL").select("path", F.xxhash64("tokens").alias("h"), "tokens", F.col("seed").alias("own_seed"))
    these = named.join(bad, "path").where(F.col("seed").eqNullSafe(F.col("own_seed")) & fits).select("path", "h", "tokens", "seed", "verdict").mapInArrow(_own(log_odds), "path string, h bigint, verdict string").distinct()
    return found.where("NOT slot").select("rec_table", "rec_id", "path", F.xxhash64("tokens").alias("h")).join(these, ["path", "h"]).select("rec_table", "rec_id", "verdict")


def residue(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """(rec_table, rec_id, kind): records that hold residue; kind is slot, message or filler."""
    return residue_of(records(pages, entries))


def residue_of(texts: DataFrame) -> DataFrame:
    """The same for any records (rec_table, rec_id, text)."""
    found = sentences(texts)
    slots = found.where("slot").select("rec_table", "rec_id", F.lit("slot").alias("verdict"))
    both = slots.unionByName(judged_sentences(found))
    return both.groupBy("rec_table", "rec_id").agg(F.max("verdict").alias("kind"))


def residue_found(pages: DataFrame, entries: DataFrame) -> DataFrame:
    return residue(pages, entries).select("rec_table", "rec_id")


def clean_records(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """(rec_table, rec_id, text) of the records without residue."""
    return records(pages, entries).join(residue(pages, entries), ["rec_table", "rec_id"], "left_anti").select("rec_table", "rec_id", "text")
