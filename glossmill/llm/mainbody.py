"""Page boilerplate mixed with main content.

Wrapper induction per host. Each page's containers form a small tree (siblings of one label folded); the trees
of a host are aligned by simple tree matching and united into its wrapper, first inside each partition, then
over all partitions. A page's containers are mapped onto the wrapper by the same matching, once per distinct
tree. A slot is a wrapper node together with the heading that governs the place. Text that is the same on many
pages of a host is template, and a slot that mostly holds such text is template too. The content slot is the
node that holds the page's own heading with what varies inside it; headings that stand for template places on
hosts with separate containers (teasers, comments) stand for them on hosts without as well, and so do the first
words of single paragraphs.

Everything that is counted is counted over all pages; only distinct trees, slots and texts are joined back, and
hot slots are salted.

Defined cases: pages without HTML have no rows; of several rows of a pageid with HTML any will do (they are
equal, else the smallest tree of values wins); empty pages and pages without ``p`` have no rows; broken markup is
read as a browser's tree builder would close it; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut, salted_join
from ..sources.tables import host_of

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(script|style|title|textarea|noscript|xmp|iframe)\b[^>]*>(?:.*?</\1\s*>|.*)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_LONG_NUMBER = re.compile(r"\d{4,}")
# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table td th tr ul".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em i ins kbd label mark q s samp small span strike strong sub sup time tt u var font".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NO_LABEL = frozenset("href src id style title alt srcset content name value type action method lang dir rel target".split())


def label_of(tag: str, attributes: str) -> str:
    """A container's label: its tag with the attributes that tell its role."""
    if not attributes.strip(" /"):
        return tag
    kept = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name not in NO_LABEL:
            kept.append(f"{name}={_LONG_NUMBER.sub('#', a or b or c)}")
    return tag if not kept else f"{tag}[{' '.join(sorted(kept))}]"


class Node:
    """A container: label, children in order, and whether pages have their own heading in it (a count in wrappers)."""

    __slots__ = ("label", "children", "title", "heading", "index", "parent")

    def __init__(self, label: str, parent: Node | None = None):
        self.label, self.parent = label, parent
        self.children: list[Node] = []
        self.title = 0
        self.heading = ""
        self.index = 0

    def child(self, label: str) -> Node:
        for c in self.children:
            if c.label == label:
                return c
        c = Node(label, self)
        self.children.append(c)
        return c

    def pack(self) -> list:
        return [self.label, self.title, [c.pack() for c in self.children]]

    @staticmethod
    def unpack(data: list, parent: Node | None = None) -> Node:
        n = Node(data[0], parent)
        n.title = data[1]
        n.children = [Node.unpack(c, n) for c in data[2]]
        return n

    def walk(self) -> Iterator[Node]:
        yield self
        for c in self.children:
            yield from c.walk()


ANCHOR = 1000  # weight of a pair that both hold the page's own heading: it is the one place that every page has


def matching(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching of two trees with equal root labels: size of the largest top-down matching that
    keeps order, and its pairs of children of the two roots."""
    m, n = len(a.children), len(b.children)
    size = [[0] * (n + 1) for _ in range(m + 1)]
    weight: dict[tuple[int, int], int] = {}
    for i in range(1, m + 1):
        x = a.children[i - 1]
        for j in range(1, n + 1):
            y = b.children[j - 1]
            best = size[i - 1][j] if size[i - 1][j] >= size[i][j - 1] else size[i][j - 1]
            if x.label == y.label:
                w = matching(x, y)[0] if x.children and y.children else 1
                if x.title and y.title:
                    w += ANCHOR
                weight[i, j] = w
                if size[i - 1][j - 1] + w > best:
                    best = size[i - 1][j - 1] + w
            size[i][j] = best
    pairs, i, j = [], m, n
    while i and j:
        if (w := weight.get((i, j))) and size[i][j] == size[i - 1][j - 1] + w:
            pairs.append((a.children[i - 1], b.children[j - 1]))
            i, j = i - 1, j - 1
        elif size[i][j] == size[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return size[m][n] + 1, pairs[::-1]


def unite(wrapper: Node, tree: Node) -> None:
    """``tree`` aligned with ``wrapper``; what doesn't match is inserted in its place."""
    wrapper.title += tree.title
    pairs = {id(y): x for x, y in matching(wrapper, tree)[1]}
    at = 0
    for y in tree.children:
        x = pairs.get(id(y))
        if x is None:
            y.parent = wrapper
            wrapper.children.insert(at, y)
            at += 1
        else:
            unite(x, y)
            at = next(i for i, c in enumerate(wrapper.children) if c is x) + 1


def mapped(wrapper: Node, tree: Node) -> list[int]:
    """For each node of ``tree`` in preorder the number of its node in ``wrapper`` (that of its parent where none matches)."""
    for i, node in enumerate(wrapper.walk()):
        node.index = i
    out: list[int] = []

    def go(x: Node, y: Node) -> None:
        out.append(x.index)
        pairs = {id(c): w for w, c in matching(x, y)[1]}
        for c in y.children:
            if (w := pairs.get(id(c))) is not None:
                go(w, c)
            else:
                out.extend([x.index] * sum(1 for _ in c.walk()))

    go(wrapper, tree)
    return out


def _prune(node: Node, wanted: set[int]) -> bool:
    """Takes off containers that hold neither a wanted node nor the page's heading."""
    node.children = [c for c in node.children if _prune(c, wanted)]
    return bool(node.children or node.title or id(node) in wanted)


_BLANKS = re.compile(r"\s+")
_TAG = re.compile(r"<[^>]*>")
_DIGITS = re.compile(r"\d+")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def page_of(html: str, host: str) -> tuple[Node, list[tuple]]:
    """The tree of containers, and of each ``p``: number, container, region, hashes of text and first words."""
    site = host.split(".")[0]
    root = Node("body")
    open_: list[tuple[str, Node]] = [("body", root)]  # open elements with their containers; inline ones keep their parent's
    found: list[list] = []
    p_no = 0
    heading: tuple[Node, str, int] | None = None  # container, tag and begin of an open heading
    reading: list | None = None  # the open p

    def end_p(at: int) -> None:
        nonlocal reading
        if reading is not None:
            reading[2] = html[reading[2] : at]
            reading = None
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] == "p":
                    del open_[k:]
                    break

    for m in _TOKEN.finditer(html):
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in ("html", "head", "body"):
            continue
        if m[2]:
            if tag in HEADINGS:
                if heading is not None:
                    text = _DIGITS.sub("#", _BLANKS.sub(" ", unescape(_TAG.sub("", html[heading[2] : m.start()]))).strip())
                    heading[0].heading = "h1" if heading[1] == "h1" else f"{heading[1]}:{text}"
                    heading = None
                continue
            if tag == "p":
                end_p(m.start())
                continue
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] == tag:
                    if tag not in INLINE and reading is not None:
                        end_p(m.start())
                        if k >= len(open_):
                            break
                    del open_[k:]
                    break
            continue
        if tag in ENDS_P:
            end_p(m.start())
        here = open_[-1][1]
        if tag in HEADINGS:
            heading = (here, tag, m.end())
            if tag == "h1":
                here.title = 1
        elif tag == "hr":
            here.heading = "hr"
        elif tag == "p":
            p_no += 1
            place, node = "", here
            while node is not None and not place:
                place, node = node.heading, node.parent
            reading = [p_no, here, m.end(), place]
            found.append(reading)
            open_.append(("p", here))
        elif tag in VOID:
            continue
        elif tag in INLINE and reading is not None:
            continue
        elif tag in ("ul", "ol", "li", "a"):
            open_.append((tag, here))
        else:
            inner = here.child(label_of(tag, m[4]))
            inner.heading = ""
            open_.append((tag, inner))
    end_p(len(html))
    _prune(root, {id(r[1]) for r in found})
    order = {id(n): i for i, n in enumerate(root.walk())}
    out, seen = [], set()
    for number, node, text, place in found:
        words = _DIGITS.sub("#", _BLANKS.sub(" ", unescape(_TAG.sub("", text))).strip()).replace(site, "<site>").split(" ")
        whole = _hash(" ".join(words))
        out.append((number, order[id(node)], place, whole, _hash(" ".join(words[:2])), whole not in seen))
        seen.add(whole)
    return root, out


_PARSED = "pageid bigint, host string, tree string, tree_hash bigint, ps array<struct<p_no:int,node:int,region:string,text:bigint,head:bigint,first:boolean>>"
_P = pa.list_(pa.struct([("p_no", pa.int32()), ("node", pa.int32()), ("region", pa.string()), ("text", pa.int64()), ("head", pa.int64()), ("first", pa.bool_())]))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["pageid", "host", "tree", "tree_hash", "ps"]
    keys = [f.name for f in _P.value_type]
    for batch in batches:
        rows = []
        for pageid, host, html in zip(batch["pageid"].to_pylist(), batch["host"].to_pylist(), batch["raw_html"].to_pylist()):
            root, ps = page_of(html, host)
            tree = json.dumps(root.pack(), ensure_ascii=False)
            rows.append((pageid, host, tree, _hash(host + "\n" + tree), [dict(zip(keys, p)) for p in ps]))
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), _P)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of each host united into one (rows in any order)."""
    wrappers: dict[str, Node] = {}
    for batch in batches:
        for host, tree in zip(batch["host"].to_pylist(), batch["tree"].to_pylist()):
            node = Node.unpack(json.loads(tree))
            if host in wrappers:
                unite(wrappers[host], node)
            else:
                wrappers[host] = node
    yield pa.RecordBatch.from_arrays([pa.array(list(wrappers), pa.string()), pa.array([json.dumps(w.pack(), ensure_ascii=False) for w in wrappers.values()], pa.string())], names=["host", "tree"])


def _map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each distinct tree its nodes' numbers in the wrapper, the title's node, and which nodes lie in it."""
    wrappers: dict[str, tuple[str, Node]] = {}
    for batch in batches:
        rows = []
        for key, tree, packed in zip(batch["tree_hash"].to_pylist(), batch["tree"].to_pylist(), batch["wrapper"].to_pylist()):
            if packed not in wrappers:
                wrappers.clear()
                wrapper = Node.unpack(json.loads(packed))
                title = max(wrapper.walk(), key=lambda n: n.title)
                inside = {id(n) for n in title.walk()} if title.title else set()
                list(map(lambda x: setattr(x[1], "index", x[0]), enumerate(wrapper.walk())))
                wrappers[packed] = (title, wrapper, {n.index for n in wrapper.walk() if id(n) in inside})
            title, wrapper, inside = wrappers[packed]
            nodes = mapped(wrapper, Node.unpack(json.loads(tree)))
            labels = {n.index: n.label for n in wrapper.walk()}
            # the matching may have put like containers of the title's node in several places of the wrapper: one kind
            kinds = [f"in {labels[i]}" if i in inside and i != title.index else str(i) for i in nodes]
            rows.append((key, kinds, [1 if i == title.index and title.title else 2 if i in inside else 0 for i in nodes]))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.string())), pa.array([r[2] for r in rows], pa.list_(pa.int32()))], names=["tree_hash", "nodes", "places"])


OFTEN = 0.003  # share of a host's pages, and
LEAST = 3  # pages, that make a text template
MOSTLY = 0.5  # share of template text that makes a container inside the title's node template
ALMOST = 0.85  # the same for other slots: text of the page may stand between notices there
EVIDENCE = 0.0005  # share of template places, and
KNOWN = 5  # places, that make first words known
PURE = 0.02  # share of content places that known template words may have
OWN = 0.15  # most template text in the title's node of a host whose content has a container of its own


def paragraphs(pages: DataFrame) -> DataFrame:
    """(pageid, host, p_no, slot, node, place, region, text, head, first): each p with its slot in the host's wrapper."""
    html = pages.where(F.col("pageid").isNotNull() & (F.col("raw_html") != "")).select("pageid", host_of(F.col("url")).alias("host"), "raw_html")
    parsed = html.mapInArrow(_parse, _PARSED)
    parsed = cut(parsed.groupBy("pageid").agg(F.min(F.struct("host", "tree", "tree_hash", "ps")).alias("x")).select("pageid", "x.*"), "parsed")
    trees = parsed.groupBy("tree_hash").agg(F.min("host").alias("host"), F.min("tree").alias("tree"))
    trees = cut(trees, "trees")
    wrappers = trees.select("host", "tree").mapInArrow(_unite, "host string, tree string").repartition("host").mapInArrow(_unite, "host string, tree string")
    pairs = trees.join(wrappers.withColumnRenamed("tree", "wrapper"), "host").sortWithinPartitions("host").select("tree_hash", "tree", "wrapper")
    maps = cut(pairs.mapInArrow(_map, "tree_hash bigint, nodes array<string>, places array<int>"), "maps")
    both = salted_join(parsed.drop("tree"), maps, "tree_hash", "inner")
    p = both.select("pageid", "host", "nodes", "places", F.explode("ps").alias("p"))
    place = F.get("places", F.col("p.node"))
    return p.select("pageid", "host", "p.p_no", F.concat_ws("|", "host", F.get("nodes", F.col("p.node")), "p.region").alias("slot"), F.concat_ws("|", "host", F.get("nodes", F.col("p.node"))).alias("node"), place.alias("place"), "p.region", "p.text", "p.head", "p.first")


def _known(ps: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that hardly ever stand in content, on hosts whose content has a container of its own."""
    n = ps.groupBy(column).agg(F.count_if("sure_template").alias("t"), F.count_if("sure_content").alias("c"))
    all_templates = ps.agg(F.count_if("sure_template")).first()[0]
    return n.where((F.col("t") >= max(KNOWN, EVIDENCE * all_templates)) & (F.col("c") <= PURE * F.col("t"))).select(column)


def main_body(pages: DataFrame) -> DataFrame:
    """(pageid, p_no): the p elements that belong to the page's main body."""
    ps = cut(paragraphs(pages), "paragraphs")
    # text that many pages of a host share; short hosts are also held against all hosts
    sizes = ps.groupBy("host").agg(F.countDistinct("pageid").alias("n_pages"))
    texts = ps.where("first").groupBy("host", "text").agg(F.count("*").alias("n"))
    often = texts.where(F.col("n") >= LEAST).join(sizes, "host").where(F.col("n") >= OFTEN * F.col("n_pages")).select("host", "text")
    all_pages = sizes.agg(F.sum("n_pages")).first()[0] or 0
    everywhere = texts.groupBy("text").agg(F.sum("n").alias("n"), F.count("*").alias("hosts")).where((F.col("hosts") >= 3) & (F.col("n") >= max(2 * LEAST, OFTEN * all_pages)))
    everywhere = everywhere.select("text", F.lit(True).alias("everywhere"))
    ps = ps.join(often.withColumn("often", F.lit(True)), ["host", "text"], "left").join(everywhere, "text", "left")
    ps = cut(ps.withColumn("template_text", F.col("often").isNotNull() | F.col("everywhere").isNotNull()).drop("often", "everywhere"), "texts")
    slots = ps.groupBy("slot", "node", "host", "place", "region").agg(F.count("*").alias("n"), F.count_if("template_text").alias("n_template"))
    # inside the title's node a container is one slot, whatever heading it stands under
    nodes = slots.groupBy("node").agg((F.sum("n_template") >= MOSTLY * F.sum("n")).alias("template_node"))
    slots = slots.join(nodes, "node").withColumn("template_slot", F.when(F.col("place") == 2, F.col("template_node")).otherwise(F.col("n_template") >= ALMOST * F.col("n")))
    slots = cut(slots.drop("node", "template_node"), "slots")
    # a host has a content container of its own where the title's node holds hardly any template text
    own = slots.where("place = 1").groupBy("host").agg((F.sum("n_template") <= OWN * F.sum("n")).alias("own"))
    slots = slots.join(own, "host", "left").withColumn("own", F.coalesce("own", F.lit(False)))
    # what stands under a heading outside the title's node on such hosts is template under it everywhere
    by = slots.where("own AND region LIKE 'h_:%'").groupBy("region").agg(F.sum(F.when(F.col("place") == 0, F.col("n"))).alias("out"), F.sum(F.when(F.col("place") > 0, F.col("n"))).alias("within"))
    aside = by.where(F.coalesce("out", F.lit(0)) > F.coalesce("within", F.lit(0))).select("region", F.lit(True).alias("aside"))
    slots = slots.join(aside, "region", "left").withColumn("aside", F.coalesce("aside", F.lit(False)))
    content = (F.col("place") > 0) & ~F.col("template_slot") & (F.col("own") | ~F.col("aside"))
    judged = slots.select("slot", content.alias("content"), F.col("own"), F.col("template_slot"))
    ps = cut(salted_join(ps.drop("host", "region", "node"), judged, "slot", "inner"), "judged")
    sure = ps.withColumn("sure_template", F.col("own") & ~F.col("content")).withColumn("sure_content", F.col("own") & F.col("content"))
    kept = ps.where("content AND (own OR NOT template_text)")
    loose = kept.where("NOT own").join(_known(sure, "head"), "head", "left_anti")
    return kept.where("own").select("pageid", "p_no").unionByName(loose.select("pageid", "p_no"))
