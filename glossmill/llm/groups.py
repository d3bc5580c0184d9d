"""Consolidating pairwise matches into groups.

Connected components by contraction. Each round strips the vertices of degree one and compresses chains of
degree two (list ranking by random mates: of neighbouring chain vertices only the one with the smallest hash
goes, and its two neighbours are linked instead). What is left, the core with degrees of three and more, is
solved by alternating large-star and small-star steps. Then the labels are restored to the removed vertices,
latest round first.

Keys are numbered once, by the place of their row in a written table, and all rounds work on numbers; each group's
smallest key is looked up at the end.

Everything is a join or an aggregation with partial aggregation before its shuffle: no adjacency list is ever
collected, so a hub with a third of all pairs is counted, not gathered. Joins that look a hub up have it on
the side that adaptive execution splits. Each round is written to the shared folder, which cuts the lineage.

Defined cases: pairs with a null are ignored; a pair of a key with itself makes a group of its own; repeated
pairs and both directions count once; no pairs give no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import title_key
from ..plans.lineage import cut


def _both_ways(edges: DataFrame) -> DataFrame:
    """(v, n) for each end of each edge."""
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("n")), F.struct(F.col("b").alias("v"), F.col("a").alias("n")))).alias("x")).select("x.v", "x.n")


def _ordered(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct edges a < b without loops."""
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _rank(v: str, turn: int):
    """A vertex's turn among its neighbours; of two equal ones neither goes."""
    return F.xxhash64(F.col(v), F.lit(turn))


def _contract(edges: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Vertices that go in this round with the vertex they follow (v, up), and the edges that stay."""
    ends = _both_ways(edges)
    by = ends.groupBy("v").agg(F.count("*").alias("degree"), F.min("n").alias("n1"), F.max("n").alias("n2"))
    few = cut(by.where("degree <= 2"), "few")
    leaf = few.where("degree = 1").select("v", F.col("n1").alias("up"))
    # of two leaves that only have each other the smaller stays
    leaf = leaf.join(leaf.select(F.col("v").alias("up"), F.col("up").alias("back")), "up", "left").where("back IS NULL OR v > up").select("v", "up")
    pair = few.where("degree = 2")
    near = pair.select("v", "n1", "n2", F.explode(F.array("n1", "n2")).alias("n"))
    # degree-one neighbours go in this round as well, so a chain vertex next to one waits
    rival = few.select(F.col("v").alias("n"), F.when(F.col("degree") == 2, _rank("v", turn)).alias("r"), (F.col("degree") == 1).alias("end"))
    mates = near.join(rival, "n", "left").groupBy("v", "n1", "n2").agg(F.min("r").alias("r"), F.max(F.coalesce("end", F.lit(False))).alias("end"))
    link = mates.where(~F.col("end") & (F.col("r").isNull() | (_rank("v", turn) < F.col("r"))))
    gone = cut(leaf.unionByName(link.select("v", F.col("n1").alias("up"))), "gone")
    kept = edges.join(gone.select(F.col("v").alias("a")), "a", "left_anti").join(gone.select(F.col("v").alias("b")), "b", "left_anti")
    left = kept.select("a", "b").unionByName(link.select(F.col("n1").alias("a"), F.col("n2").alias("b")))
    return gone, cut(_ordered(left, "a", "b"), "edges")


def _stars(edges: DataFrame) -> DataFrame:
    """(v, label) of the core by alternating stars; each label is the smallest vertex of its component."""
    e = edges
    before = None
    while True:
        ends = _both_ways(e)
        least = ends.groupBy("v").agg(F.least(F.min("n"), F.col("v")).alias("m"))
        large = ends.where("n > v").join(least, "v").select(F.col("n").alias("x"), F.col("m").alias("y"))
        e = _ordered(large, "x", "y")
        down = e.select(F.col("b").alias("v"), F.col("a").alias("n"))
        least = down.groupBy("v").agg(F.min("n").alias("m"))
        small = down.join(least, "v")
        e = cut(_ordered(small.select(F.col("n").alias("x"), F.col("m").alias("y")).unionByName(least.select(F.col("v").alias("x"), F.col("m").alias("y"))), "x", "y"), "stars")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return e.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("label"))
        before = now


def components(pairs: DataFrame, left: str = "a", right: str = "b", rounds: int = 24) -> DataFrame:
    """(group_key, title_key): for each key in ``pairs`` the smallest key linked to it directly or indirectly.

    ``rounds`` bounds the contraction; what it leaves goes to the core solver, so the result doesn't depend on it.
    """
    pairs = cut(pairs.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct(), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    names = cut(ends.withColumn("id", F.monotonically_increasing_id()), "names")
    # the keys are unique on one side of both joins, so a hub is on the side that adaptive execution splits
    numbered = pairs.join(names.select(F.col("key").alias("a"), F.col("id").alias("ia")), "a").join(names.select(F.col("key").alias("b"), F.col("id").alias("ib")), "b")
    pairs = cut(numbered.select(F.col("ia").alias("a"), F.col("ib").alias("b")), "numbered")
    edges = cut(_ordered(pairs, "a", "b"), "edges")
    label = _labels(pairs, edges, rounds)
    named = cut(label.join(names.withColumnRenamed("id", "v"), "v").select("label", F.col("key").alias("title_key")), "named")
    least = named.groupBy("label").agg(F.min("title_key").alias("group_key"))
    return named.join(least, "label").select("group_key", "title_key")


def _labels(pairs: DataFrame, edges: DataFrame, rounds: int) -> DataFrame:
    """(v, label): for each vertex of ``pairs`` a vertex that stands for its group."""
    gone: list[DataFrame] = []
    last = edges.count()
    while last and len(gone) < rounds:
        removed, edges = _contract(edges, len(gone))
        gone.append(removed)
        n = edges.count()
        if n > 0.98 * last:  # only the core is left
            last = n
            break
        last = n
    loops = pairs.where("a = b").select("a").distinct().select(F.col("a").alias("v"), F.col("a").alias("label"))
    if not gone:
        return loops
    # vertices without a label yet that others follow: the smaller ends of pairs, and single vertices left over
    label = None
    if last:
        core = _stars(edges)
        label = cut(core.unionByName(core.select(F.col("label").alias("v"), "label").distinct()), "labels")
    for removed in reversed(gone):
        roots = removed.select(F.col("up").alias("v")).distinct()
        if label is None:
            known = roots.select("v", F.col("v").alias("label"))
        else:
            known = label.unionByName(roots.join(label, "v", "left_anti").select("v", F.col("v").alias("label")))
        known = cut(known, "known")
        label = known.unionByName(removed.join(known.withColumnRenamed("v", "up"), "up").select("v", "label"))
    label = cut(label, "labels")
    return label.unionByName(loops.join(label, "v", "left_anti"))


def title_pairs(redirects: DataFrame, entries: DataFrame) -> DataFrame:
    """(a, b): title keys of both ends of each redirect and of each entry with each alias."""
    r = redirects.select(F.col("source_title").alias("x"), F.col("target_title").alias("y"))
    e = entries.select(F.col("title").alias("x"), F.explode("redirect_aliases").alias("y"))
    both = reduce(DataFrame.unionByName, [r, e]).where("x IS NOT NULL AND y IS NOT NULL").distinct()
    return both.select(title_key("x").alias("a"), title_key("y").alias("b"))


def title_groups(redirects: DataFrame, entries: DataFrame) -> DataFrame:
    return components(title_pairs(redirects, entries))


def group_sizes(redirects: DataFrame, entries: DataFrame) -> DataFrame:
    """Number of groups by number of members."""
    n = title_groups(redirects, entries).groupBy("group_key").agg(F.count("*").alias("n_titles"))
    return n.groupBy("n_titles").agg(F.count("*").alias("n_groups"))
