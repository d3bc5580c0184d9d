"""Filling fixed-capacity containers with items.

Vector bin packing: an item is a text or, where a text alone exceeds the capacity, its pieces; its demands are
tokens, one segment, and loss-bearing tokens, each under a limit of its own. Containers are filled side by side: of
the items that still fit under all three limits a container gets the one with the largest dot product of its demands
with the room that is left, each dimension weighted by the share of it that all items demand. Where several want the
last item of a kind, the one that gains most gets it and the others choose again.

Limits (parameters of ``packed``): tokens by the capacity; segments by one for ``segment`` tokens of capacity, FEWEST
at least; loss-bearing tokens by a share ``loss`` of the capacity. A text that fits the capacity is never split, so one
that alone bears more loss than the limit takes all of that room: nothing that bears loss joins it.

Loss-bearing tokens are those of slices that begin after the prompt, and the prompt is what the pattern ``prompt``
matches at a text's begin. No table says what a prompt is; by default it is the first line of several.

Items are spread by a hash over shards of about SHARD pieces, counted for each kind of container, and shards are packed
apart from each other; that leaves one container a shard that may be far from full. Inside a shard equal items are one
class, so that a step is one product of the containers' rooms with the classes.

Defined cases: null and empty texts have no tokens and get no container (shard and bin null, piece 0); capacities that
are null or not positive are no containers; a repeated capacity counts once; a text of any length is cut in order into
pieces of the capacity and a rest; equal items are interchangeable, the smaller doc_id goes first; a null doc_id is an
item like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lineage import cut
from . import tokens

SHARD = 10_000  # pieces of a shard, about
TASKS = 20_000  # partitions that shards are dealt to at most; beyond that a task packs several, one after the other
SEGMENT = 48  # tokens of capacity that allow one more segment
FEWEST = 4  # segments that any container may have
LOSS = 0.9375  # share of the capacity that loss-bearing tokens may take
PROMPT = r"[^\n]*\n(?=\s*\S)"
BATCH = 128  # containers that are filled side by side


def _sizes(path: str, prompt: str):
    kind = pa.struct([("n_tokens", pa.int64()), ("n_loss", pa.int64())])
    opening = re.compile(prompt)

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for part in tokens._stretches([x or "" for x in texts.to_pylist()]):
            encoder = tokens.encoder(path)
            joined, starts, first = tokens.slices(part)
            places = starts.tolist()
            sizes = np.fromiter((len(encoder.ids_of(joined[a:b])) for a, b in zip(places, [*places[1:], len(joined)])), np.int64, len(places))
            upto = np.concatenate([[0], np.cumsum(sizes)])
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            heads = np.fromiter((m.end() if (m := opening.match(t)) else 0 for t in part), np.int64, len(part))
            begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
            lossy = np.clip(np.searchsorted(starts, begin + heads), first[:-1], first[1:])
            out.append(np.stack([upto[first[1:]] - upto[first[:-1]], upto[first[1:]] - upto[lossy]], 1))
        both = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        return pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], fields=list(kind))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_loss", T.LongType())]))


def _turns(keys: np.ndarray) -> np.ndarray:
    """For each of the keys how many equal ones come before it."""
    order = np.argsort(keys, kind="stable")
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - np.searchsorted(keys[order], keys[order])
    return out


def _best(rooms: np.ndarray, demand: np.ndarray, weighted: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each container the class (of those given, in order of tokens) with the largest product, and the product; below zero where none fits."""
    few = classes[: np.searchsorted(demand[classes, 0], rooms[:, 0].max() + 1e-12, "right")]
    if not len(few):
        return np.zeros(len(rooms), np.int64), np.full(len(rooms), -1.0)
    fits = (demand[few, 0] <= rooms[:, :1] + 1e-12) & (demand[few, 2] <= rooms[:, 2:] + 1e-12)
    score = np.where(fits, rooms @ weighted[few].T, -1.0)
    at = score.argmax(1)
    return few[at], score[np.arange(len(rooms)), at]


def fill(n_tokens: np.ndarray, n_loss: np.ndarray, capacity: int, segments: int, loss: int) -> np.ndarray:
    """Number of the container of each item; no item has more tokens than the capacity."""
    items = np.stack([n_tokens, n_loss], 1)
    classes, of = np.unique(items, axis=0, return_inverse=True)  # in order of tokens, then of loss
    of = of.reshape(-1)
    order = np.argsort(of, kind="stable")
    begins = np.searchsorted(of[order], np.arange(len(classes) + 1))
    left, used = np.diff(begins), begins[:-1].copy()
    demand = np.column_stack([classes[:, 0] / capacity, np.full(len(classes), 1 / segments), np.minimum(classes[:, 1] / loss, 1.0)])
    weights = (demand * left[:, None]).sum(0)
    weights /= weights.sum() or 1
    weighted = demand * weights
    out = np.empty(len(items), np.int64)
    number, todo = 0, int(items[:, 0].sum())
    alive = np.arange(len(classes))
    while len(alive):
        # no more at once than half of what the rest needs, so that the last ones are filled one at a time
        n = max(1, min(BATCH, todo // capacity // 2))
        room = np.ones((n, 3))
        open_ = np.arange(n)
        while len(open_) and len(alive):
            rooms = room[open_]
            most = demand[alive].max(0)
            easy = (rooms >= most - 1e-12).all(1)
            if easy.any():
                # where everything fits, the best items by the rooms' mean are dealt out, the first to where most room is
                these = open_[easy]
                score = weighted[alive] @ rooms[easy].mean(0)
                top = np.argpartition(-score, len(these) - 1)[: len(these)] if len(these) < len(alive) else np.arange(len(alive))
                top = alive[top[np.argsort(-score[top], kind="stable")]]
                kinds = np.repeat(top, np.minimum(left[top], len(these)))[: len(these)]
                to = these[np.argsort(-(rooms[easy] @ weights), kind="stable")[: len(kinds)]]
            else:
                # of classes with equal tokens the last has most loss: the others matter only where the room for loss binds
                last = alive[np.append(classes[alive[1:], 0] != classes[alive[:-1], 0], True)]
                upto = np.searchsorted(demand[last, 0], rooms[:, 0] + 1e-12, "right")
                tight = np.append(0.0, np.maximum.accumulate(demand[last, 2]))[upto] > rooms[:, 2] + 1e-12
                wanted, gain = np.zeros(len(open_), np.int64), np.full(len(open_), -1.0)
                for some, choice in ((tight, alive), (~tight, last)):
                    if some.any():
                        wanted[some], gain[some] = _best(rooms[some], demand, weighted, choice)
                on = (gain >= 0) & (rooms[:, 1] >= 1 / segments - 1e-12)
                open_, wanted, gain = open_[on], wanted[on], gain[on]
                first = np.argsort(-gain, kind="stable")  # those that gain most go first
                gets = first[_turns(wanted[first]) < left[wanted[first]]]
                to, kinds = open_[gets], wanted[gets]
            out[order[used[kinds] + _turns(kinds)]] = number + to
            np.add.at(used, kinds, 1)
            np.subtract.at(left, kinds, 1)
            room[to] -= demand[kinds]
            todo -= int(classes[kinds, 0].sum())
            if not left[kinds].all():
                alive = alive[left[alive] > 0]
        number += n
    return out


_PACKED = "container string, shard bigint, bin bigint, doc_id bigint, piece int, from_token bigint, n_tokens bigint, n_loss bigint"
_SIZED = ("container", "shard", "doc_id", "piece", "from_token", "n_tokens", "n_loss")
_LIMITS = ("capacity", "segments", "loss_limit")


def _fill_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their shard; a shard of set size is packed as soon as it is complete."""

    def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        limits = [int(t[c][0].as_py()) for c in _LIMITS]
        bins = fill(t["n_tokens"].to_numpy(), t["n_loss"].to_numpy(), *limits)
        columns = {c: t[c] for c in _SIZED} | {"bin": pa.chunked_array([pa.array(bins)])}
        names = [x.split()[0] for x in _PACKED.split(", ")]
        return pa.table([columns[c] for c in names], names=names).combine_chunks().to_batches()[0]

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch["key"].to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if waiting and waiting[0]["key"][0].as_py() != keys[a]:
                yield done(waiting)
                waiting = []
            waiting.append(batch.slice(a, b - a))
    if waiting:
        yield done(waiting)


def _limits(capacity: int, segment: int, loss: float) -> tuple[int, int, int]:
    return capacity, max(FEWEST, capacity // segment), max(1, int(capacity * loss))


def packed(documents: DataFrame, capacities: DataFrame, shard: int = SHARD, segment: int = SEGMENT, loss: float = LOSS, prompt: str = PROMPT) -> DataFrame:
    """(container, shard, bin, doc_id, piece, from_token, n_tokens, n_loss): each piece of each text in each kind of container.

    A container is one (container, shard, bin). A piece as large as the capacity fills one by itself: its shard is
    below zero and stands for the piece's number, its bin is the document. ``capacities`` is a table of settings; it is
    read by the driver and its rows become literals.
    """
    if not 0 < loss <= 1:
        raise ValueError(f"loss must be above 0 and at most 1: {loss}")
    kinds = sorted({(r[0], r[1], int(r[2])) for r in capacities.select("container", "tokenizer", "capacity").collect() if r[0] and r[1] and r[2] and r[2] > 0})
    if not kinds:
        return documents.sparkSession.createDataFrame([], _PACKED)
    parts, at = [], 0
    for tokenizer in sorted({k[1] for k in kinds}):
        sized = documents.select("doc_id", F.monotonically_increasing_id().alias("row"), _sizes(tokens.vocabulary_path(tokenizer), prompt)("text").alias("s"))
        sized = cut(sized.select("doc_id", "row", "s.*"), "sizes")
        mine = [(c, n) for c, t, n in kinds if t == tokenizer]
        rests = sized.agg(*[F.count_if(F.col("n_tokens") % n > 0) for _, n in mine]).first()
        settings = []
        for (c, n), rest in zip(mine, rests):
            shards = max(1, -(-rest // shard))
            settings.append(F.struct(F.lit(c).alias("container"), *[F.lit(x).cast("bigint").alias(k) for k, x in zip(_LIMITS, _limits(n, segment, loss))], F.lit(at).cast("bigint").alias("first"), F.lit(shards).cast("bigint").alias("shards")))
            at += shards
        both = sized.select("*", F.explode(F.array(*settings)).alias("c")).select("doc_id", "row", F.col("n_tokens").alias("whole"), F.col("n_loss").alias("lossy"), "c.*")
        n_pieces = F.greatest(F.ceil(F.col("whole") / F.col("capacity")), F.lit(1))
        cuts = both.select("*", F.posexplode(F.sequence(F.lit(0).cast("bigint"), (n_pieces - 1).cast("bigint"))).alias("piece", "k")).withColumn("from_token", F.col("k") * F.col("capacity"))
        size = F.least(F.col("capacity"), F.col("whole") - F.col("from_token"))
        quiet = F.greatest(F.lit(0), F.col("whole") - F.col("lossy") - F.col("from_token"))  # of the prompt, which comes first
        parts.append(cuts.withColumn("n_tokens", size).withColumn("n_loss", F.greatest(F.lit(0), size - quiet)))
    items = parts[0]
    for p in parts[1:]:
        items = items.unionByName(p)
    small = items.where("n_tokens > 0 AND n_tokens < capacity").withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.col("shards")))
    small = small.withColumn("key", F.col("first") + F.col("shard")).select("key", *_SIZED, *_LIMITS)
    tasks = min(at, TASKS)
    dealt = small.repartitionById(tasks, F.pmod("key", F.lit(tasks)).cast("int")).sortWithinPartitions("key", "doc_id", "piece")
    known = F.col("doc_id").isNotNull()
    own = F.when(known, -1 - F.col("piece")).otherwise(F.lit(-(1 << 62)) - F.col("piece"))
    full = items.where("n_tokens = capacity").select("container", own.cast("bigint").alias("shard"), F.coalesce("doc_id", "row").alias("bin"), "doc_id", "piece", "from_token", "n_tokens", "n_loss")
    none = items.where("n_tokens = 0").select("container", F.lit(None).cast("bigint").alias("shard"), F.lit(None).cast("bigint").alias("bin"), "doc_id", "piece", "from_token", "n_tokens", "n_loss")
    return dealt.mapInArrow(_fill_shards, _PACKED).unionByName(full).unionByName(none)


def fill_report(documents: DataFrame, capacities: DataFrame, segment: int = SEGMENT, loss: float = LOSS, prompt: str = PROMPT) -> DataFrame:
    """Per kind of container: its limits, containers used and at each limit, least possible number by tokens, pieces,
    tokens and the share of room used."""
    p = packed(documents, capacities, segment=segment, loss=loss, prompt=prompt).where("bin IS NOT NULL")
    by = p.groupBy("container", "shard", "bin").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t"), F.sum("n_loss").alias("l"))
    c = capacities.where("capacity > 0").select("container", F.col("capacity").cast("bigint").alias("capacity")).distinct()
    c = c.withColumn("max_segments", F.greatest(F.lit(FEWEST), F.floor(F.col("capacity") / segment))).withColumn("max_loss", F.greatest(F.lit(1), F.floor(F.col("capacity") * loss)))
    at = lambda x, limit: F.count_if(F.col(x) >= F.col(limit))
    n = by.join(F.broadcast(c), "container").groupBy("container", "capacity", "max_segments", "max_loss").agg(  # as many rows as there are settings
        F.count("*").alias("n_bins"), at("t", "capacity").alias("at_capacity"), at("n", "max_segments").alias("at_segments"), at("l", "max_loss").alias("at_loss"), F.sum("n").alias("n_pieces"), F.sum("t").alias("n_tokens"))
    return n.withColumn("least_bins", F.ceil(F.col("n_tokens") / F.col("capacity"))).withColumn("filled", F.round(F.col("n_tokens") / (F.col("n_bins") * F.col("capacity")), 6))
