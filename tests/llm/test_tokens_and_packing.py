import base64
import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows
from glossmill.llm import packing, tokens
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts():
    r = random.Random(2)
    alphabet = "ab'strevmld  \n\r\t é1²٣!-'’　 字😀x\x00"
    made = ["".join(r.choice(alphabet) for _ in range(r.randrange(40))) for _ in range(3000)]
    return [*made, "", " ", "\n\n", "'s", "x's", " 's", "''s", "don't we'll", "<|endoftext|>", "word " * 5000, "a" * 3000, "\n" * 500 + "x", "é"]


def test_ids(spark, plain):
    texts = _texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "doc_id bigint, text string").withColumn("ids", F.lit(1))
    got = {r.doc_id: r.ids for r in tokens.token_ids(df).collect()}
    assert got.pop(-1) == []
    assert got == {i: plain.encode_ordinary(t) for i, t in enumerate(texts)}
    back = {r.doc_id: r.text for r in tokens.decoded(tokens.token_ids(df)).collect()}
    assert all(back[i] == t for i, t in enumerate(texts))
    spans = {r.doc_id: (r.ids, r.begins) for r in tokens.token_spans(df).collect()}
    for i, t in enumerate(texts[:200]):
        ids, begins = spans[i]
        data = t.encode()
        assert [data[a:b] for a, b in zip(begins, [*begins[1:], len(data)])] == [plain.decode_single_token_bytes(k) for k in ids]
    assert tokens.token_ids(df.limit(0)).isEmpty()


def test_scan_equals_sequential():
    joined, starts, first = tokens.slices(["it's  a\n\ntest", "", "''ll x"])
    cuts = [*starts.tolist(), len(joined)]
    assert [joined[a:b] for a, b in zip(cuts, cuts[1:])] == ["it", "'s", " ", " a", "\n", "\n", "test", "''", "ll", " x"]
    assert first.tolist() == [0, 7, 7, 10]


def _by_bin(got, container):
    bins = defaultdict(list)
    for x in got:
        if x.container == container and x.bin is not None:
            bins[(x.shard, x.bin)].append(x)
    return bins


def _check(got, texts, container, cap, segments, loss, plain):
    """Every text whole and in order, unsplit if it fits, and no container above a limit."""
    bins = _by_bin(got, container)
    for rows_ in bins.values():
        assert sum(x.n_tokens for x in rows_) <= cap and len(rows_) <= segments
        lossy = [x.n_loss for x in rows_ if x.n_loss]
        assert sum(lossy) <= loss or len(lossy) == 1
    pieces = defaultdict(list)
    for x in got:
        if x.container == container:
            pieces[x.doc_id].append(x)
    for i, t in texts.items():
        n, p = len(plain.encode_ordinary(t or "")), sorted(pieces[i], key=lambda x: x.piece)
        assert sum(x.n_tokens for x in p) == n and len(p) == max(1, -(-n // cap)) and [x.from_token for x in p] == [k * cap for k in range(len(p))]
        assert (p[0].bin is None) == (n == 0) and all(0 <= x.n_loss <= x.n_tokens for x in p)
    assert set(pieces) == set(texts)
    return bins


CAPS = [("s", "byte_bpe_50k", 128), ("s", "byte_bpe_50k", 128), ("l", "byte_bpe_50k", 512), (None, None, None), ("bad", "byte_bpe_50k", 0)]


def test_packing(spark, plain):
    r = random.Random(1)
    texts = [" ".join(r.choice(["lamp", "wick", "the", "gate"]) for _ in range(r.randrange(1, 120))) + ("\nand then more" if i % 3 else "") for i in range(400)]
    texts[0], texts[1], texts[2], texts[3] = None, "", "word " * 1000, " word" * 256
    docs = spark.createDataFrame([*enumerate(texts), (None, " word" * 128), (None, " word" * 128), (None, "a b")], "doc_id bigint, text string").withColumn("bin", F.lit(3)).withColumn("n_tokens", F.lit(5))
    caps = spark.createDataFrame(CAPS, "container string, tokenizer string, capacity int")
    got = packing.packed(docs, caps, shard=150).collect()
    named = [x for x in got if x.doc_id is not None]
    for c, cap in (("s", 128), ("l", 512)):
        bins = _check(named, dict(enumerate(texts)), c, cap, max(packing.FEWEST, cap // packing.SEGMENT), int(cap * packing.LOSS), plain)
        total = sum(x.n_tokens for x in named if x.container == c)
        assert len(bins) <= 1.1 * -(-total // cap) + 3
    assert len(_by_bin([x for x in got if x.doc_id is None], "s")) == 3
    assert {r.container for r in packing.fill_report(docs, caps).collect()} == {"s", "l"}
    assert packing.packed(docs.limit(0), caps).isEmpty() and packing.packed(docs, caps.limit(0)).isEmpty()


def test_full_pieces_never_share_a_container(spark):
    big = (1 << 62) + 5
    docs = spark.createDataFrame([(i, " word" * 384) for i in (1, -1, 1 << 43, (1 << 43) + 1, big, None)], "doc_id bigint, text string")
    got = packing.packed(docs, spark.createDataFrame(CAPS[:1], "container string, tokenizer string, capacity int")).collect()
    assert len(got) == 18 and len({(x.shard, x.bin) for x in got}) == 18


def test_each_limit_of_packing_binds(spark, plain):
    r = random.Random(3)
    line = lambda n: " ".join(r.choice(["lamp", "wick", "the", "gate"]) for _ in range(n))
    texts = [line(r.randrange(1, 40)) + "\n" * (i % 4 > 0) + line(r.randrange(1, 60)) for i in range(300)]
    texts += [line(900), line(700) + "\n" + line(500), line(256) + "\n" + line(1), line(120), line(400) + "\n", None, *[line(1) for _ in range(400)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    caps = spark.createDataFrame(CAPS[:1], "container string, tokenizer string, capacity int")
    for segment, loss, limits in ((48, 0.75, (4, 96)), (8, 1.0, (16, 128)), (16, 0.9, (8, 115))):
        bins = _check(packing.packed(docs, caps, shard=200, segment=segment, loss=loss).collect(), dict(enumerate(texts)), "s", 128, *limits, plain)
        report = packing.fill_report(docs, caps, segment=segment, loss=loss).first()
        assert (report.max_segments, report.max_loss) == limits and report.n_bins >= report.least_bins
        full = [sum(x.n_tokens for x in b) == 128 for b in bins.values()]
        many = [len(b) == limits[0] for b in bins.values()]
        lossy = [sum(x.n_loss for x in b) >= limits[1] for b in bins.values()]
        assert any(full) and any(m and not f for m, f in zip(many, full)) and any(y and not f for y, f in zip(lossy, full)) | (loss == 1)
    # what bears loss is a parameter
    whole = packing.packed(docs, caps, prompt="").agg(F.sum("n_tokens"), F.sum("n_loss")).first()
    assert whole[0] == whole[1] > packing.packed(docs, caps).agg(F.sum("n_loss")).first()[0]
    assert packing.packed(docs, caps, prompt=r"(?s).*").agg(F.sum("n_loss")).first()[0] == 0


def test_fill_takes_the_item_that_uses_most_room():
    bins = packing.fill(np.array([100, 28, 60, 60, 8, 128 - 1]), np.array([10, 28, 60, 0, 8, 3]), 128, 4, 128)
    assert bins[0] == bins[1] and bins[2] == bins[3] == bins[4] and len(set(bins)) == 3
