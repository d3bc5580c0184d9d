from datetime import datetime as D

from conftest import rows
from glossmill.functions import text as X
from glossmill.operators import index, links, store
from pyspark.sql import functions as F

T = [D(2024, 1, d) for d in range(1, 20)]


def test_store(make, spark):
    p = [
        {"pageid": 1, "title": "A", "status": "ok", "first_paragraph": "good", "fetched_at": T[0]}, {"pageid": 1, "title": "A2", "status": "error", "error": "boom", "fetched_at": T[1]},
        {"pageid": 2, "title": "B", "status": "error", "error": "x", "fetched_at": T[0]}, {"pageid": 3, "title": "C", "status": "empty", "fetched_at": T[2]}, {"pageid": None, "title": "N", "status": "ok"},
    ]
    pages = make("pages", p)
    good = {r.pageid: (r.title, r.status, r.first_paragraph, r.last_attempt_error, r.error) for r in store.last_known_good(pages).collect()}
    assert good == {1: ("A2", "ok", "good", "boom", None), 2: ("B", "error", None, None, "x"), 3: ("C", "empty", None, None, None)}
    assert {r.pageid: r.title for r in store.upsert(make("pages", []), pages).collect()} == {1: "A2", 2: "B", 3: "C"}
    assert rows(store.still_to_fetch(pages.select("pageid"), pages), "pageid") == [(None,), (2,), (3,)]
    listing = spark.createDataFrame([(1, "Characters", 0), (1, "Groups", 2), (1, "Characters", 5), (9, "Groups", 1)], "pageid bigint, category string, seq int")
    listed = store.listed_categories(listing)
    assert rows(listed) == [(1, "Characters, Groups", 0), (9, "Groups", 1)]
    scope = {(r.pageid, r.title): (r.in_scope, r.source_category) for r in store.synced_scope(pages, listed).collect()}
    assert scope[1, "A"] == (1, "Characters, Groups") and scope[2, "B"] == (0, None)
    r = make("redirects", [{"source_title": "AI", "target_title": "a"}, {"source_title": "O", "target_title": "Out"}, {"source_title": "X"}])
    assert rows(store.classified_redirects(r, pages.select("title")), "source_title", "target_title", "status") == [("AI", "A", "ok"), ("O", "Out", "ignored"), ("X", None, "error")]
    assert store.crawl_counts(pages).first().n_error == 2
    assert rows(store.chunks(spark.createDataFrame([(str(i),) for i in range(5)], "v string"), "v", 2)) == [(0, "0|1"), (1, "2|3"), (2, "4")]


def test_orders_and_offsets(spark):
    words = spark.createDataFrame([(w, "d" * (i + 1)) for i, w in enumerate(["beta", "Alpha", "alpha", "Éclair", "Zulu"])], "word string, definition string")
    out = index.index_rows(words).orderBy("ordinal").collect()
    assert [r.word for r in out] == ["Alpha", "alpha", "beta", "Zulu", "Éclair"]
    assert [(r.offset, r.size) for r in out] == [(0, 2), (2, 3), (5, 1), (6, 5), (11, 4)]
    big = spark.range(5000).select(F.format_string("%05d", F.pmod(F.col("id") * 7919, F.lit(5000))).alias("w"))
    got = index.ranked(big, [F.col("w")], "r").collect()
    assert all(int(x.w) + 1 == x.r for x in got)
    assert index.ranked(words.limit(0), [F.col("word")], "r").isEmpty()


def test_violations_and_sections(spark):
    rows_ = spark.createDataFrame([("A", 0, 0, 5), ("a", 1, 5, 0), ("B" * 256, 2, 5, 5)], "word string, ordinal bigint, offset bigint, size bigint")
    syn = spark.createDataFrame([("b", 9), ("A", 0)], "word string, ordinal bigint")
    found = {(r.check, r.word[:1]) for r in index.index_violations(rows_, syn, 8).collect()}
    assert found == {("headwords fold alike", "A"), ("definition outside the data", "a"), ("definition outside the data", "B"), ("invalid headword", "B"), ("synonym is a headword", "A"), ("synonym without entry", "b")}
    e = spark.createDataFrame([(1, "1914"), (2, "Éclair"), (3, "Earth"), (4, "-Zed"), (5, "Epsilon")], "rank bigint, title string")
    assert [(r.rank, r.label) for r in index.sections(e).orderBy("rank").collect()] == [(1, "#"), (2, "E"), (4, "Z"), (5, "E")]


def test_mentions(make):
    e = make("pos bigint, title string, plain string", [
        {"pos": 1, "title": "Carl", "plain": "Carl talks to Donut and Mordecai. Carl and Princess Donut met Donut."}, {"pos": 2, "title": "Donut", "plain": None},
        {"pos": 3, "title": "Princess Donut", "plain": "Donut, Carlos and Carl-like Carl"}, {"pos": 4, "title": "AI", "plain": "AI Donutx"}, {"pos": 5, "title": None, "plain": ""},
    ])
    assert rows(links.mentions(e), "pos", "target") == [(1, "Donut"), (1, "Princess Donut"), (3, "Carl"), (3, "Donut")]
    assert links.mentions(e.limit(0)).isEmpty()


def test_forms(spark):
    df = spark.createDataFrame([("See: A.",), ("please see B..",), ("no",), (None,)], "t string")
    assert [r[0] for r in df.select(X.forward_target(F.col("t"))).collect()] == ["A", "B", None, None]


def test_mentions_of_titles_of_any_begin(make):
    titles = ["the Pit", "“Old Lamp”", "地下城之門", "Carl", "1000 Delvers"]
    e = make("pos bigint, title string, plain string", [{"pos": i, "title": t, "plain": "x"} for i, t in enumerate(titles)] + [{"pos": 9, "title": "Z", "plain": "In the Pit Carl sold “Old Lamp” to 1000 Delvers of 地下城之門, not The Pit."}])
    assert sorted(r.target for r in links.mentions(e).collect()) == sorted(titles)


def _by_rule(texts, titles):
    """Mentions by one pattern of all titles, the longest first, over each text."""
    import re

    wanted = sorted({t for t in titles if t and (len(t) >= 4 or re.search("[ '-]", t))}, key=len, reverse=True)
    by, out = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, wanted)) + r")(?!\w)"), set()
    for pos, title, text in texts:
        out |= {(pos, m[0]) for m in by.finditer(text or "") if m[0] != title}
    return sorted(out)


def test_mentions_by_the_rule(make):
    titles = ["Alpha Beta", "Beta Gamma Delta", "Delta Epsilon", "Ring of Power", "Power", "eBook Reader Guild", "Reader", "'Tis House", "Who?", "of", "C-3", "Reader Guild", "Épée", "a b"]
    texts = ["Alpha Beta Gamma Delta Epsilon", "Ring of Power is worn. Power!", "An eBook Reader Guild, a Reader.", "It's 'Tis House; x'Tis House.", "Who?x Who? of C-3 C-30", "Ring of Power", "Épée Épées Reader Guild a b a b", "", None]
    e = [{"pos": i, "title": t, "plain": texts[i] if i < len(texts) else f"{titles[i - 3]} {titles[i - 1]}x {t}"} for i, t in enumerate(titles)]
    e.append({"pos": 50, "title": "Ring of Power", "plain": texts[1]})
    got = rows(links.mentions(make("pos bigint, title string, plain string", e)), "pos", "target")
    assert sorted(got) == _by_rule([(x["pos"], x["title"], x["plain"]) for x in e], titles)
    assert (0, "Delta Epsilon") in got and (50, "Power") in got and (2, "eBook Reader Guild") in got


def test_redirects_are_replaced(make):
    from glossmill.operators import store

    old = make("redirects", [{"source_title": "a", "target_title": "T", "status": "ok"}, {"source_title": "b", "target_title": "T", "status": "ok"}])
    new = make("redirects", [{"source_title": "a", "target_title": "t"}, {"source_title": "c"}])
    titles = make("pages", [{"pageid": 1, "title": "T"}])
    show = lambda df: rows(df, "source_title", "target_title", "status")
    assert store.replaced_redirects(old, None, titles) is old
    assert show(store.replaced_redirects(old, new, titles)) == [("a", "T", "ok"), ("c", None, "error")]
    assert show(store.replaced_redirects(old, new, titles, most=True)) == [("a", "T", "ok"), ("b", "T", "ok"), ("c", None, "error")]
    kept = make("pages", [{"pageid": 1, "title": "T", "in_scope": 0, "last_attempt_error": "boom", "status": "ok"}, {"pageid": 2, "title": "U", "in_scope": 0}])
    fresh = make("pages", [{"pageid": 1, "title": "T", "status": "ok", "fetched_at": __import__("datetime").datetime(2024, 1, 1)}])
    assert rows(store.fetched_pages(kept, fresh), "pageid", "in_scope", "last_attempt_error") == [(1, 1, None), (2, 0, None)]


def test_ranks_in_groups_that_lie_in_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # partitions of a table as small as this one would be united
    try:
        _ranks_in_many_partitions(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _ranks_in_many_partitions(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2010, F.col("id").cast("string")).alias("g"), (F.col("id") * 7919 % 3001).alias("x"))
    got = index.ranked_within(df, "g", [F.col("x")], "r").collect()
    by = {}
    for r in sorted(got, key=lambda r: r.x):
        by.setdefault(r.g, []).append(r.r)
    assert len(got) == 3000 and all(v == list(range(1, len(v) + 1)) for v in by.values()) and len(by["hot"]) == 2000 and len(by[None]) == 990
    parts = index._parted(df, [F.col("g"), F.col("x")])
    assert max(r["count"] for r in parts.where("g = 'hot'").groupBy("_part").count().collect()) < 1500  # no task has the whole group


def test_coverage(spark):
    lines = ["lines   cov%   module   (path)", "  100    50%   a.b   (/r/a/b.py)", "   40   12.5%   a.c   (/r/a/c.py)", "  900   1%   z   (/other/z.py)", "   10   100%   a.t   (/r/a/tests/t.py)"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert rows(X.coverage(df, "/r/a", "/tests/")) == [(55, 140, 39)] and rows(X.coverage(df.limit(0), "/r")) == [(None, None, None)]


def test_page_latest_stores_all_pages(make, monkeypatch, tmp_path):
    from glossmill import queries
    from glossmill.operators import store

    make("pages", [{"pageid": i, "title": f"T{i}", "fetched_at": None} for i in (1, 2, 3)]).write.parquet(str(tmp_path / "pages.parquet"))
    sides = []
    upsert = store.upsert
    monkeypatch.setattr(store, "upsert", lambda a, b: sides.append((a.count(), b.count())) or upsert(a, b))
    assert queries.page_latest(make("pages", []).sparkSession, str(tmp_path)).count() == 3 and sides == [(3, 3)]
