import os

import pytest
from conftest import rows
from glossmill.llm import mainbody, quality, residue, truncation
from pyspark.sql import functions as F

BAD = {
    "message": ["Access denied. Reference: 0D2343", "<b>Bad Gateway</b> The server was unable to complete your request.", "HTTP status 502. A query failed and the connection was lost.", "Please enable JavaScript to view this article", "Loading Carl… If nothing happens, scripting may be disabled.", "YOU NEED TO ALLOW JAVASCRIPT IN YOUR BROWSER TO GO ON.", "Die gewünschte Seite wurde nicht gefunden.", "Cette page est introuvable ou n'existe plus.", "You must log in to see the contents of this entry.", "Lua error in Module:Infobox at line 22: attempt to index field (a nil entry).", "Carl is a delver. Something broke on our side!"],
    "slot": ["{{name}} is a {{race}}.", "Carl is a ${race} from ${place}.", "Carl belongs to %FACTION%.", "&lt;intro&gt; &lt;body&gt;", "[intro here] [body here]", "{% if x %}Carl{% endif %}", "Carl: [object Object].", "(none) was introduced in chapter (none).", "XXXX is the YYYY of Carl.", "[Editor: describe Carl in two sentences.]"],
    "filler": ["Lorem ipsum magna consectetur tempor aliqua dolor labore.", "Sample text. Sample text.", "Text goes here.", "TODO: write a summary for Carl.", "Blah blah blah, blah blah.", "Carl sample description number 43, not for publication.", "Name is a Race from Place of Origin, known for Reason.", "Write the first paragraph of your page here."],
}
GOOD = [
    "Carl is a delver who walks down the stairs with a cat.", "Carl told the court that access was denied to Donut, and that the gate was closed for maintenance of its hinges.", "“Lorem,” the dead language of the Salt Gallery, survives only in the motto of Carl.",
    "The seal of Carl reads { Donut } in curly brackets, a joke that only the archivists find funny.", "Carl costs $40 in Third Landing and 100% of the price goes to Donut [sic].", "Carl was once a placeholder on the throne, kept warm for Donut.",
    "Owners of Carl must prove that they are human before the box opens; Donut failed twice.", "Carl is a script-reading golem; the wardens enable it every evening and it refuses to open the page of any book.", "See: Carl", "The template of Carl, carved by Donut, is still used for every new insert.",
]


def test_residue(make):
    texts = [(t, kind) for kind, ts in BAD.items() for t in ts] + [(t, None) for t in GOOD] + [(None, None), ("", None), ("  ", None)]
    pages = make("pages", [{"pageid": i, "title": f"T{i}", "first_paragraph": t} for i, (t, _) in enumerate(texts)] * 2).withColumn("tokens", F.lit(1)).withColumn("path", F.lit("x"))
    entries = make("entries", [{"pos": 1, "title": "Z", "definition": GOOD[0]}, {"pos": 2, "title": "Y", "definition": BAD["message"][0]}, {"pos": 3, "title": "N"}])
    got = {(r.rec_table, r.rec_id): r.kind for r in residue.residue(pages, entries).collect()}
    assert got.pop(("entries", 2)) == "message"
    assert got == {("pages", i): k for i, (_, k) in enumerate(texts) if k}
    assert len(rows(residue.clean_records(pages, entries))) == len(GOOD) + 1
    assert rows(residue.residue_found(pages.limit(0), entries.limit(0))) == []


def test_template_tree():
    leaf = residue.Leaf()
    for i, x in enumerate(("please enable scripts to go on", "please enable js to go on", "please open the gate right now")):
        leaf.add(residue.masked(x)[1], 1, i, i)
    assert leaf.templates == [[["please", "enable", "<*>", "to", "go", "on"], 2, 0, 1, None], [["please", "open", "the", "gate", "right", "now"], 1, 2, 2, None]]
    assert residue.masked("Captain Carl met 40 cats at x.example")[0] == "7|captain|<*>|met" and residue.masked("GO BACK")[1] == ["go", "back"]
    found, whose = residue.buckets([["a", "<*>", "b"], [], ["a", "b"]])
    by = [sorted(found[whose == i].tolist()) for i in range(3)]
    assert [len(x) for x in by] == [4, 1, 5] and set(by[0]) < set(by[2]) and max(found) < residue.HASHED


def test_seeds_at_once_are_seeds_one_by_one():
    said = [residue.masked(t)[1] for ts in (*BAD.values(), GOOD) for t in ts] + [["+"], ["página", "solicitada", "no", "existe"]]
    assert residue.seeds_of(said) == [residue.seed_of(x) for x in said]


def test_residue_judged_before_merging(spark, make):
    turn = [f"Turn on {x}." for x in ("Carl and run", "Zev and run", "Javascript and reload", "Cookies and reload", "Donut and reload")]
    pages = make("pages", [{"pageid": i, "title": "x", "first_paragraph": t} for i, t in enumerate(turn)])
    want = [("pages", 2, "message"), ("pages", 3, "message")]
    none = make("entries", [])
    assert rows(residue.residue(pages.coalesce(1), none)) == rows(residue.residue(pages.repartition(4), none)) == want
    mined = {(tuple(r.tokens), r.seed, r.n) for r in residue.templates(residue.counted(residue.sentences(residue.records(pages, none)))).collect()}
    assert (("turn", "on", "<*>", "and", "reload"), "message", 2) in mined and sum(n for _, v, n in mined if v is None) == 3


def test_residue_learns_wordings(make):
    """Sentences that no pattern names but whose words messages have, about several titles; not in one title or ordinary words."""
    known = [f"The {x} could not be served by this server; try again in {i} minutes." for i, x in enumerate(("page", "article", "entry", "site", "address", "file", "request"))]
    known += [f"Database error {i}: the query failed on this server." for i in range(6)]
    news = "The server of this database could not answer in {} minutes."
    assert residue.seed_of(residue.masked(news)[1]) is None
    ordinary = [f"{a} the warden keeps a {b} lamp in the old hall of {c}." for a in ("Orrin", "Tamsin", "Wick", "Brell") for b in ("brass", "clay", "tin", "glass") for c in ("Salt", "Rope", "Moss", "Bell")]
    texts = known + [news.format(4), news.format(9)] + ordinary
    pages = make("pages", [{"pageid": i, "title": f"T{i}", "first_paragraph": t} for i, t in enumerate(texts)])
    assert {r[1] for r in rows(residue.residue_found(pages, make("entries", [])))} == set(range(len(known) + 2))
    one = pages.withColumn("title", F.lit("T"))
    assert {r[1] for r in rows(residue.residue_found(one, make("entries", [])))} == set(range(len(known)))


def test_truncation(make):
    frames = ["{} was sold to the warden of the {} for twelve coins and a brass key.", "{} is a gilded item found in the {} that lets its owner mend any fish trap once a day.", "Nobody in the {} has seen {} since, and the reward is still unclaimed."]
    names = [f"{a}{b}" for a in ("Kar", "Dol", "Mi", "Ves", "Tor", "Gru") for b in ("nak", "tin", "bor", "sel")]
    texts = [f.format(a, b) + " " + frames[(i + 1) % 3].format(b, a) for i, f in enumerate(frames * 8) for a, b in [(names[i % 24], names[(i * 7 + 3) % 24])]]
    complete = [f"<b>{n}</b> is the oldest brewer in the {n}" for n in names] + [f"<b>{n}</b> stores ropes, lamps, chalk, etc." for n in names[:4]]
    cut = [texts[0][:70], texts[1][:101], texts[2][:93] + "…", texts[3][:88] + " [more]", texts[4] + " Nobody in the <b", texts[5] + " The <i>end", texts[6] + " coins &amp"]
    values = texts + complete + cut + ["See: Carl", "Please enable JavaScript to view", None, "", "   "]
    pages = make("pages", [{"pageid": i, "title": "x", "url": "https://h.example/wiki/x", "first_paragraph": t} for i, t in enumerate(values)] * 2).withColumn("h", F.lit(1))
    entries = make("entries", [{"pos": i, "title": "x", "url": None, "definition": t} for i, t in enumerate(cut)])
    want = set(range(len(texts) + len(complete), len(texts) + len(complete) + len(cut)))
    got = rows(truncation.truncated_found(pages, entries))
    assert {k for t, k in got if t == "pages"} == want and {k for t, k in got if t == "entries"} == set(range(len(cut)))
    rates = {(r.host, r.rec_table): r.n_truncated for r in truncation.truncation_rates(pages, entries).collect()}
    assert rates == {("h.example", "pages"): len(cut), ("", "entries"): len(cut)}
    assert rows(truncation.truncated_found(pages.limit(0), entries.limit(0))) == []


def test_truncation_counts_equal_texts_once(make):
    other = [f"The {w} stair was closed by the warden." for w in "abcdefgh"]
    copied = "Every floor has keepers of the gate and they open it at dawn."
    def odds(copies):
        pages = make("pages", [{"pageid": i, "title": "x", "url": "https://h.example/x", "first_paragraph": t} for i, t in enumerate([*other, "Ten keepers of the gate", "Two keepers of the gate", "Six keepers of the gate", *[copied] * copies])])
        entries = make("entries", [{"pos": i, "title": "x", "definition": copied} for i in range(copies - 1)])
        return rows(truncation.scored(pages, entries), "rec_id", "odds")
    assert len(odds(1)) == 3 and odds(40) == odds(1)


def test_truncation_by_several_filters(make):
    words = [f"{a}{b}" for a in ("lamp", "wick", "moss", "rope") for b in ("gate", "hall", "stair", "well")]
    texts = [f"The {a} by the {b} was closed at dawn by order of the {c}" for a in words for b in words[:4] for c in words[:3]]
    pages = make("pages", [{"pageid": i, "title": "x", "url": "https://h.example/x", "first_paragraph": t + ("." if i % 3 else "")} for i, t in enumerate(texts)])
    one, many = (rows(truncation.scored(pages, make("entries", []), bits), "rec_id", "odds") for bits in (truncation.MOST_BITS, 1 << 6))
    assert len(one) == len(texts) // 3 and one == many and any(odds is not None for _, odds in one)


def test_truncation_after_an_abbreviation(make):
    whole = [f"The {w} hall was led by Mr. Orrin of the {w} gate." for w in ("salt", "rope", "moss", "bell", "tin", "clay")]
    pages = make("pages", [{"pageid": i, "title": "x", "url": "https://h.example/x", "first_paragraph": t} for i, t in enumerate([*whole, "The brass hall was led by Mr."])])
    assert rows(truncation.truncated_found(pages, make("entries", []))) == [("pages", len(whole))]


def test_truncation_leaves_out_all_cases_of_residue(make):
    texts = [(1, "Carl sold the <b"), (1, "Please enable JavaScript to view this article"), (2, "Turn on Carl and run. Then <b"), (3, "Turn on Javascript and reload. Then <b"), (4, "Turn on Zev and reload. Then <b"), (5, "Turn on Cookies and reload."), (6, "Turn on Donut and run."), (7, "Loading Carl… If nothing happens, scripting may be disabled. <i"), (8, "The stair is open. <b")]
    pages = make("pages", [{"pageid": i, "title": "x", "url": "https://h.example/x", "first_paragraph": t} for i, t in texts])
    none = make("entries", [])
    cases = {r[1] for r in rows(residue.residue_found(pages, none))}
    assert cases == {1, 3, 5, 7}
    assert {r[1] for r in rows(truncation.truncated_found(pages, none))} == {1, 2, 3, 4, 7, 8} - cases
    alone = [residue.residue_of(residue.records(pages.where(f"pageid = {i}"), none)) for i in (2, 3, 4)]
    assert [d.count() for d in alone] == [0, 1, 0]  # the same verdicts without the other records


def _page(i, host, wrap, promo="Support us with a small gift.", flat=False):
    names = ["Carl", "Donut", "Mordecai", "Katia", "Prepotente", "Odette", "Zev"]
    a, b = names[i % 7], names[(i * 3 + 1) % 7]
    w = "abcdefghij"[i // 10] + "klmnopqrst"[i % 10] + "ix"  # a word of its own for each page
    body = [f"<p><b>{a} {w}</b> met {b} near the {w} stair and never forgave it.</p>", f"<h2><span id='S'>Story</span></h2><p class='x'>Once {b} of floor {w} sold a {w} lamp.</p>", f"<blockquote><p>“{a} said {w}”</p></blockquote>"]
    teaser = f"<h3>Popular pages</h3><p>Read how {b} lost the {w} key.</p>"
    foot = "<p>Terms of use. Privacy. Imprint.</p>"
    if flat:
        return f"<html><body><p>We set cookies.</p><h1>{a}</h1>{body[0]}<p>{promo}</p>{body[1]}{body[2]}{teaser}<hr>{foot}</body></html>"
    w = wrap  # prefix of the host's classes
    return f"<html><head><script>x='<p>no</p>'</script></head><body><!-- <p>no</p> --><div class='{w}c'><p>We set cookies.</p></div><div class='{w}m'><h1>{a}</h1>{body[0]}<div class='{w}p'><p>{promo}</p></div>{body[1]}{body[2]}</div><div class='{w}r'>{teaser}</div><div class='{w}f'>{foot}</div></body></html>"


def test_main_body(make):
    pages, want = [], set()
    for h, wrap, flat in (("a.example", "k", False), ("b.example", "z", False), ("c.example", "", True)):
        for i in range(30):
            pid = len(pages) + 1
            pages.append({"pageid": pid, "url": f"https://{h}/wiki/{i}", "raw_html": _page(i, h, wrap, flat=flat)})
            want |= {(pid, 2), (pid, 4), (pid, 5)}
    extra = [{"pageid": 1, "url": "https://a.example/wiki/0", "raw_html": None}, pages[3], {"pageid": 900, "url": "https://a.example/x", "raw_html": ""}, {"pageid": 901, "url": None, "raw_html": "<h1>T<p>open <b>text"}, {"pageid": None, "raw_html": "<p>x</p>"}]
    df = make("pages", pages + extra).withColumn("slot", F.lit(1)).withColumn("text", F.lit("x"))
    got = {r for r in rows(mainbody.main_body(df)) if r[0] != 901}
    assert got == want
    assert rows(mainbody.main_body(df.limit(0))) == []


def test_tree_matching():
    t = lambda s, *c: mainbody.Node.unpack([s, 0, [x.pack() for x in c]])
    a = t("body", t("nav"), t("div", t("p"), t("q")), t("foot"))
    b = t("body", t("div", t("q")), t("ad"), t("foot"))
    assert mainbody.matching(a, b)[0] == 4
    mainbody.unite(a, b)
    assert [c.label for c in a.children] == ["nav", "div", "ad", "foot"]
    assert mainbody.mapped(a, t("body", t("div"), t("new"), t("foot"))) == [0, 2, 0, 6]
    _, ps = mainbody.page_of("<TABLE><TR><TD><P>a<P>b<UL><LI>c</UL></TD></TR></TABLE><p>d", "h")
    assert [p[0] for p in ps] == [1, 2, 3]


def test_quality(spark):
    common = spark.createDataFrame([("en", w, i) for i, w in enumerate("the of and to a in is was that it for on with as he she they by at from his her be had not but or are this were which have who".split(), 1)] + [("de", w, i) for i, w in enumerate("der die und in den von zu das mit nicht ist".split(), 1)], "lang string, word string, freq_rank int")
    prose = ["Carl was a delver who walked down the stairs with a cat. He had not been there before, but the warden was kind to him.", "Carl: I think that the chapter with Donut was the best one.\nDonut: You are right, but it is not the end of it.", "We were eleven when we started and we are fewer than we know\nSo sing for the lamp and the one who let it go\nOh carry me down to the hall where the warden lies asleep", "Rain again. Bell Shaft flooded, eleven families moved upstairs.\nCook Bahin reports nine golem sightings near the stair, nobody hurt.", "I agree with this.", "Der Wächter ist alt und die Treppe ist nicht mehr da. Das war mit den anderen nicht zu sehen.", "It is here, and it was theirs.\n\n- a lamp\n- a key\n\nThey took all of it with them and left by the old stair that was closed."]
    rest = ["- a lamp\n- wary bell jar\n- fog bottle x3\n- Carl", "1. How Carl came to the hall\n2. In which Donut is proud\n3. What was under the lamp", "Carl,cook,66,acid\nDonut,diver,12,frost\nZev,host,9,ember", "{| class=\"wikitable\"\n! Name !! Role\n|-\n| Carl || cook\n|-\n| Donut || diver\n|}", "+>;;$!*~?~_|#!<?!->?^=<_~<*>&-^#%#&$!%.&;*=~^!-$$?%;<;$", "wax seal! " * 40, "T h e  o l d  s t a i r  w a s  c l o s e d  b y  t h e  w a r d e n", "https://a.example/w/1\nhttps://b.example/w/2\nhttps://c.example/w/3", "Home | Help | Maps | Shop | Help | Forums | Maps | Log in | Register | Home", "Here is what was in it, as they said.\n\na lamp\nbell jar\nfog bottle\niron key\nwary cat\nold map\nsalt stove\ntin whistle\npaper blade\nclay pipe\nwooden hand"]
    docs = [(i, t) for i, t in enumerate(prose + rest)] + [(100, None), (101, ""), (102, " \n ")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("s")).withColumn("n_words", F.lit("clash"))
    q = {r.doc_id: r for r in quality.quality(df, common).collect()}
    assert {i: q[i].profile for i in range(len(prose))} == {i: "prose" for i in range(len(prose))}
    assert {r.doc_id for r in quality.not_prose(df, common).collect()} == set(range(len(prose), len(prose) + len(rest)))
    assert q[100].profile is None and q[101].n_words == 0 and q[102].n_lines == 0 and q[5].best_lang == "de"
    assert quality.quality(df.limit(0), common).isEmpty() and quality.quality(df, common.limit(0)).count() == len(docs)
    assert quality.divergence(quality.np.array([1.0, 0]), quality.np.array([0.0, 2])) == 1.0


def test_moving_variety_counts_windows():
    import random

    r = random.Random(5)
    texts = [[r.choice("abcdefg") for _ in range(n)] for n in (0, 1, 2, 9, 10, 11, 40, 200)]
    want = [1.0 if not t else len(set(t)) / len(t) if len(t) <= 10 else sum(len(set(t[i : i + 10])) for i in range(len(t) - 9)) / (len(t) - 9) / 10 for t in texts]
    assert quality.moving_variety(texts, 10).tolist() == pytest.approx(want)
    assert quality.moving_variety([], 10).tolist() == [] and quality.moving_variety([[]]).tolist() == [1.0]


def test_structural_centres_follow_clear_texts_only():
    q = quality.Profiles({}, {})
    seeds = q.centres.copy()
    lists, prose = quality._NAMES.index("list"), quality._NAMES.index("prose")
    clear, unclear = seeds[lists] + 0.02, (seeds[lists] + seeds[lists + 1]) / 2
    q.fit(quality.np.array([clear] * 300 + [unclear] * 300 + [seeds[prose] + 0.02] * 300))
    assert q.centres[lists] == pytest.approx((quality.PRIOR * seeds[lists] + 300 * clear) / (quality.PRIOR + 300))
    moved = (q.centres != seeds).any(1)
    assert moved[lists] and moved.sum() == 1
    q.fit(quality.np.zeros((0, 7)))
    assert not quality.np.isnan(q.centres).any()


def test_structural_centres_are_fitted_to_all_documents(spark):
    """The 20,000 documents with the smallest hashes are prose, so that the other kinds are seen in all of them only."""
    import random

    r, np = random.Random(7), quality.np
    common = spark.createDataFrame([("en", w, i) for i, w in enumerate("the of and to was it they were".split(), 1)], "lang string, word string, freq_rank int")
    items = ["a lamp", "bell jar", "iron key", "old map", "clay pipe", "tin whistle", "Zev, cook, 12, acid", "+>;;$!*~", "wax seal!"]
    prose = "They were at the old stair, and it was closed."
    mixed = [" ".join([prose] * r.randint(0, 3)) + "\n" + "\n".join(f"- {x}" if r.random() < 0.5 else x for x in r.choices(items, k=r.choice((1, 4, 9)))) for _ in range(12_000)]
    df = spark.createDataFrame(list(enumerate([prose] * 30_000 + mixed)), "doc_id bigint, text string").repartition(5)
    df = df.where((F.col("doc_id") < 30_000) == (F.xxhash64("doc_id", F.length("text").cast("bigint")) < 1 << 62))
    ids, texts = zip(*df.collect())
    assert sum(i < 30_000 for i in ids) >= 20_000
    measured = quality.pa.Table.from_batches(quality._measure(quality.Lexicon([tuple(x) for x in common.collect()]))([quality.pa.RecordBatch.from_pydict({"doc_id": ids, "text": texts})])).to_pylist()
    sums = {x["best_lang"]: x for x in measured if x["of"] == "prose"}
    rows = [x for x in measured if x["of"] == "doc" and x["shares"]]
    q = quality.Profiles(*({k: np.array(x[part]) for k, x in sums.items()} for part in ("words", "classes")))
    places = q.places({k: np.array([x[k] for x in rows], float) if k in ("shares", "words", "classes") else [x[k] for x in rows] for k in rows[0]})
    q.fit(places)
    nearest = (quality._WEIGHTS * (q.centres[None] - places[:, None]) ** 2).sum(2).argmin(1)
    want = {x["doc_id"]: quality._KIND.get(quality._NAMES[k], "junk") for x, k in zip(rows, nearest)}
    assert len(set(want.values())) > 2
    assert {x.doc_id: x.profile for x in quality.quality(df, common).collect() if x.profile} == want


def test_structural_centres_do_not_hang_on_the_size_of_the_table():
    r = quality.np.random.default_rng(3)
    seeds = quality.Profiles({}, {}).centres
    places = seeds[r.integers(0, len(seeds), 30_000)] + r.normal(0, 0.05, (30_000, 7))
    one, many = quality.Profiles({}, {}), quality.Profiles({}, {})
    one.fit(places)
    many.fit(quality.np.tile(places, (4, 1)))
    assert many.centres == pytest.approx(one.centres, abs=1e-9) and (one.centres != seeds).any()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_queries_run(spark):
    from glossmill.llm import queries

    for name, f in queries.queries().items():
        if name.endswith(("_found", "_packed", "_ids")):
            assert f(spark, "/root/testdata/sf0.001").count() > 0, name
