import pytest
from conftest import rows
from glossmill.functions import markup as M
from glossmill.functions import text as X
from glossmill.operators import summaries
from pyspark.sql import functions as F


def test_inline():
    assert M.sanitize_inline("<strong>Lamp</strong> <a href='x'>oil &amp; wick</a> <em>lit") == "<b>Lamp</b> oil &amp; wick <i>lit</i>"
    assert M.sanitize_inline("<i>one <b>two</i> three</b>") == "<i>one <b>two</b></i> three"
    assert M.plain_inline("<b>Wick</b>&nbsp;&lt;b&gt; ﬂint") == "Wick <b> flint" and M.plain_inline(None) == ""
    assert M.bold_phrases("<b>Tall <b>lamp</b></b> by <strong> the sea </strong><b></b><b>never closed") == ["Tall lamp", "the sea"]
    assert M.sanitize_inline("7 < 9 <b") == "7 &lt; 9 &lt;b"


def test_pieces_and_regions():
    page = M.Page(M.pieces_of('<!-- <p> --><div a=1 B="x>y" c><DIV>in</div>out</div><br><p/><script>if (a<b) "</p>"</script>end'))
    assert [(p.kind, p.tag) for p in page.pieces] == [("open", "div"), ("open", "div"), ("text", ""), ("close", "div"), ("text", ""), ("close", "div"), ("lone", "br"), ("shut", "p"), ("open", "script"), ("text", ""), ("close", "script"), ("text", "")]
    assert page.pieces[0].given == {"a": "1", "b": "x>y", "c": ""} and page.pieces[9].text == 'if (a<b) "</p>"'
    assert list(page.regions(lambda p: p.tag == "div")) == [(0, 5)] and page.text(0, 5) == "inout"
    assert page.ends[1] == 3 and M.Page(M.pieces_of("<p>a<p>b</p>")).ends == {2: 4, 0: 5}


def test_blocks():
    html = '<div class="dcc-highlight">SPOILERS</div><p>System Message. Unread.</p><aside class="portable-infobox"><p>side</p></aside><blockquote><p>said</p></blockquote><p>A <strong>lamp</strong> that<br>stands.</p><h2><span id="Uses">Uses</span></h2><p>It is lit at dusk.</p>'
    assert M.summary_blocks(html) == {"intro": ["A <b>lamp</b> that stands."], "later": ["It is lit at dusk."]}
    loose = "Without a paragraph <strong>of</strong> its <em>own</em>.<table><tr><td>cell</td></tr></table>too short"
    assert M.summary_blocks(loose)["intro"] == ["Without a paragraph <b>of</b> its <i>own</i>."]
    assert M.summary_blocks(None) == {"intro": [], "later": []} == M.summary_blocks("<p></p><sup>1")
    assert M.summary_blocks('<h3><span id="Description">D</span></h3><p>Still at the begin.</p>')["intro"] == ["Still at the begin."]


def test_blocks_of_broken_pages():
    # a further paragraph discards what the one it stands in had; emphasis that is left open goes on
    assert M.summary_blocks("<p>gone <b>bold<p>kept</b> text</p>")["intro"] == ["kept</b> text"]
    assert M.summary_blocks("<p>never closed") == {"intro": [], "later": []}
    assert M.summary_blocks('<div class="mw-collapsible"><div>no</div>no</div><p>yes</p>')["intro"] == ["yes"]
    assert M.summary_blocks('<div class="gallery"><p>never shown')["intro"] == []


FIELDS = '<aside class="portable-infobox"><div class="pi-item pi-data" data-source="race"><h3 class="pi-data-label">Race</h3><div class="pi-data-value">Moth folk [3]</div></div><div class="pi-data" data-source="occupation"><div class="pi-data-value">Lamplighter</div></div><div class="pi-data" data-source="aliases"><div class="pi-data-value">Dusk<br />Old Wick<br>The Snuffer<ul><li>Tallow</li></ul></div></div><div class="pi-data" data-source="shoe size"><div class="pi-data-value">9</div></div></aside>'


def test_infobox_and_sidebar():
    assert M.infobox_summary("Orrin", FIELDS) == "Orrin: race/species: Moth folk [3]; occupation: Lamplighter."
    assert M.sidebar_details(FIELDS) == [{"label": "Aliases", "value": "Dusk; Old Wick; The Snuffer; Tallow"}, {"label": "Race", "value": "Moth folk"}]
    assert M.infobox_summary("Orrin", "<p>none</p>") == "" and M.sidebar_details(None) == [] == M.sidebar_details(FIELDS.replace("portable-infobox", "portable-infobox2"))
    twice = FIELDS.replace("</aside>", '<div class="pi-data" data-source="species"><div class="pi-data-value">Late</div></div></aside>')
    assert M.infobox_summary("Orrin", twice) == M.infobox_summary("Orrin", FIELDS)
    assert [d["value"] for d in M.sidebar_details(twice) if d["label"] == "Race"] == ["Late", "Moth folk"]


def test_notice():
    assert M.spoiler_notice('<div class="dcc-highlight">Volume 2 <i>Spoiler</i>!</div> after') == "Volume 2 Spoiler!"
    assert M.spoiler_notice('<div class="dcc-highlight">Welcome</div>') is None and M.spoiler_notice(None) is None


def test_trim():
    text = "<b>Orrin</b> lights lamps. " + "Each of them burns until the bell rings twice at the gate. " * 3
    assert M.trim_inline(text, 10) == "<b>Orrin</b> ligh"
    assert M.trim_inline(text, 3) == "<b>Orr</b>"
    assert M.plain_inline(M.trim_inline(text, 85)) == "Orrin lights lamps. Each of them burns until the bell rings twice at the gate."
    assert M.trim_inline("short", 10) == "short" and M.trim_inline(None, 5) == ""


def test_ai():
    html = '<h2><span class="x" id="AI_Description">AI Description</span></h2><blockquote><p><b>Orb</b></p><p>Range: 5</p><p>It hums at noon.</p></blockquote><h2>Next</h2><p>later</p>'
    assert M.ai_paragraph(html) == "It hums at noon."
    assert M.ai_paragraph(html.replace("AI_D", "D")) == "" and M.ai_paragraph(None) == ""


def test_summaries(make):
    pages = [
        {"pageid": 1, "title": "Orrin", "raw_html": "<p>Orrin is a lamplighter who walks and</p><p>He never carries a match.</p>", "status": "ok"},
        {"pageid": 2, "title": "Orb", "raw_html": '<p>Orb is an item.</p><h2><span id="AI_Description">AI Description</span></h2><p>It hums, they say.</p>', "status": "ok"},
        {"pageid": 3, "title": "Wick", "raw_html": '<p>Wick is.</p><h2><span id="S">S</span></h2><p>A later block of text.</p>', "status": "empty"},
        {"pageid": 4, "title": "None", "raw_html": "<p></p>", "status": "ok"}, {"pageid": 5, "title": "Null", "status": "ok"}, {"pageid": 6, "title": "Err", "raw_html": "<p>Text.</p>", "status": "error"},
    ]
    out = {r.pageid: (r.status, r.summary) for r in summaries.reextracted(make("pages", pages)).collect()}
    assert out == {1: ("ok", "Orrin is a lamplighter who walks and he never carries a match."), 2: ("ok", "It hums, they say."), 3: ("ok", "A later block of text."), 4: ("empty", "")}
    assert summaries.reextracted(make("pages", [])).isEmpty()


def test_long_text_keeps_its_end(spark):
    text = "Word " * 300_000 + "end"
    assert spark.createDataFrame([(text,)], "t string").select(F.length(summaries.lower_first(F.col("t")))).first()[0] == len(text)


@pytest.mark.parametrize(("text", "want"), [("Lit [2] isa god of . Bright , too.", "Lit is a god. Bright, too."), ("x  y z For more information: Lamps", "x y z"), ("", ""), (None, None)])
def test_artifacts(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(X.without_artifacts(F.col("t"))).first()[0] == want


def test_words(spark):
    cases = {"lamp": "la", "q": "qa", " 77": "11", "k 9": "ka", "ж": "ж", "灯": "灯a", "": "11", "Òr": "òr", "+x": "11"}
    df = spark.createDataFrame([(k,) for k in cases], "w string")
    assert {r.w: r.p for r in df.select("w", X.kobo_prefix(F.col("w")).alias("p")).collect()} == cases
    df = spark.createDataFrame([("It burns. All night",), ("Dark",), ("",)], "t string")
    assert rows(df.select(X.first_sentence(F.col("t")).alias("s"))) == [("",), ("Dark",), ("It burns.",)]


def test_versions_and_names(spark):
    df = spark.createDataFrame([("v3.4.5",), ("3.4.5-rc.2",), ("03.4.5",), ("3.4",), ("3.4.5-02",), (None,)], "t string")
    assert [r.v and (r.v.major, r.v.prerelease, r.v.tag) for r in df.select(X.version(F.col("t")).alias("v")).collect()] == [(3, None, "v3.4.5"), (3, "rc.2", "v3.4.5-rc.2"), None, None, None, None]
    assert spark.range(1).select(X.identifier(F.lit(" Lamp Book! 2.0 "))).first()[0] == "Lamp-Book-2.0"
    with pytest.raises(Exception, match="empty identifier"):
        spark.range(1).select(X.identifier(F.lit("??"))).collect()
