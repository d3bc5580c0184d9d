import json
import sqlite3
import struct
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from conftest import rows
from glossmill.plans.config import project_from
from glossmill.sources import dictionaries as D
from glossmill.sources import mediawiki as W
from glossmill.sources.sqlite import read_sqlite
from pyspark.sql import functions as F


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "s.sqlite")
    conn = sqlite3.connect(path)
    conn.execute("CREATE TABLE pages (pageid INTEGER PRIMARY KEY, title TEXT, in_scope INTEGER)")
    conn.executemany("INSERT INTO pages VALUES (?, ?, ?)", [(i * 10, f"T{i}", i % 2) for i in range(1, 101)])
    conn.commit()
    conn.close()
    df = read_sqlite(spark, path, "pages", 5)
    assert df.count() == 100 and df.where("in_scope = 1").count() == 50 and dict(df.dtypes) == {"pageid": "bigint", "title": "string", "in_scope": "bigint"}
    some = read_sqlite(spark, path, "pages", 3, columns=["pageid", "title", "no such"])
    assert some.columns == ["pageid", "title"]
    few = some.where("pageid >= 20 AND pageid IN (10, 20, 30, 500) AND title IS NOT NULL AND title = 'T3'")
    assert rows(few) == [(30, "T3")] and some.where("title > 'T98'").count() == 1
    assert "Filter " not in few._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        read_sqlite(spark, path, "redirects")
    with pytest.raises(FileNotFoundError):
        read_sqlite(spark, str(tmp_path / "no"), "pages")
    assert not (tmp_path / "no").exists()


@pytest.fixture
def words(spark):
    w = spark.createDataFrame([("Carl", "<p>c</p>"), ("Donut", "<p>dé</p>"), ("alpha", "<p>a</p>")], "word string, definition string")
    f = spark.createDataFrame([("Carl", 0, "Carl"), ("Carl", 1, "The Crawler"), ("Donut", 0, "Donut"), ("Donut", 1, "Princess & \"D\"")], "target string, ord int, form string")
    return w, f


def test_stardict(spark, words, tmp_path):
    assert D.write_stardict(tmp_path, "x", "Title", "Me", *words) == {"words": 3, "synonyms": 2}
    idx = D.scan_index(spark, str(tmp_path / "x.idx")).orderBy("ordinal").collect()
    assert [(r.word, r.offset, r.size) for r in idx] == [("alpha", 0, 8), ("Carl", 8, 8), ("Donut", 16, 10)]
    assert rows(D.scan_synonyms(spark, str(tmp_path / "x.syn"))) == [("Princess & \"D\"", 2), ("The Crawler", 1)]
    info = {r.key: r.value for r in D.scan_info(spark, str(tmp_path / "x.ifo")).collect()}
    assert info["wordcount"] == "3" and info["synwordcount"] == "2" and info["version"] == "2.4.2"
    with pytest.raises(ValueError):
        D.write_stardict(tmp_path / "y", "x", "T", "M", words[0].unionByName(words[0]), words[1])


def test_kobo(spark, words, tmp_path):
    path = str(tmp_path / "k.zip")
    assert D.write_kobo(path, *words) == 5
    got = D.scan_kobo(spark, path).collect()
    assert {(r.prefix, r.headword) for r in got} == {("ca", "Carl"), ("th", "Carl"), ("do", "Donut"), ("pr", "Donut"), ("al", "alpha")}
    assert next(r.variants for r in got if r.headword == "Donut") == ['princess & "d"']
    assert zipfile.ZipFile(path).read("words").decode().split("\n")[0] == "alpha"
    assert "@ Carl\n& The Crawler\n::\n<html><p>c</p>\n" in {r.block for r in D.dictfile_lines(*words).collect()}


def test_palm(spark, tmp_path):
    data = bytearray(1400)
    data[60:68] = b"BOOKMOBI"
    struct.pack_into(">H", data, 76, 3)
    for i, at in enumerate((104, 904, 1104)):
        struct.pack_into(">I", data, 78 + 8 * i, at)
    struct.pack_into(">H", data, 104 + 8, 1)
    m = 104 + 16
    data[m : m + 4] = b"MOBI"
    for at, v in ((4, 232), (12, 65001), (20, 7), (24, 1), (28, 1), (32, 1), (68, 300), (72, 5)):
        struct.pack_into(">I", data, m + at, v)
    data[404:409] = b"Title"
    (tmp_path / "a.mobi").write_bytes(bytes(data))
    (tmp_path / "b.mobi").write_bytes(b"junk")
    got = {r.path.rsplit("/", 1)[1]: r for r in D.scan_palm(spark, str(tmp_path)).collect()}
    assert got["a.mobi"].errors == [] and got["a.mobi"].title == "Title" and got["a.mobi"].records == 3
    assert got["b.mobi"].errors


class Handler(BaseHTTPRequestHandler):
    failed = 0

    def do_GET(self):
        if self.path == "/robots.txt":
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b"User-agent: banned\nDisallow: /\n")
            return
        q = {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
        if q.get("list") == "categorymembers":
            first = "cmcontinue" not in q
            body = {"query": {"categorymembers": [{"pageid": 1 if first else 2, "title": "A" if first else "B", "ns": 0}]}} | ({"continue": {"cmcontinue": "x"}} if first else {})
        elif q.get("generator"):
            body = {"query": {"pages": {"1": {"title": "Old"}, "2": {"title": "alias"}}}}
        elif "titles" in q:
            body = {"query": {"redirects": [{"from": "Old", "to": "New"}]}}
        else:
            if q["pageid"] == "7" and Handler.failed < 1:
                Handler.failed += 1
                self.send_response(503)
                self.end_headers()
                return
            if q["pageid"] == "404":
                self.send_response(404)
                self.end_headers()
                return
            body = {"parse": {"text": {"*": "<p>x</p>"}}}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *args):
        pass


def test_wiki(spark):
    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    api = f"http://127.0.0.1:{server.server_port}/api.php"
    try:
        o = {"delay": 0, "backoff": 0.01, "retries": 2}
        assert rows(W.read_wiki(spark, api, "categories", categories=["X", "Y"], **o), "pageid", "category", "seq") == [(1, "X", 0), (1, "Y", 0), (2, "X", 1), (2, "Y", 1)]
        assert rows(W.read_wiki(spark, api, "redirects", **o)) == [("Old", "New"), ("alias", None)]
        pages = {r.pageid: r for r in W.read_wiki(spark, api, "pages", pageids=[7, 404], **o).collect()}
        assert pages[7].raw_html == "<p>x</p>" and pages[404].raw_html is None and "404" in pages[404].error
    finally:
        server.shutdown()


def test_crawl(spark, tmp_path):
    from glossmill import crawl
    from glossmill.sources import files

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    api, folder = f"http://127.0.0.1:{server.server_port}/api.php", str(tmp_path / "store")
    o = {"delay": 0, "backoff": 0.01, "retries": 1}
    try:
        with pytest.raises(PermissionError):
            crawl.run(spark, folder, api, ("X",), "banned", **o)
        assert {k: v.count() for k, v in files.open_store(spark, folder).items()} == {"pages": 0, "redirects": 0, "crawl_meta": 0}
        counts = crawl.run(spark, folder, api, ("X", "Y"), "test", batch=1, **o)
        assert counts == {"n_fetched": 2, "n_empty": 0, "n_failed": 0, "n_skipped": 0, "redirects_complete": 1}
        pages = files.open_store(spark, folder)["pages"]
        assert rows(pages, "pageid", "title", "status", "first_paragraph", "in_scope", "source_category") == [(1, "A", "ok", "x", 1, "X, Y"), (2, "B", "ok", "x", 1, "X, Y")]
        assert rows(files.open_store(spark, folder)["redirects"], "source_title", "status") == [("Old", "ignored"), ("alias", "error")]
        files.snapshot(spark, folder, str(tmp_path / "kept"), 1)
        again = crawl.run(spark, folder, api, ("X",), "test", redirects=False, **o)
        assert again["n_fetched"] == 0 and again["n_skipped"] == 2
        assert rows(files.open_store(spark, folder)["pages"], "source_category") == [("X",), ("X",)]
        assert rows(spark.read.parquet(f"{tmp_path}/kept/v=1/pages.parquet"), "source_category") == [("X, Y",), ("X, Y",)]
    finally:
        server.shutdown()
        server.server_close()
    # after a failed listing the former redirects stay
    with pytest.raises(Exception, match="refused|urlopen|Connection"):
        crawl.run(spark, folder, api, ("X",), "test", **o)
    assert files.open_store(spark, folder)["redirects"].count() == 2


def test_store_tables(spark, tmp_path):
    from glossmill.sources import files

    place = str(tmp_path / "pages.parquet")
    spark.createDataFrame([(1, "A", "ok")], "pageid bigint, title string, status string").write.parquet(place)
    p = files.open_store(spark, str(tmp_path))["pages"]
    assert rows(p, "pageid", "title", "in_scope", "last_attempt_error") == [(1, "A", 1, None)]
    files.replace(p.unionByName(p.withColumn("pageid", F.lit(2).cast("bigint"))), place)
    assert files.open_store(spark, str(tmp_path))["pages"].count() == 2 and not (tmp_path / "pages.parquet.old").exists()
    (tmp_path / "pages.parquet").rename(tmp_path / "pages.parquet.old")  # as a run leaves it that is stopped in between
    assert files.open_store(spark, str(tmp_path))["pages"].count() == 2


def test_config():
    data = {"fandom": "f", "title": "My Dict!", "author": "a", "source_name": "s", "categories": ["C"], "database_path": "d", "build_dir": "b", "sidebar_fields": [{"source": "x", "label": "Aliases", "alias": True}], "title_aliases": {"suffixes": [" Box"], "component_ignore_words": ["Box"]}, "max_summary_length": 500}
    p = project_from(data)
    assert p.base_name == "My-Dict" and p.rules.suffixes == (" Box",) and p.rules.alias_labels == ("Aliases",)
    for bad in ({"title": ""}, {"categories": []}, {"max_summary_length": 0}, {"sidebar_fields": [{"source": "x", "label": "a"}] * 2}):
        with pytest.raises(ValueError):
            project_from(data | bad)


def test_shards_and_release(spark, words, tmp_path):
    from glossmill.operators import index
    from glossmill.sources import release

    path = tmp_path / "in" / "k.zip"
    path.parent.mkdir()
    D.write_kobo(path, *words)
    assert index.shard_violations(D.scan_kobo(spark, str(path))).isEmpty()
    bad = spark.createDataFrame([("zz", "Carl", ["x"], '<script>1</script><a href="http://x">y</a>'), ("do", "Donut", ["carl"], "")], "prefix string, headword string, variants array<string>, html string")
    assert {r.check for r in index.shard_violations(bad).collect()} == {"wrong shard", "word of two headwords", "tag not allowed", "link not allowed"}
    release.write_archive(path.parent / "a.zip", [path], {"README.txt": "x"})
    m = release.write_manifest(spark, path.parent, {"version": "v1.0.0"})
    assert [f["name"] for f in m["files"]] == ["a.zip", "k.zip"] and all(len(f["sha256"]) == 64 for f in m["files"])
    release.install(path.parent, tmp_path / "final")
    (tmp_path / "again").mkdir()
    release.install(tmp_path / "again", tmp_path / "final")
    assert list((tmp_path / "final").iterdir()) == [] and not (tmp_path / "final.old").exists()


def test_links(make):
    from glossmill.operators import links

    e = make("pos bigint, title string, definition string", [
        {"pos": 1, "title": "Moss", "definition": "Moss met <b>Tiller</b> &amp; Tiller, not Tillers."}, {"pos": 2, "title": "Tiller", "definition": None},
        {"pos": 3, "title": "Lamp of Moss", "definition": "Lamp of Moss <i>of</i> Moss &lt;Tiller&gt;"}, {"pos": 4, "title": "x", "definition": ""},
    ])
    assert rows(links.linked(e)) == [
        (1, 'Moss met <b><a href="bword://Tiller">Tiller</a></b> &amp; Tiller, not Tillers.'), (2, None),
        (3, 'Lamp of Moss <i>of</i> <a href="bword://Moss">Moss</a> &lt;<a href="bword://Tiller">Tiller</a>&gt;'), (4, ""),
    ]


def test_command(spark, make, tmp_path, monkeypatch):
    from glossmill import cli

    make("pages", [{"pageid": 1, "title": "Carl", "url": "https://h/wiki/Carl", "first_paragraph": "Carl is a delver & more.", "status": "ok", "in_scope": 1, "source_category": "Characters"}, {"pageid": 2, "title": "Fire Box", "url": "u", "first_paragraph": "A box of fire, closed.", "status": "ok", "in_scope": 1}]).write.parquet(str(tmp_path / "pages.parquet"))
    make("redirects", [{"source_title": "The Crawler", "target_title": "Carl", "status": "ok"}]).write.parquet(str(tmp_path / "redirects.parquet"))
    (tmp_path / "c.json").write_text(json.dumps({"fandom": "f", "title": "T", "author": "a", "source_name": "W", "categories": ["Characters"], "database_path": str(tmp_path), "build_dir": "b", "title_aliases": {"suffixes": [" Box"]}}))
    for command, name in (("stardict", "T.idx"), ("kobo", "dicthtml.zip"), ("kindle", "T.xhtml"), ("health", None)):
        assert cli.main([command, "-c", str(tmp_path / "c.json"), "-o", str(tmp_path / "out")]) == 0
        assert name is None or (tmp_path / "out" / name).stat().st_size > 0
    assert {r.word for r in D.scan_synonyms(spark, str(tmp_path / "out" / "T.syn")).collect()} == {"The Crawler", "Fire", "Carl's", "Carl’s"}
    assert cli.main(["audit", "-c", str(tmp_path / "missing.json")]) == 1
