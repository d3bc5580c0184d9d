"""MediaWiki listings and pages as a Spark data source (``glossmill_mediawiki``).

``kind`` is categories (one partition per category), redirects, or pages (by pageid, in a few partitions, so that a
wiki isn't flooded). Requests are retried with bounded exponential backoff; ``Retry-After`` is honoured.
"""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
import urllib.robotparser
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# HTTP codes that are tried again, and how many titles one request resolves.
RETRIED = (403, 408, 429, 500, 502, 503, 504)
BATCH = 50
DEFAULTS = {"delay": 1.5, "timeout": 30.0, "retries": 5, "backoff": 2.0, "most_backoff": 120.0, "batch": 200, "agent": "glossmill"}


def page_url(base: str, title: str) -> str:
    return f"{base.rstrip('/')}/wiki/{urllib.parse.quote(title.replace(' ', '_'), safe='/:()')}"


def category_title(name: str) -> str:
    return name if name.startswith("Category:") else f"Category:{name}"


def jitter(delay: float) -> float:
    return max(0.0, delay * random.uniform(0.75, 1.25))


def retry_after(value: str | None) -> float | None:
    try:
        return float(value) if value else None
    except ValueError:
        return None


def assert_allowed(api: str, agent: str, timeout: float = 30.0) -> None:
    """Raises PermissionError if the site's robots.txt keeps ``agent`` from the API; without such a file all is allowed."""
    parts = urllib.parse.urlsplit(api)
    robots = urllib.robotparser.RobotFileParser()
    try:
        with urllib.request.urlopen(f"{parts.scheme}://{parts.netloc}/robots.txt", timeout=timeout) as answer:
            robots.parse(answer.read().decode("utf-8", "replace").splitlines())
    except urllib.error.HTTPError as e:
        if e.code in (401, 403):
            robots.disallow_all = True
        elif e.code >= 500:
            raise
        else:
            robots.allow_all = True
    if not robots.can_fetch(agent, api):
        raise PermissionError(f"robots.txt disallows {api} for {agent}")


def request(api: str, params: dict, settings: dict) -> dict:
    url = f"{api}?{urllib.parse.urlencode({'format': 'json', **params})}"
    wait = float(settings["backoff"])
    for attempt in range(int(settings["retries"]) + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": str(settings["agent"])}), timeout=float(settings["timeout"])) as answer:
                return json.loads(answer.read().decode("utf-8"))
        except urllib.error.HTTPError as e:
            if e.code not in RETRIED or attempt == int(settings["retries"]):
                raise
            pause = retry_after(e.headers.get("Retry-After")) or jitter(wait)
        except (urllib.error.URLError, TimeoutError, json.JSONDecodeError):
            if attempt == int(settings["retries"]):
                raise
            pause = jitter(wait)
        time.sleep(min(pause, float(settings["most_backoff"])))
        wait = min(wait * 2, float(settings["most_backoff"]))
    raise RuntimeError("unreachable")


def paged(api: str, params: dict, settings: dict) -> Iterator[dict]:
    """Answers of a query and of its continuations."""
    more: dict = {}
    while True:
        answer = request(api, {**params, **more}, settings)
        yield answer
        more = answer.get("continue") or {}
        if not more:
            return
        time.sleep(jitter(float(settings["delay"])))


class Work(InputPartition):
    def __init__(self, items: list):
        self.items = items


class WikiReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.settings = {k: options.get(k, v) for k, v in DEFAULTS.items()}
        self.api = options["api"]

    def partitions(self) -> list[Work]:
        kind = self.options["kind"]
        if kind == "categories":
            return [Work([c]) for c in json.loads(self.options["categories"])]
        if kind == "redirects":
            return [Work([])]
        ids = json.loads(self.options["pageids"])
        n = max(1, int(self.options.get("partitions", "2")))
        return [Work(ids[i::n]) for i in range(n) if ids[i::n]]

    def read(self, partition: Work) -> Iterator[tuple]:
        yield from getattr(self, f"_{self.options['kind']}")(partition.items)

    def _categories(self, items: list) -> Iterator[tuple]:
        most = int(self.options.get("max_pages", "0"))
        for category in items:
            n = 0
            for answer in paged(self.api, {"action": "query", "list": "categorymembers", "cmtitle": category_title(category), "cmnamespace": 0, "cmtype": "page", "cmlimit": self.settings["batch"]}, self.settings):
                for m in answer.get("query", {}).get("categorymembers", []):
                    yield int(m["pageid"]), str(m["title"]), int(m.get("ns", 0)), str(category), n
                    n += 1
                    if most and n >= most:
                        break
                if most and n >= most:
                    break

    def _redirects(self, items: list) -> Iterator[tuple]:
        most, n = int(self.options.get("max_redirects", "0")), 0
        for answer in paged(self.api, {"action": "query", "generator": "allpages", "gapfilterredir": "redirects", "gaplimit": self.settings["batch"]}, self.settings):
            titles = sorted((str(p["title"]) for p in answer.get("query", {}).get("pages", {}).values()), key=str.casefold)
            for i in range(0, len(titles), BATCH):
                part = titles[i : i + BATCH]
                try:
                    got = request(self.api, {"action": "query", "titles": "|".join(part), "redirects": 1}, self.settings)
                    to = {r["from"]: r["to"] for r in got.get("query", {}).get("redirects", [])}
                except Exception:  # best effort: unresolved ones are errors
                    to = {}
                for title in part:
                    if most and n >= most:
                        return
                    n += 1
                    yield title, to.get(title)

    def _pages(self, items: list) -> Iterator[tuple]:
        for pageid in items:
            try:
                body = request(self.api, {"action": "parse", "pageid": pageid, "prop": "text|revid|displaytitle|categories", "redirects": 1}, self.settings)
                yield int(pageid), json.dumps(body, ensure_ascii=False, sort_keys=True), (body.get("parse") or {}).get("text", {}).get("*"), None
            except Exception as e:
                yield int(pageid), None, None, str(e)
            time.sleep(jitter(float(self.settings["delay"])))


class WikiSource(DataSource):
    SCHEMAS = {
        "categories": "pageid bigint, title string, ns int, category string, seq int",
        "redirects": "source_title string, target_title string",
        "pages": "pageid bigint, raw_json string, raw_html string, error string",
    }

    @classmethod
    def name(cls) -> str:
        return "glossmill_mediawiki"

    def schema(self) -> str:
        return self.SCHEMAS[self.options["kind"]]

    def reader(self, schema) -> WikiReader:
        return WikiReader(dict(self.options))


def read_wiki(spark: SparkSession, api: str, kind: str, **options) -> DataFrame:
    """A listing or pages of a wiki; lists are given as lists."""
    spark.dataSource.register(WikiSource)
    reader = spark.read.format("glossmill_mediawiki").option("api", api).option("kind", kind)
    for k, v in options.items():
        reader = reader.option(k, json.dumps(v) if isinstance(v, list) else str(v))
    return reader.load()
