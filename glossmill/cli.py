"""``python -m glossmill.cli COMMAND``: builds, audits and reports over a folder of Parquet tables or a SQLite store."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crawl
from .operators import checks, entries, index, lookup
from .plans.config import Project, load_project
from .plans.ship import ship
from .sources import dictionaries
from .sources.sqlite import read_sqlite
from .sources.tables import table


def _store(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    if path.endswith((".sqlite", ".db")):
        pages = ["pageid", "title", "url", "source_category", "raw_html", "first_paragraph", "status", "in_scope", "fetched_at"]
        return read_sqlite(spark, path, "pages", columns=pages).where("status = 'ok'"), read_sqlite(spark, path, "redirects").where("status = 'ok'")
    return table(spark, path, "pages"), table(spark, path, "redirects")


def _parts(spark: SparkSession, project: Project, path: str, least: int) -> tuple[DataFrame, lookup.Lookups]:
    e = entries.ordered(entries.assembled(*_store(spark, path), least, project.rules.strip_parenthetical, project.max_summary_length))
    e = e.drop("pos").withColumnRenamed("rank", "pos")
    return e, lookup.lookups(e, project.rules)


def _words(e: DataFrame, found: lookup.Lookups, source: str) -> DataFrame:
    """(word, definition): each title and each shared word with its page or pages."""
    html = e.select("title", index.rendered(source).alias("html"))
    both = index.combined(found.shared, html)
    return both.unionByName(html.select(F.col("title").alias("word"), F.col("html").alias("definition")).join(both.select("word"), "word", "left_anti"))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="glossmill", description=__doc__)
    p.add_argument("command", choices=("crawl", "stardict", "kobo", "kindle", "audit", "health"))
    p.add_argument("-c", "--config", required=True)
    p.add_argument("-i", "--input")
    p.add_argument("-o", "--output", default="build")
    p.add_argument("--min-definition-length", type=int, default=8)
    p.add_argument("--max-findings", type=int, default=25)
    p.add_argument("--user-agent", default="glossmill")
    p.add_argument("--delay", type=float, default=1.5)
    p.add_argument("--api", help="address of the wiki's API, for crawl")
    a = p.parse_args(argv)
    try:
        project = load_project(a.config)
    except (OSError, ValueError) as e:
        print(f"bad config: {e}", file=sys.stderr)
        return 1
    spark = SparkSession.builder.appName("glossmill").getOrCreate()
    ship(spark)
    if a.command == "crawl":
        if not a.api:
            p.error("crawl needs --api")
        try:
            for name, n in crawl.run(spark, a.input or project.database_path, a.api, project.categories, a.user_agent, project.max_summary_length, delay=a.delay).items():
                print(f"{name}: {n}")
        except PermissionError as error:
            print(error, file=sys.stderr)
            return 1
        return 0
    e, found = _parts(spark, project, a.input or project.database_path, a.min_definition_length)
    forms = lookup.alias_forms(e, found)
    out = Path(a.output)
    if a.command == "audit":
        for r in checks.audit(e).orderBy("kind", "title").toLocalIterator():
            print(f"{r.kind}: {r.title}: {r.detail}")
    elif a.command == "health":
        for r in lookup.health_lines(e, found, a.max_findings).orderBy("level", "kind", "ord").toLocalIterator():
            print(f"{r.level}: {r.kind}: {r.line}")
        outside = entries.out_of_scope(e, project.categories).select(F.concat_ws(": ", "title", F.array_join("source_categories", ", ")).alias("line"))
        for r in lookup.first_lines(outside, [F.col("line")], "out of scope", a.max_findings, "warning").orderBy("ord").toLocalIterator():
            print(f"{r.level}: {r.kind}: {r.line}")
    else:
        out.mkdir(parents=True, exist_ok=True)
        if a.command == "stardict":
            print(dictionaries.write_stardict(out, project.base_name, project.title, project.author, _words(e, found, project.source_name), forms))
        elif a.command == "kobo":
            print(dictionaries.write_kobo(out / project.kobo_output_name, _words(e, found, project.source_name), forms))
        else:
            ranked = e.withColumnRenamed("pos", "rank")
            print(dictionaries.write_kindle(out / f"{project.base_name}.xhtml", project.title, dictionaries.kindle_blocks(ranked, forms, project.source_name), index.sections(ranked), dictionaries.kindle_duplicates(ranked, found.shared, project.source_name)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
