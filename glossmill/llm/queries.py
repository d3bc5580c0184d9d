"""Queries of the training-data operators by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import groups, mainbody, packing, quality, residue, tokens, truncation

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "p1_found": lambda s, d: residue.residue_found(table(s, d, "pages"), table(s, d, "entries")),
        "p1_kinds": lambda s, d: residue.residue(table(s, d, "pages"), table(s, d, "entries")),
        "p1_clean": lambda s, d: residue.clean_records(table(s, d, "pages"), table(s, d, "entries")),
        "p3_found": lambda s, d: mainbody.main_body(table(s, d, "pages")),
        "p4_found": lambda s, d: groups.title_groups(table(s, d, "redirects"), table(s, d, "entries")),
        "p4_sizes": lambda s, d: groups.group_sizes(table(s, d, "redirects"), table(s, d, "entries")),
        "p5_found": lambda s, d: truncation.truncated_found(table(s, d, "pages"), table(s, d, "entries")),
        "p5_rates": lambda s, d: truncation.truncation_rates(table(s, d, "pages"), table(s, d, "entries")),
        "p6_ids": lambda s, d: tokens.token_ids(table(s, d, "documents")),
        "p6_spans": lambda s, d: tokens.token_spans(table(s, d, "documents")),
        "p6_round_trip": lambda s, d: tokens.round_trip(table(s, d, "documents")),
        "p7_packed": lambda s, d: packing.packed(table(s, d, "documents"), table(s, d, "capacities")),
        "p7_fill": lambda s, d: packing.fill_report(table(s, d, "documents"), table(s, d, "capacities")),
        "p8_found": lambda s, d: quality.not_prose(table(s, d, "documents"), table(s, d, "common_words")),
        "p8_stats": lambda s, d: quality.quality(table(s, d, "documents"), table(s, d, "common_words")),
        "p8_report": lambda s, d: quality.quality_report(table(s, d, "documents"), table(s, d, "common_words")),
    }


def oracle_sql() -> dict[str, str]:
    from ..oracles import key_sql

    groups_sql = f"""WITH RECURSIVE pairs AS (SELECT {key_sql("source_title")} AS a, {key_sql("target_title")} AS b FROM redirects WHERE source_title IS NOT NULL AND target_title IS NOT NULL
  UNION SELECT {key_sql("title")}, {key_sql("alias")} FROM (SELECT title, unnest(redirect_aliases) AS alias FROM entries) WHERE title IS NOT NULL AND alias IS NOT NULL),
 ends AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
 reach AS (SELECT DISTINCT a AS root, a AS v FROM ends UNION SELECT r.root, e.b FROM reach r JOIN ends e ON e.a = r.v WHERE e.b > r.root),
 found AS (SELECT v AS title_key, min(root) AS group_key FROM reach GROUP BY v)"""
    return {
        "p4_found": f"{groups_sql} SELECT group_key, title_key FROM found",
        "p4_sizes": f"{groups_sql} SELECT n_titles, count(*) AS n_groups FROM (SELECT group_key, count(*) AS n_titles FROM found GROUP BY 1) GROUP BY 1",
    }
