from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


PAGES = "pageid bigint, title string, ns int, url string, source_category string, raw_json string, raw_html string, first_paragraph string, status string, error string, in_scope int, last_attempt_error string, fetched_at timestamp_ntz"
REDIRECTS = "source_title string, target_title string, source_url string, status string, fetched_at timestamp_ntz"
ENTRIES = "pos bigint, title string, url string, definition string, spoiler_notice string, details array<struct<label:string,value:string>>, source_categories array<string>, redirect_aliases array<string>, built_at timestamp_ntz"
DELETIONS = "pageid bigint, title string, deleted_at timestamp_ntz, restored_at timestamp_ntz"
LISTS = "list_id bigint, title string, url string"


@pytest.fixture(scope="session")
def make(spark):
    """Tables from dicts; missing columns are null."""
    from pyspark.sql.types import StructType

    kinds = {"pages": PAGES, "redirects": REDIRECTS, "entries": ENTRIES, "deletions": DELETIONS, "list_pages": LISTS}

    def run(name, rows):
        schema = StructType.fromDDL(kinds.get(name, name))
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)

    return run


def rows(df, *columns):
    return sorted((tuple(r[c] for c in (columns or df.columns)) for r in df.collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))
