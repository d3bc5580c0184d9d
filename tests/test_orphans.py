from datetime import datetime as D

from conftest import rows
from glossmill.functions.keys import title_key_of
from glossmill.operators.orphans import judged_references, orphan_report, orphans, pointer_target
from pyspark.sql import functions as F

T = [D(2024, m, 1) for m in range(1, 13)]


def _tables(make, pages=(), lists=(), redirects=(), entries=(), deletions=()):
    return make("pages", pages), make("list_pages", lists), make("redirects", redirects), make("entries", entries), make("deletions", deletions)


def test_keys():
    assert title_key_of(" Straße_ of  X#y") == "strasse of x"
    assert title_key_of("Ｃaptain") == "captain"
    assert title_key_of(None) is None and title_key_of("#a") == ""


def test_causes(make):
    t = _tables(
        make,
        pages=[{"title": "Carl", "fetched_at": T[2]}, {"title": "Carl", "fetched_at": T[1]}, {"title": "Gone", "fetched_at": T[0]}, {"title": None, "fetched_at": T[0]}],
        lists=[{"title": "A List"}],
        redirects=[
            {"source_title": "a", "target_title": "CARL", "fetched_at": T[3]},
            {"source_title": "a", "target_title": "CARL", "fetched_at": T[3]},
            {"source_title": "b", "target_title": "Carl#Story", "fetched_at": T[0]},
            {"source_title": "c", "target_title": "Gone", "fetched_at": T[4]},
            {"source_title": "c2", "target_title": "Gone", "fetched_at": T[6]},
            {"source_title": "d", "target_title": "a_list", "fetched_at": T[0]},
            {"source_title": "e", "target_title": "e", "fetched_at": T[0]},
            {"source_title": "f", "target_title": "Never", "fetched_at": None},
            {"source_title": "g", "target_title": "a", "fetched_at": T[3]},
            {"source_title": "h", "target_title": None, "fetched_at": T[0]},
            {"source_title": "i", "target_title": "h", "fetched_at": T[1]},
            {"source_title": None, "target_title": "Never", "fetched_at": T[0]},
        ],
        entries=[{"pos": 1, "title": "X", "definition": "See: <b>Nothing</b>.", "built_at": T[0]}, {"pos": 2, "title": "Y", "definition": "See: Carl. He is a delver.", "built_at": T[0]}, {"pos": 3, "title": "Z", "built_at": T[0]}],
        deletions=[{"title": "gone", "deleted_at": T[3], "restored_at": T[5]}, {"title": "Gone", "deleted_at": T[4], "restored_at": T[5]}, {"title": "x", "deleted_at": None}],
    )
    found = {(r.from_key, r.to_key): r.cause for r in judged_references(*t).collect()}
    assert found == {
        ("a", "carl"): None, ("b", "carl"): "late", ("c", "gone"): "deleted", ("c2", "gone"): None, ("d", "a list"): None, ("e", "e"): "missing",
        ("f", "never"): "missing", ("g", "a"): None, ("i", "h"): None, (None, "never"): "missing", ("x", "nothing"): "missing",
    }
    assert ("entries", "x", "nothing", "2024-01") in rows(orphans(*t))
    report = {(r.rec_table, r.ref_month): r.n_orphans for r in orphan_report(*t).collect()}
    assert report["redirects", "2024-01"] == 3


def test_empty_and_extra(make):
    t = _tables(make)
    assert rows(orphans(*[x.withColumn("key", F.lit(1)).withColumn("cause", F.lit("x")) for x in t])) == []


def test_hot_key(make, spark):
    from glossmill.plans.lineage import salted_join

    left = spark.range(60_000).select(F.when(F.col("id") < 45_000, "hot").otherwise(F.col("id").cast("string")).alias("key"), "id")
    right = spark.createDataFrame([("hot", 1), ("50000", 2)], "key string, v int")
    assert salted_join(left, right, "key").agg(F.count("*"), F.count("v"), F.countDistinct("id")).first()[:] == (60_000, 45_001, 60_000)


def test_pointers(spark):
    cases = {
        "See: Novrom": "Novrom", "see: Thevarn Grivax Company.": "Thevarn Grivax Company", "duplicate page -  please see <b>X</b>.": "X", "System Message: For the older spelling, please see A (B)": "A (B)",
        "Moved to Sugrox's Veil.": "Sugrox's Veil", "This entry has been merged into <b>45 Rites</b>.": "45 Rites", "→ Vethex": "Vethex", "Carl is a delver.": None, "See: Carl. He walks.": None, "": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    assert {r.d: r.t for r in df.select("d", pointer_target(F.col("d")).alias("t")).collect()} == cases


def test_pointers_begin_in_squeezed_text(spark):
    cases = {"<b>For</b> the gate, see X": "X", "This\nentry has been moved to X": "X", "\u00a0See: X": "X", "This <i>page</i> was merged into X": "X", "Please\u2003see X": "X", "<b>S</b>ee: X": "X", "Foreign\nseas, see X": None}
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    assert {r.d: r.t for r in df.select("d", pointer_target(F.col("d")).alias("t")).collect()} == cases
