from datetime import datetime as D

from conftest import rows
from glossmill.streaming import crawl

NAMES = [c.split()[0] for c in crawl.ATTEMPT.split(", ")]


def _row(pageid, status, day, **more):
    return tuple({"pageid": pageid, "title": f"T{pageid}", "url": "u", "status": status, "fetched_at": D(2024, 1, day), **more}.get(n) for n in NAMES)


def _put(spark, folder, rows_):
    spark.createDataFrame(rows_, crawl.ATTEMPT).coalesce(1).write.mode("append").parquet(folder)


def test_follow_and_states(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "store")
    _put(spark, src, [_row(1, "ok", 1, first_paragraph="text", raw_html="<p>text</p>", raw_json="{}"), _row(2, "error", 1, error="x")])
    crawl.follow(crawl.read_attempts(spark, src), out, str(tmp_path / "c")).awaitTermination(60)
    _put(spark, src, [_row(1, "error", 2, error="boom"), _row(2, "ok", 2, first_paragraph="now")])
    crawl.follow(crawl.read_attempts(spark, src), out, str(tmp_path / "c")).awaitTermination(60)
    assert rows(crawl.latest(spark, out), "pageid", "status", "first_paragraph", "raw_html", "raw_json", "error") == [(1, "ok", "text", "<p>text</p>", "{}", "boom"), (2, "ok", "now", None, None, None)]
    q = crawl.good_states(crawl.read_attempts(spark, src)).writeStream.outputMode("update").format("memory").queryName("states").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {r.pageid: r for r in spark.table("states").collect()}
    assert (got[1].first_paragraph, got[1].error, got[1].n_attempts) == ("text", "boom", 2) and got[2].status == "ok"
    w = crawl.attempt_windows(crawl.read_attempts(spark, src)).writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    w.awaitTermination(60)
    assert {(r.status, r.n) for r in spark.table("windows").collect()} == {("ok", 1), ("error", 1)}


def test_replayed_batches_and_untouched_parts(spark, tmp_path):
    out = str(tmp_path / "store")
    merge = crawl._merge(out)
    batch = lambda *r: spark.createDataFrame(list(r), crawl.ATTEMPT)
    assert crawl.latest(spark, out) is None
    merge(batch(*[_row(i, "ok", 1, first_paragraph="old") for i in range(200)]), 0)
    first = len(crawl._listed(spark, out))
    assert crawl.BUCKETS / 2 < first <= crawl.BUCKETS
    for _ in range(2):  # the second time as after a failure before the batch was noted
        merge(batch(_row(7, "ok", 3, first_paragraph="new"), _row(None, "ok", 3)), 1)
    parts = crawl._listed(spark, out)
    assert len([p for p in parts if p[0] == 1]) == 1 and len([p for p in parts if p[0] == 0]) == first
    merge(batch(_row(7, "ok", 2, first_paragraph="late")), 2)  # comes after a later attempt
    got = {r.pageid: r.first_paragraph for r in crawl.latest(spark, out).collect()}
    assert len(got) == 200 and got[7] == "new" and set(got.values()) == {"old", "new"}
    assert len([p for p in crawl._listed(spark, out) if p[0] == 0]) == first - 1  # no replay needs the touched part's first version


def test_state_compares_times():
    import pandas as pd

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    def put(state, *attempts):
        pdf = pd.DataFrame([{"status": s, "first_paragraph": p, "error": e, "fetched_at": pd.Timestamp(2024, 1, d)} for s, p, e, d in attempts])
        return next(iter(crawl._state((1,), iter([pdf]), state))).iloc[0]

    state = State()
    assert put(state, ("ok", "second", None, 2)).first_paragraph == "second"
    late = put(state, ("ok", "first", None, 1), ("error", None, "old failure", 1))
    assert late.first_paragraph == "second" and late.error is None and late.n_attempts == 3
    assert put(state, ("error", None, "boom", 3)).error == "boom" and put(state, ("empty", "", None, 4)).status == "empty"
