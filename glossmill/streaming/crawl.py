"""A crawl as a stream: attempts arrive as files, the page store follows.

``follow`` upserts each micro-batch into a store of BUCKETS parts by page. A batch writes only the parts that its pages
are in, as a version of its own number, and reads only earlier versions: a batch that fails leaves the last versions,
and one that is replayed writes the same again. Parts that no replay can need are removed. ``good_states`` keeps each
page's last known good content in a state store; an attempt that comes late changes nothing that a later one said.
``attempt_windows`` counts attempts in event-time windows with a watermark for late ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import store

ATTEMPT = "pageid bigint, title string, url string, status string, raw_json string, raw_html string, first_paragraph string, error string, fetched_at timestamp"
BUCKETS = 64  # parts of a store; as many paths are read


def read_attempts(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(ATTEMPT).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _listed(spark: SparkSession, target: str) -> list[tuple[int, int, str]]:
    """(version, bucket, path) of all parts of complete versions."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(target)):
        return []
    out = []
    for v in fs.listStatus(path(target)):
        name = v.getPath().getName()
        if name.startswith("v=") and fs.exists(path(f"{target}/{name}/_SUCCESS")):
            parts = [s.getPath().getName() for s in fs.listStatus(v.getPath())]
            out += [(int(name[2:]), int(p[7:]), f"{target}/{name}/{p}") for p in parts if p.startswith("bucket=")]
    return sorted(out)


def _newest(listed: list[tuple[int, int, str]], below: int | None = None) -> dict[int, str]:
    return {bucket: path for version, bucket, path in listed if below is None or version < below}


def latest(spark: SparkSession, target: str) -> DataFrame | None:
    """The store as its newest complete parts have it, or None."""
    parts = _newest(_listed(spark, target))
    return spark.read.schema(ATTEMPT).parquet(*parts.values()) if parts else None


def _merge(target: str):
    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.where("pageid IS NOT NULL").withColumn("bucket", F.pmod(F.xxhash64("pageid"), F.lit(BUCKETS)))
        touched = {r[0] for r in rows.select("bucket").distinct().collect()}  # no more than there are buckets
        listed = _listed(spark, target)
        before = _newest(listed, number)
        old = [path for bucket, path in before.items() if bucket in touched]
        both = rows.drop("bucket") if not old else spark.read.schema(ATTEMPT).parquet(*old).unionByName(rows.drop("bucket"))
        kept = store.last_known_good(both)
        kept = kept.select("pageid", "title", "url", "status", "raw_json", "raw_html", "first_paragraph", F.coalesce("last_attempt_error", "error").alias("error"), "fetched_at")
        kept = kept.withColumn("bucket", F.pmod(F.xxhash64("pageid"), F.lit(BUCKETS)))
        kept.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/v={number}")
        path = spark._jvm.org.apache.hadoop.fs.Path
        for version, bucket, place in listed:
            if version < number and before[bucket] != place:
                path(place).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(place), True)

    return run


def follow(attempts: DataFrame, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Upserts attempts into the store at ``target``; each batch writes a version of the parts that it touches."""
    writer = attempts.writeStream.foreachBatch(_merge(target)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _state(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The latest attempt that was kept gives the content, and the latest of all whether an error came after it."""
    status, paragraph, error, n, good_at, tried_at = state.get if state.exists else (None, None, None, 0, None, None)
    for pdf in batches:
        for row in pdf.sort_values("fetched_at").itertuples():
            n += 1
            at = -1 if pd.isna(row.fetched_at) else row.fetched_at.value // 1000
            if row.status in store.KEPT and (good_at is None or at >= good_at):
                status, paragraph, good_at = row.status, row.first_paragraph, at
            if tried_at is None or at >= tried_at:
                tried_at, error = at, None if row.status in store.KEPT else row.error
    status = status or "error"
    state.update((status, paragraph, error, n, good_at, tried_at))
    yield pd.DataFrame({"pageid": [key[0]], "status": [status], "first_paragraph": [paragraph], "error": [error], "n_attempts": [n]})


def good_states(attempts: DataFrame) -> DataFrame:
    """(pageid, status, first_paragraph, error, n_attempts) after each batch, of the pages that it touched."""
    schema = "pageid bigint, status string, first_paragraph string, error string, n_attempts bigint"
    kept = "status string, first_paragraph string, error string, n_attempts bigint, good_at bigint, tried_at bigint"
    some = attempts.select("pageid", "status", "first_paragraph", "error", "fetched_at")
    return some.groupBy("pageid").applyInPandasWithState(_state, schema, kept, "update", GroupStateTimeout.NoTimeout)


def attempt_windows(attempts: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(begin, status, n): attempts by window and outcome."""
    w = attempts.withWatermark("fetched_at", late).groupBy(F.window("fetched_at", width).alias("w"), "status").agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("begin"), "status", "n")
