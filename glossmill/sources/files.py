"""A page store as Parquet tables: made, brought up to date, replaced in one step, and kept as snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {
    "pages": "pageid bigint, title string, ns int, url string, source_category string, raw_json string, raw_html string, first_paragraph string, status string, error string, in_scope int, last_attempt_error string, fetched_at timestamp_ntz",
    "redirects": "source_title string, target_title string, source_url string, status string, fetched_at timestamp_ntz",
    "crawl_meta": "meta_key string, meta_value string",
}
LATE = {"in_scope": 1}  # columns that older stores lack, with what they mean there


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def replace(df: DataFrame, place: str) -> None:
    """Writes ``df`` beside ``place`` and then puts it there; a failed write leaves what was there, also if ``df`` reads it."""
    spark = df.sparkSession
    (new, fs), (old, _), (now, _) = (_path(spark, place + end) for end in (".new", ".old", ""))
    df.write.mode("overwrite").parquet(place + ".new")
    fs.delete(old, True)
    if fs.exists(now):
        fs.rename(now, old)
    fs.rename(new, now)
    fs.delete(old, True)


def restore(spark: SparkSession, place: str) -> None:
    """After a run that was stopped between the two renamings of ``replace``: the former table is put back."""
    (old, fs), (now, _) = _path(spark, place + ".old"), _path(spark, place)
    if fs.exists(old) and not fs.exists(now):
        fs.rename(old, now)


def open_store(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The store's tables by name: missing ones are made empty, and late columns are added with their defaults."""
    out = {}
    for name, ddl in TABLES.items():
        place = f"{folder}/{name}.parquet"
        restore(spark, place)
        now, fs = _path(spark, place)
        if not fs.exists(now):
            spark.createDataFrame([], ddl).write.parquet(place)
        df = spark.read.parquet(place)
        for column in ddl.split(", "):
            field, kind = column.split()
            if field not in df.columns:
                df = df.withColumn(field, F.lit(LATE.get(field)).cast(kind))
        out[name] = df.select(*[c.split()[0] for c in ddl.split(", ")])
    return out


def snapshot(spark: SparkSession, folder: str, target: str, version: int) -> None:
    """A copy of a store's tables that later runs don't touch."""
    for name, df in open_store(spark, folder).items():
        df.write.mode("overwrite").parquet(f"{target}/v={version}/{name}.parquet")
