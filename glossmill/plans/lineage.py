"""Cutting lineage, and joins on keys of which one may hold a large share of all rows."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARED = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's, or a new one where none is set and the driver works alone (tests)."""
    folder = spark.conf.get(SHARED, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"{SHARED} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="glossmill-")
        spark.conf.set(SHARED, folder)
    return folder.rstrip("/")


_written: dict[str, SparkSession] = {}


@atexit.register
def _clean() -> None:
    """Steps live as long as their session's program: results that nobody has read yet may need them."""
    for path, spark in _written.items():
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session has gone before
            return


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written to the shared folder and read again, so that no later loss of an executor repeats its work.

    A table keeps column pruning, predicate pushdown and true sizes for the joins that follow.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    _written[path] = spark
    return spark.read.schema(df.schema).parquet(path)


def hot_values(df: DataFrame, key: str, share: float = 1 / 64, least: int = 20_000) -> list:
    """Values of ``key`` with more than ``share`` of the rows and ``least`` of them: by their definition no more than 1/share."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count()
    total = df.count()
    return [r[0] for r in counts.where(F.col("count") > max(least, total * share)).select(key).collect()]


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", parts: int = 32) -> DataFrame:
    """Equi-join of a ``left`` with hot keys to a ``right`` that is unique by ``key``.

    Rows of a hot key are spread over ``parts`` salts and only the hot rows of ``right`` are repeated,
    so that no task gets a whole hot group. Without hot keys it is a plain join. ``left`` must be cheap
    to read twice (a table or a cut).
    """
    hot = hot_values(left, key)
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin(hot)
    salt: Column = F.when(is_hot, F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(parts)).cast("int")).otherwise(0)
    many = F.when(is_hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    return left.withColumn("_salt", salt).join(right.withColumn("_salt", F.explode(many)), [key, "_salt"], how).drop("_salt")
