"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenwave.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Java and DuckDB pattern of one word between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Spark's setting: the shuffle files of a query are removed at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: str | Column) -> Column:
    """A-Z in lower case; all other characters stay."""
    return F.translate(text, UPPER, UPPER.lower())


def stored(df: DataFrame, purpose: str, **options) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage.

    Any executor can be lost afterwards: the rows lie in the folder that
    ``spark.checkpoint.dir`` names, not on the executors. Spark removes the shuffle files of the
    write as it ends, not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, **options)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Empty the table behind ``df``, which ``stored`` returned and nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(folder)


def broadcast_below(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is.

    The rows are counted first, so pass a stored or cheap frame of fixed-width columns.
    Beyond the bound Spark joins by shuffle.
    """
    return F.broadcast(df) if df.count() <= rows else df


def worker_memo(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process.

    Functions are shipped by value, so their module's globals are new for each task.
    """
    home = sys.modules.setdefault("_greenwave_worker", types.ModuleType("_greenwave_worker"))
    return home.__dict__.setdefault(name, {})
