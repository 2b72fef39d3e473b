"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Names the shared scratch folder where ``spark.checkpoint.dir`` is not set.
SCRATCH = "spark.greenwave.scratch"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "greenwave", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC event time; on a cluster ``spark-submit`` names the master."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options every operator assumes on an existing session.

    Event-time strings carry no zone and mean UTC, so the session zone must be UTC.
    Custom streaming state needs the RocksDB provider, which also keeps large
    keyed state off the JVM heap.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path for ``purpose`` under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage all executors see; where it is unset, the
    caller names such a folder in ``spark.greenwave.scratch``. There is no local default.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    if not root:
        raise ValueError(f"set spark.checkpoint.dir or {SCRATCH} to storage all executors share")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that later steps start from there."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
