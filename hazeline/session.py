"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "hazeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. Leave ``master`` unset on a cluster."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    # adaptive execution only merges partitions, so a cluster starts from many
    wide = {} if master else {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000"}
    settings = {
        **wide,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # building large plans is faster without the call site of every expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there, and must: executors can't read what
    others wrote to their own disks. Only a local master gets a fresh local
    folder where the setting is absent, remembered for the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, kind: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, kind: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
