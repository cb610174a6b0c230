"""Session defaults: UTC, ANSI errors, adaptive plans with skew joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def session(name: str = "signalweave", **conf: str) -> SparkSession:
    """A session with the defaults, overridden by ``conf`` (dots written as double underscores)."""
    b = SparkSession.builder.appName(name)
    for k, v in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df``, computed once, written as a table in the folder of ``spark.checkpoint.dir`` and read back: lineage ends there, and lost executors cost nothing before it.

    Where that is unset, a local master (one machine, as in tests) gets a temporary folder; anywhere else it is an error. Tables are deleted when the driver ends.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.signalweave.tables", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="signalweave-")
        spark.conf.set("spark.signalweave.tables", root)
    path = f"{root.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
