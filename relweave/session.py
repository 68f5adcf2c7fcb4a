"""Session defaults and table access."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "relweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; what a cluster sets already wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir (a temporary one where that is unset and the master is local); it goes when the driver's JVM ends."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="relweave-")
    path = f"{at.rstrip('/')}/{what}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system that path is in, and the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def stored(df: DataFrame, what: str) -> DataFrame:
    """df, written to a folder that driver and executors share and read again: its lineage ends there, so a lost executor costs nothing."""
    path = scratch(df.sparkSession, what) + "/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file through Spark's own file systems."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
