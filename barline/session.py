"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "barline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Shuffle partitions start high and AQE coalesces them; on a cluster
    leave ``master`` unset so spark-submit decides.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the folder in ``spark.checkpoint.dir``.

    Where that is unset, as in tests, the warehouse folder takes its place: it
    is the other folder that every executor sees. What is written there goes
    when the session's JVM ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)  # only a path that exists can be marked
    fs.deleteOnExit(path)
    return path.toString()
