"""Session settings for jobs started by this package, and the shared folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(name: str = "weftwork", master: str | None = None, **settings) -> SparkSession:
    """A session whose adaptive settings split skewed joins; a cluster sets its own sizes."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # the JVM never compiles methods beyond this size; without generated stages they are cut into smaller ones
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for tables written between steps.

    It lies under ``spark.checkpoint.dir``, which every executor can reach.
    Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="weftwork-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
