"""Session settings the library is tuned for."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "storespark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew splitting and the UTC calendar.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from
    spark-submit; only what is passed here is set.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session, as in tests, may do without that setting; executors
    of a cluster would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "storespark")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
