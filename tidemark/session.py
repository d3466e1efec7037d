"""The Spark session that the command line tools and jobs use."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER_SET"):
        builder = builder.master(master or "local[*]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a temporary folder is made and set if all runs on this machine (tests); on a
    cluster that would part the executors, so it is an error there.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found and sc._jsc.sc().getCheckpointDir().isDefined():
        found = sc._jsc.sc().getCheckpointDir().get()
    if not found and sc.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir is unset: there is no folder that the executors share")
    found = found or f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(found)
    return found


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
