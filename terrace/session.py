"""Session helpers: a local session for tests/bench and a checkpoint folder
taken from the cluster's own ``spark.checkpoint.dir`` setting."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("terrace")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.extraJavaOptions", "-XX:ReservedCodeCacheSize=512m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compiled_projections(spark: SparkSession) -> None:
    """Lets Spark fuse only stages that the JVM also compiles.  HotSpot interprets
    methods over 8,000 bytes of code, and a fused projection of ~50 columns is
    longer; unfused, Spark splits it into short methods.  A limit that the
    session's owner has set stays."""
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", None) in (None, "65535"):
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the session's ``spark.checkpoint.dir``.  Only a
    session whose executors run inside the driver (``local[...]``) may do
    without: it gets a scratch folder, which goes when the process ends.  On a
    cluster a machine-local folder would lose data, so it is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="terrace-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"terrace-{name}-{uuid.uuid4().hex[:12]}")
