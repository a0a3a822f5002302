"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: settings that the library's plans count on at scale; Spark's own defaults agree on most
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}
#: settings for the session builder; recording the call site of every column
#: takes longer than planning where expressions are large
BUILDER_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}
CHECKPOINT_DIR = "spark.checkpoint.dir"


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables below the cluster's checkpoint folder.

    Only where the cluster names none, as in tests on one machine, a local
    temporary folder is used.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sparkseries-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
