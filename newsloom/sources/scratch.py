"""Where queries keep tables of their own: the folder that the cluster names, or a temporary one on a local master."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local: dict[str, str] = {}


def fresh(spark: SparkSession, name: str) -> str:
    """A new path below the folder of ``spark.checkpoint.dir``, which a cluster has to name."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: stored tables need a folder that driver and executors share")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is unset: the executors of a local cluster share no folder")
        root = _local.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="newsloom-"))
    return f"{root.rstrip('/')}/newsloom/{name}-{uuid.uuid4().hex}"
