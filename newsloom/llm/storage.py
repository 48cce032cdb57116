"""Shared scratch space: tables written between steps, so that lost executors cost a re-read and no recomputation.

The folder is the one that the cluster names in ``spark.checkpoint.dir``. Only where that is unset and Spark runs in
this one process (tests, a single machine) a temporary folder takes its place; on a cluster it has to be set.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that driver and executors share."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is unset: steps need a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="newsloom-")
    return _own[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it is removed when the driver ends, if not before."""
    path = f"{shared_dir(spark)}/newsloom/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch path, if the session still lives."""
    if spark.sparkContext._jsc is None:  # the session has ended
        return
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except (Py4JError, OSError):  # the gateway has ended: nothing is left to delete with
        return


def written(df: DataFrame, name: str, *, codec: str = "zstd") -> DataFrame:
    """Writes a table to the shared folder and reads it back: its lineage starts at the files."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*frames: DataFrame) -> None:
    """Deletes tables that ``written`` has returned, once everything that is made of them is written itself."""
    for df in frames:
        remove(df.sparkSession, df._scratch)
