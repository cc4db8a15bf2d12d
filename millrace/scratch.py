"""Folders for tables between two steps of a job, below the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[tuple[str, str], str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Where neither is set, a run inside one machine (a master local or local[n]) takes a temporary folder; on a cluster
    tables between two steps cannot be written then, and that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and (context.master == "local" or context.master.startswith("local[")):
        folder = tempfile.mkdtemp(prefix="millrace-")
    if not folder:
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that the driver and all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A path of its own in the shared folder; what is written there is deleted when the application ends."""
    context = spark.sparkContext
    key = (context.applicationId, spark.conf.get("spark.checkpoint.dir", None) or "")
    if key not in _OWN:
        path = f"{shared_dir(spark)}/millrace-{uuid.uuid4().hex}"
        hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
        store = hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())
        store.mkdirs(hadoop_path)
        store.deleteOnExit(hadoop_path)
        _OWN[key] = path
    return f"{_OWN[key]}/{tag}-{uuid.uuid4().hex}"
