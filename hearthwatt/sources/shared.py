"""The folder shared by all nodes."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; where it is unset, one beside the tables of the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared").rstrip("/")


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder; false if it was not there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files under a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return int(at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength())


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run."""
    return f"{shared_root(spark)}/hearthwatt/{name}-{uuid.uuid4().hex}"


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """Name of a running stream that its checkpoint keeps for good; a new checkpoint, whose batches start at 0 again, has another."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()))["id"]
    finally:
        stream.close()


def sweep(spark: SparkSession, min_age_seconds: float = 86400.0, now: float | None = None) -> int:
    """Remove the folders of runs that nothing has been added to for so long; returns how many.

    A frame that a run has returned reads its folder when it is evaluated, so nothing younger than the longest job may go.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/hearthwatt")
    files, limit, gone = top.getFileSystem(spark._jsc.hadoopConfiguration()), ((time.time() if now is None else now) - min_age_seconds) * 1000, 0
    for folder in files.listStatus(top) if files.exists(top) else []:
        inside = [status.getModificationTime() for status in files.listStatus(folder.getPath())] if folder.isDirectory() else []
        if max([folder.getModificationTime(), *inside]) <= limit:
            gone += bool(files.delete(folder.getPath(), True))
    return gone
