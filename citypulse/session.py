"""Where jobs keep intermediate tables and stream checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="citypulse-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/citypulse-{label}-{uuid.uuid4().hex}"


def folder_of(spark: SparkSession, path: str):
    """A path and the store it is in."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, store = folder_of(spark, path)
    return store.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job has made for itself."""
    folder, store = folder_of(spark, path)
    store.delete(folder, True)
