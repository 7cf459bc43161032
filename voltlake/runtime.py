"""The shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A local folder is made only where the setting is absent and the session is local.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="voltlake-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Removes a scratch table that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, by name alone; no file is opened."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return sorted(f.getPath().toString() for f in found or [])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/voltlake/{app}/{name}-{uuid.uuid4().hex[:12]}"
