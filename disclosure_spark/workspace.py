"""The shared folder in which intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def workspace(spark: SparkSession, *parts: str) -> str:
    """A path below ``spark.checkpoint.dir``, the folder all executors share.

    The setting is read from the session. Only a ``local[...]`` session without
    it gets a temporary folder; on a cluster a machine-local folder would be
    invisible to the executors, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if context.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app = context.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="disclosure-")
        root = _local_roots[app]
    return "/".join([root.rstrip("/"), "disclosure_spark", spark.sparkContext.applicationId, *parts])


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run of the job ``name``."""
    return workspace(spark, name, uuid.uuid4().hex)


def _place(spark: SparkSession, path: str):
    """Hadoop's path and the file system that Spark reads and writes it with."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly in a folder."""
    place, system = _place(spark, path)
    return [status.getPath().getName() for status in system.listStatus(place)]


def folder_bytes(spark: SparkSession, path: str) -> int:
    place, system = _place(spark, path)
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def hidden_files(spark: SparkSession, path: str, depth: int = 4) -> list[str]:
    """Files below ``path`` that Spark's readers pass over, as a part of their path within ``depth`` levels starts with ``_`` or ``.``.

    Only such names are listed, level by level, whatever else is there.
    """
    place, system = _place(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    found = []
    for level in range(depth + 1):
        for status in system.globStatus(hadoop.Path(place, "*/" * level + "{_,.}*")) or []:
            if status.isFile():
                found.append(status.getPath().toString())
                continue
            files = system.listFiles(status.getPath(), True)
            while files.hasNext():
                found.append(files.next().getPath().toString())
    return sorted(set(found))


# Schemes of one store that Hadoop and Arrow call differently.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def arrow_uri(spark: SparkSession, path: str) -> str:
    """The place that Spark means by ``path``, as a URI for Arrow's file systems.

    A path without a scheme is on Spark's default file system, not on the disk of whoever opens it.
    """
    place, system = _place(spark, path)
    scheme, _, rest = system.makeQualified(place).toString().partition(":")
    return f"{ARROW_SCHEMES.get(scheme, scheme)}://{'/' + rest.lstrip('/') if scheme == 'file' else rest.removeprefix('//')}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    place, system = _place(spark, path)
    system.delete(place, True)
