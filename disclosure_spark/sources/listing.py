"""Readers of the remote blob listing and of what has already landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LISTING_SCHEMA


def read_listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Blobs of a saved listing, numbered by ``page`` and ``pos`` in listing order.

    A listing without a ``blobs`` array has no rows. Several pages may be read
    at once; they are ordered by file path.
    """
    pages = spark.read.schema(LISTING_SCHEMA).option("multiLine", True).json(path)
    blobs = pages.select(
        F.col("_metadata.file_path").alias("page"),
        F.posexplode("blobs").alias("pos", "blob"),
    )
    return blobs.select("page", F.col("pos").cast("bigint"), "blob.*")


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """Files in the landing zone: ``path`` relative to ``root``, and ``size``.

    Only file status is read; the content column is pruned from the scan.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # The landing layout is <source>/<file type>/<date>/<name>.
    return files.select(F.substring_index("path", "/", -4).alias("path"), F.col("length").alias("size"))
