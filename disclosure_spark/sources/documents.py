"""Reader of nested index documents."""

from __future__ import annotations

from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CORRUPT_COLUMN, INDEX_SCHEMA
from ..workspace import hidden_files


def read_index_documents(spark: SparkSession, path: str | list[str], pattern: str = "*.json") -> DataFrame:
    """Index documents below ``path`` at any depth, with their ``source_file``.

    A file holds one JSON object, or an array of them, over many lines. The
    schema is given, not inferred: no job runs before the first action, and a
    batch in which an optional field never occurs still has its column. A file
    that is not JSON becomes one row with its text in ``_corrupt_record``.
    ``source_file`` is the URI-encoded base name of the file.

    Such files cannot be split: Spark packs small ones into a task up to
    ``spark.sql.files.maxPartitionBytes`` and gives a large one its own task.
    """
    return (
        spark.read.schema(INDEX_SCHEMA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
        .select(F.col("_metadata.file_name").alias("source_file"), "*")
    )


def passed_over(spark: SparkSession, path: str | list[str], pattern: str = "*.json") -> list[str]:
    """Files that look like documents but have a hidden name, so that :func:`read_index_documents` does not see them."""
    paths = [path] if isinstance(path, str) else path
    return [f for p in paths for f in hidden_files(spark, p) if fnmatch(f.rpartition("/")[2], pattern) and "/_ledger/" not in f]
