"""Row counts, null profiles and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import percent
from ..schemas import CORRUPT_COLUMN, FLAT_NAMES, PARTITION_COLUMN, REQUIRED_NAMES


class NoDocumentsError(ValueError):
    """No input document was found."""


class RejectedDocumentsError(ValueError):
    """More documents could not be parsed than are allowed."""


class EmptyResultError(ValueError):
    """A step produced no rows."""


class RefusedRowsError(ValueError):
    """More rows were refused by the typed load than are allowed."""


class CountMismatchError(ValueError):
    """A date does not hold the rows it should."""


def _null_counts(columns: Sequence[str]) -> list[Column]:
    return [(F.count("*") - F.count(c)).alias(c) for c in columns]


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count of every column, as one row, in one pass."""
    return df.agg(*_null_counts(columns or df.columns))


def null_profile_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The columns that have nulls, with their count and percentage of rows."""
    columns = list(columns or df.columns)
    counts = df.agg(*_null_counts(columns), F.count("*").alias("_rows"))
    long = counts.unpivot("_rows", columns, "column_name", "null_count")
    return long.filter("null_count > 0").select(
        "column_name", "null_count", percent(F.col("null_count"), F.col("_rows")).alias("pct")
    )


def not_null_check(df: DataFrame, required: Sequence[str] = tuple(REQUIRED_NAMES)) -> DataFrame:
    """Null count of every required column, one row per column."""
    counts = null_profile(df, required)
    long = counts.unpivot([], list(required), "column_name", "null_count")
    return long.withColumn("passed", F.col("null_count") == 0)


def observe_documents(documents: DataFrame, observation: Observation) -> DataFrame:
    """Count documents and parse rejects while they are being written."""
    return documents.observe(
        observation,
        F.count("*").alias("documents"),
        F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("rejects"),
    )


def observe_rows(df: DataFrame, observation: Observation) -> DataFrame:
    """Count rows and the nulls of every flat column while they are being written.

    Place it after the last shuffle: tasks of the writing stage are counted
    once each, whereas a map stage that runs again after the loss of an
    executor would be counted again.
    """
    return df.observe(observation, F.count("*").alias("rows"), *_null_counts(FLAT_NAMES))


def partition_counts(df: DataFrame, column: str = PARTITION_COLUMN) -> DataFrame:
    """Rows per date; on a stored table this reads no data column."""
    return df.groupBy(F.col(column)).agg(F.count("*").alias("rows"))


def footer_session(spark: SparkSession) -> SparkSession:
    """A session whose counts of Parquet rows, also by partition, come from the files' footers alone.

    The settings are its own; those of ``spark`` stay as they are.
    """
    own = spark.newSession()
    others = [x for x in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if x.strip() != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(others))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def stored_counts(spark: SparkSession, path: str, column: str = PARTITION_COLUMN) -> DataFrame:
    """:func:`partition_counts` of the files below ``path``, from their footers."""
    return partition_counts(footer_session(spark).read.parquet(path), column)


def compare_counts(source: DataFrame, target: DataFrame, column: str = PARTITION_COLUMN) -> DataFrame:
    """Rows of each date in ``source`` and ``target``, and whether they are equal.

    Dates found in one of the two only count as zero rows in the other.
    """
    expected = partition_counts(source, column).withColumnRenamed("rows", "rows_expected")
    loaded = partition_counts(target, column).withColumnRenamed("rows", "rows_loaded")
    both = expected.join(loaded, column, "full_outer").select(
        column,
        F.coalesce("rows_expected", F.lit(0)).alias("rows_expected"),
        F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"),
    )
    return both.withColumn("matches", F.col("rows_expected") == F.col("rows_loaded"))


def verify_counts(source: DataFrame, target: DataFrame, column: str = PARTITION_COLUMN) -> int:
    """Raise unless every date of ``source`` is in ``target`` row for row; else the total.

    ``target`` may hold more dates: only the range of those in ``source`` is
    read, which prunes the partitions of a large table. What reaches the driver
    is one row, however many dates there are.
    """
    first, last = source.agg(F.min(column), F.max(column)).first()
    target = target.filter(F.col(column).between(F.lit(first), F.lit(last)))
    compared = compare_counts(source, target, column).filter("rows_expected > 0")
    wrong = ~F.col("matches")
    result = compared.agg(
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("total"),
        F.count_if(wrong).alias("wrong"),
        F.min(F.when(wrong, F.struct(column, "rows_expected", "rows_loaded"))).alias("first"),
    ).first()
    if result["wrong"]:
        date, expected, loaded = result["first"]
        raise CountMismatchError(
            f"{result['wrong']} date(s) differ; first {date}: expected {expected}, loaded {loaded}"
        )
    return result["total"]


def verify_total(spark: SparkSession, path: str, expected: int) -> int:
    """Raise unless the files below ``path`` have so many rows, by their footers, and at least one; else the rows."""
    if not expected:
        raise EmptyResultError("no rows to load")
    total = stored_counts(spark, path).agg(F.sum("rows")).first()[0]
    if total != expected:
        raise CountMismatchError(f"expected {expected} rows, loaded {total}")
    return total
