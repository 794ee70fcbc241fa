"""Profiling queries over the flat table, returning the tables behind its charts.

As in a data-frame notebook, groups of a null key are left out unless a
function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import bin_edge, bin_index, percent


def value_counts(df: DataFrame, column: str, *, keep_null: bool = False, n: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties by value; the top ``n`` if given."""
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    counts = rows.groupBy(column).agg(F.count("*").alias("total"))
    counts = counts.orderBy(F.desc("total"), column)
    return counts if n is None else counts.limit(n)


def entity_profile(files: DataFrame) -> DataFrame:
    """Rows, plan ids and source files per reporting entity."""
    named = files.filter(F.col("reporting_entity_name").isNotNull())
    return (
        named.groupBy("reporting_entity_name")
        .agg(
            F.count("source_file").alias("rows"),
            F.count_distinct("plan_id").alias("unique_plans"),
            F.count_distinct("source_file").alias("source_files"),
        )
        .orderBy(F.desc("rows"), "reporting_entity_name")
    )


def top_plans(files: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent plan names."""
    return value_counts(files, "plan_name", n=n)


def network_descriptions(files: DataFrame) -> DataFrame:
    """Rows per in-network description; rows without one are a group of their own."""
    return value_counts(files, "in_network_description", keep_null=True)


def null_sponsor_entities(files: DataFrame) -> DataFrame:
    """Rows without a plan sponsor per reporting entity."""
    return value_counts(files.filter(F.col("plan_sponsor_name").isNull()), "reporting_entity_name")


def allowed_presence(files: DataFrame) -> DataFrame:
    """Source files with and without an allowed-amount reference.

    Both rows are always there. An empty text is no reference.
    """
    location = F.coalesce("allowed_amount_location", F.lit(""))
    per_file = (
        files.filter(F.col("source_file").isNotNull())
        .groupBy("source_file")
        .agg(F.bool_or(location != "").alias("has_allowed"))
    )
    sides = per_file.agg(
        F.count_if(F.col("has_allowed")).alias("with_allowed"),
        F.count_if(~F.col("has_allowed")).alias("without_allowed"),
        F.count("*").alias("_all"),
    )
    long = sides.unpivot("_all", ["with_allowed", "without_allowed"], "presence", "source_files")
    return long.select("presence", "source_files", percent(F.col("source_files"), F.col("_all")).alias("pct"))


def rows_per_file(files: DataFrame) -> DataFrame:
    """Rows of each source file."""
    named = files.filter(F.col("source_file").isNotNull())
    return named.groupBy("source_file").agg(F.count("*").alias("rows"))


def _frequencies(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs.

    Row counts that add up to N have fewer than sqrt(2 N) distinct values, so
    what follows this grouping is small at any scale.
    """
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("n")
    )


def rows_per_file_stats(files: DataFrame) -> DataFrame:
    """Mean, minimum, maximum and exact median of the rows per source file."""
    return _frequencies(rows_per_file(files), "rows").agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean_rows"),
        F.min("value").alias("min_rows"),
        F.max("value").alias("max_rows"),
        F.percentile("value", 0.5, F.col("n")).alias("median_rows"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram of a numeric column: every bin, its edges and its count.

    Bins are half-open but for the last one. When all values are equal the
    range is widened by one half on each side.
    """
    counts = _frequencies(df, column)
    least, most = F.min("value").cast("double"), F.max("value").cast("double")
    pad = F.when(least == most, 0.5).otherwise(0.0)
    bounds = counts.agg(F.struct((least - pad).alias("low"), (most + pad).alias("high")).alias("range"))
    low, high = F.col("range.low"), F.col("range.high")

    binned = (
        counts.select("value", "n", bounds.scalar().alias("range"))
        .select(bin_index(F.col("value").cast("double"), low, high, bins).alias("bin"), "n")
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    # One row per bin: a table of fixed size, not a function of the data.
    frame = df.sparkSession.range(bins).select(F.col("id").alias("bin"), bounds.scalar().alias("range"))
    return frame.join(binned, "bin", "left").select(
        "bin",
        bin_edge(F.col("bin"), low, high, bins).alias("bin_start"),
        bin_edge(F.col("bin") + 1, low, high, bins).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def rows_per_file_histogram(files: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of the rows per source file."""
    return histogram(rows_per_file(files), "rows", bins).withColumnRenamed("n", "source_files")
