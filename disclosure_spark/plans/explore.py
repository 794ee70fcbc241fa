"""Analysis queries over the flat table.

Each takes the flat table as a DataFrame and returns a DataFrame. Groupings
aggregate partially before they shuffle, so a key that holds a large part of
the rows arrives as one row per task; distinct counts first group by key and
value, which spreads such a key over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import percent


def overview(files: DataFrame) -> DataFrame:
    """Rows and source files."""
    return files.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("source_file").alias("source_files"),
    )


def allowed_share(files: DataFrame) -> DataFrame:
    """Source files that refer to an allowed-amount file, and their percentage of all files.

    Both counts come from one grouping by file, so the table is scanned once.
    """
    per_file = (
        files.filter(F.col("source_file").isNotNull())
        .groupBy("source_file")
        .agg(F.bool_or(F.col("allowed_amount_location").isNotNull()).alias("has_allowed"))
    )
    counts = per_file.agg(
        F.count_if("has_allowed").alias("files_with_allowed_amount"),
        F.count("*").alias("_files"),
    )
    share = percent(F.col("files_with_allowed_amount"), F.col("_files"))
    return counts.select("files_with_allowed_amount", share.alias("pct"))


def sponsor_nulls(files: DataFrame) -> DataFrame:
    """Rows without a plan sponsor and the source files they are in."""
    return files.filter(F.col("plan_sponsor_name").isNull()).agg(
        F.count("*").alias("null_sponsor_rows"),
        F.count_distinct("source_file").alias("affected_files"),
    )


def null_sponsor_files(files: DataFrame) -> DataFrame:
    """The source files that have a row without a plan sponsor."""
    return files.filter(F.col("plan_sponsor_name").isNull()).select("source_file").distinct()


def top_plans(files: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent plan names; equal counts are ordered by name."""
    counts = files.groupBy("plan_name").agg(F.count("*").alias("total"))
    return counts.orderBy(F.desc("total"), "plan_name").limit(n)


def entity_profile(files: DataFrame) -> DataFrame:
    """Plan ids, plan names and rows per reporting entity, with its share of all rows.

    The total is a scalar subquery. It counts the table's rows without reading
    a column, whereas a window over all groups would pull them into one task.
    """
    total = files.agg(F.count("*").alias("total")).scalar()
    groups = files.groupBy("reporting_entity_name").agg(
        F.count_distinct("plan_id").alias("unique_plan_id"),
        F.count_distinct("plan_name").alias("unique_plans"),
        F.count("*").alias("total_rows"),
    )
    share = percent(F.col("total_rows"), F.col("_total")).alias("pct_of_total")
    shares = groups.select("*", total.alias("_total")).select("*", share).drop("_total")
    return shares.orderBy(F.desc("total_rows"), "reporting_entity_name")


def entity_like(files: DataFrame, text: str) -> DataFrame:
    """Rows of the reporting entities whose name contains ``text``."""
    named = files.filter(F.col("reporting_entity_name").contains(text))
    return named.groupBy("reporting_entity_name").agg(F.count("*").alias("total"))


def shared_plan_ids(files: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` plan ids found in most source files, if in more than one.

    Their order needs the files alone. The sponsors are counted in a second scan, of these ids, so that no sponsor of the others
    is shuffled.
    """
    counts = files.groupBy("plan_id").agg(F.count_distinct("source_file").alias("files"))
    most = counts.filter("files > 1").orderBy(F.desc("files"), "plan_id").limit(n)
    named = files.select(F.col("plan_id").alias("_id"), "plan_sponsor_name")
    of_most = most.join(named, F.col("plan_id").eqNullSafe(F.col("_id")))
    found = of_most.groupBy("plan_id", "files").agg(F.count_distinct("plan_sponsor_name").alias("sponsor_names"))
    return found.orderBy(F.desc("files"), "plan_id").limit(n)


def sponsor_issuer_diff(files: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows whose plan sponsor and issuer differ."""
    columns = ["plan_sponsor_name", "issuer_name", "source_file"]
    differing = files.select(*columns).filter("plan_sponsor_name != issuer_name")
    return differing.orderBy(*columns).limit(n)


def preview(
    files: DataFrame,
    keys: Sequence[str] = ("source_file", "plan_id", "in_network_location"),
    n: int = 5,
) -> DataFrame:
    """The first ``n`` rows in the order of ``keys``, then of the other columns.

    A first scan reads the keys alone and finds the greatest first key among the first ``n``. All columns
    are read only of rows up to it: that bound is known before the second scan starts and is pushed into it.
    """
    rest = [c for c in files.columns if c not in keys]
    first = files.select(*keys).orderBy(*keys).limit(n)
    # Nulls come first, so a bound that is null leaves only them.
    bound = first.agg(F.max(keys[0])).scalar()
    return files.filter(F.col(keys[0]).isNull() | (F.col(keys[0]) <= bound)).orderBy(*keys, *rest).limit(n)
