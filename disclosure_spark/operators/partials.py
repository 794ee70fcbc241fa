"""Exact distinct counts over a growing history, from partials that are kept by date.

For each date the partials hold every (key, value) that occurs, with its rows. Distinct counts of all dates come from
merging them: they are far fewer than the rows, and when a date is loaded or replaced only that date is read again.
A value that occurs on many dates is still counted once, which sums of daily counts would not do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import percent
from ..schemas import PARTITION_COLUMN
from .store import drop_dates, replace_partitions

# kind: (key column or None for all rows, column whose values are counted)
KINDS: Mapping[str, tuple[str | None, str]] = {
    "files": (None, "source_file"),
    "plan_ids": ("reporting_entity_name", "plan_id"),
    "plan_names": ("reporting_entity_name", "plan_name"),
}


def date_partials(files: DataFrame, kinds: Mapping[str, tuple[str | None, str]] = KINDS) -> DataFrame:
    """partition_date, kind, key, value, rows: what each date has of every kind. One scan, aggregated before it shuffles."""
    entries = [
        F.struct(
            F.lit(kind).alias("kind"),
            (F.col(key) if key else F.lit(None).cast("string")).alias("key"),
            F.col(value).alias("value"),
        )
        for kind, (key, value) in kinds.items()
    ]
    each = files.select(PARTITION_COLUMN, F.inline(F.array(*entries)))
    return each.groupBy(PARTITION_COLUMN, "kind", "key", "value").agg(F.count("*").alias("rows"))


def refresh(spark: SparkSession, files: DataFrame, path: str, dates: Sequence[str] | None = None) -> None:
    """Make the partials below ``path`` anew for these dates (all of them by default); the scan reads no other date.

    A date that has no rows any more loses its partials.
    """
    if dates is not None:
        files = files.filter(F.col(PARTITION_COLUMN).isin([F.to_date(F.lit(str(d))) for d in dates]))
    # By date, as a task that has some of every date would write as many files.
    partials = date_partials(files).hint("rebalance", PARTITION_COLUMN)
    replace_partitions(partials, path, plain=["value"])
    if dates is not None:
        kept = {str(r[0]) for r in files.select(PARTITION_COLUMN).distinct().collect()}
        drop_dates(spark, path, sorted({str(d) for d in dates} - kept))


def overview(partials: DataFrame) -> DataFrame:
    """Rows and source files of all dates, as ``plans.explore.overview`` gives them."""
    return partials.filter("kind = 'files'").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"), F.count_distinct("value").alias("source_files")
    )


def entity_profile(partials: DataFrame) -> DataFrame:
    """Plan ids, plan names and rows per reporting entity, as ``plans.explore.entity_profile`` gives them."""
    own = partials.filter("kind IN ('plan_ids', 'plan_names')")
    # Every value once, whatever the number of dates, before it is counted.
    merged = own.groupBy("key", "kind", "value").agg(F.sum("rows").alias("rows"))
    counted = merged.groupBy(F.col("key").alias("reporting_entity_name")).agg(
        F.count_if((F.col("kind") == "plan_ids") & F.col("value").isNotNull()).alias("unique_plan_id"),
        F.count_if((F.col("kind") == "plan_names") & F.col("value").isNotNull()).alias("unique_plans"),
        F.sum(F.when(F.col("kind") == "plan_ids", F.col("rows"))).alias("total_rows"),
    )
    total = partials.filter("kind = 'files'").agg(F.sum("rows").alias("total")).scalar()
    share = percent(F.col("total_rows"), F.col("_total")).alias("pct_of_total")
    return counted.select("*", total.alias("_total")).select("*", share).drop("_total")
