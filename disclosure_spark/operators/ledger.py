"""The landed ledger: a table of which blob owns which landing path, and of which size it came.

It is append-only and partitioned by reporting date, below ``_ledger`` in the landing zone, a name that
Spark's readers of the zone pass over. A run reads the partitions of the dates it plans and no
folder of files, whatever has landed before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import date_prefix
from ..workspace import path_exists
from .blobs import mark_landed, own_path

LEDGER_SCHEMA = "name string, downloadUrl string, path string, size bigint, bytes bigint, run string, date string"
UNDATED = "undated"


def ledger_path(root: str, source: str, file_type: str) -> str:
    return f"{root.rstrip('/')}/_ledger/{source}/{file_type}"


def ledger_date(name: str | Column = "name") -> Column:
    """The partition of a blob: the date its name starts with, if it is one."""
    prefix = date_prefix(name)
    return F.when(prefix.rlike(r"^\d{4}-\d{2}-\d{2}$"), prefix).otherwise(F.lit(UNDATED))


def read_ledger(spark: SparkSession, path: str, dates: Sequence[str]) -> DataFrame:
    """The rows of these dates; those without a partition have none."""
    folders = [f for d in dates if path_exists(spark, f := f"{path}/date={d}")]
    if not folders:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).option("basePath", path).parquet(*folders)


def append(rows: DataFrame, path: str) -> None:
    """Add name, downloadUrl, path, size, bytes and run of blobs that have landed."""
    rows.withColumn("date", ledger_date()).write.mode("append").partitionBy("date").parquet(path)


def mark(plan: DataFrame, ledger: DataFrame, *, order: Sequence[str] | None = None) -> DataFrame:
    """``plan`` with a ``status``, ``pending`` or ``skipped``, and ``collision``.

    A blob is its name and URL. One that the ledger knows keeps its path whatever the order of the listing, and is
    skipped unless the listing now gives another size. A new blob gets the usual path if the ledger names no owner of it
    and no new blob of that path comes before, else a path of its own (``collision``). Repeats of a blob are skipped.

    Firsts and latest are least and greatest values, aggregated before they shuffle.
    """
    order = order or [c for c in ("page", "pos") if c in plan.columns]
    place = F.struct(*dict.fromkeys([*order, "name", "size", "downloadUrl"]))
    placed = plan.withColumn("_place", place).withColumn("_blob", F.struct("name", "downloadUrl"))
    blobs = placed.groupBy("path", "_blob").agg(F.min("_place").alias("_first"))
    latest = ledger.groupBy(F.struct("name", "downloadUrl").alias("_blob")).agg(
        F.max(F.struct("run", F.col("path").alias("own"), F.col("size").alias("came"))).alias("_last")
    )
    blobs = blobs.join(latest, "_blob", "left")
    owned = ledger.select("path").distinct()
    new = blobs.filter(F.col("_last").isNull()).join(owned, "path", "left_anti")
    owners = new.groupBy("path").agg(F.min(F.struct("_first", "_blob"))["_blob"].alias("_owner"))
    blobs = blobs.join(owners, "path", "left")
    own = own_path("path", F.col("_blob.name"), F.col("_blob.downloadUrl"))
    final = F.coalesce("_last.own", F.when(F.col("_blob").eqNullSafe(F.col("_owner")), F.col("path")), own)
    # A size that the listing does not give tells nothing.
    same = F.col("_first.size").isNull() | F.col("_last.came").eqNullSafe(F.col("_first.size"))
    blobs = blobs.select("path", "_blob", "_first", final.alias("_path"), (F.col("_last").isNotNull() & same).alias("_here"))
    wanted = ~F.col("_here") & F.col("_place").eqNullSafe(F.col("_first"))
    return placed.join(blobs, ["path", "_blob"]).select(
        *[F.col("_path").alias(c) if c == "path" else F.col(c) for c in plan.columns],
        F.when(wanted, "pending").otherwise("skipped").alias("status"),
        (F.col("_path") != F.col("path")).alias("collision"),
    )


def adopt(plan: DataFrame, landed: DataFrame, run: str, *, order: Sequence[str] | None = None) -> DataFrame:
    """Ledger rows for files that landed before there was a ledger, where a blob's path and size are those of a file."""
    marked = mark_landed(plan, landed, order=order).filter("status = 'skipped'")
    files = landed.select("path", F.col("size").alias("bytes"))
    found = marked.join(files, "path").filter(F.col("size").isNull() | (F.col("size") == F.col("bytes")))
    return found.select("name", "downloadUrl", "path", "size", "bytes", F.lit(run).alias("run")).distinct()
