"""Selection of blobs to fetch, as DataFrame operations over a listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import date_prefix, landing_name, visible

# The file types and the end of their names.
SUFFIXES = {
    "index": "_index.json",
    "in_network_rates": "_in-network-rates.json.gz",
    "allowed_amounts": "_allowed-amounts.json.gz",
}


MARK_LENGTH = 16


def landing_path(source: str, file_type: str, name: str | Column = "name") -> Column:
    """``source/file_type/date/name`` of a blob in the landing zone."""
    return F.concat_ws("/", F.lit(source), F.lit(file_type), visible(date_prefix(name)), landing_name(name))


def own_path(path: str | Column = "path", name: str | Column = "name", url: str | Column = "downloadUrl") -> Column:
    """The path of a blob whose usual path another blob has: a hash of name and URL ends its stem."""
    texts = [F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit("")) for x in (name, url)]
    mark = F.substring(F.md5(F.concat_ws("\n", *texts)), 1, MARK_LENGTH)
    folder = F.substring_index(path, "/", 3)  # the landing layout is <source>/<file type>/<date>/<name>
    return F.concat_ws("/", folder, landing_name(name, mark=mark))


def _selected(suffix: str, max_size: int | None) -> tuple[Column, Column]:
    of_type = F.col("name").endswith(suffix)
    small = F.lit(True) if max_size is None else F.col("size") <= max_size
    return of_type, of_type & small


def plan_downloads(
    listing: DataFrame,
    *,
    source: str,
    file_type: str,
    max_files: int | None,
    max_size: int | None = None,
    suffix: str | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """The first ``max_files`` blobs of a type in listing order, with their path.

    Both filters reach the scan; the limit becomes a top-k, in which no task
    passes on more than ``max_files`` rows. None takes all, without a sort. Without
    ``order`` a listing of several pages is in the order of page, then pos. An empty
    ``suffix`` takes all types.
    """
    _, selected = _selected(SUFFIXES[file_type] if suffix is None else suffix, max_size)
    planned = listing.filter(selected)
    if max_files is not None:
        order = order or [c for c in ("page", "pos") if c in listing.columns]
        planned = planned.orderBy(*dict.fromkeys([*order, "name", "size"])).limit(max_files)
    return planned.withColumn("path", landing_path(source, file_type))


def funnel(
    listing: DataFrame,
    *,
    file_type: str,
    max_files: int | None,
    max_size: int | None = None,
    suffix: str | None = None,
) -> DataFrame:
    """How many blobs remain after each step of the selection."""
    of_type, selected = _selected(SUFFIXES[file_type] if suffix is None else suffix, max_size)
    kept = F.count_if(selected)
    return listing.agg(
        F.count("*").alias("total"),
        F.count_if(of_type).alias("after_suffix"),
        F.count_if(selected).alias("after_size"),
        (kept if max_files is None else F.least(kept, F.lit(max_files).cast("bigint"))).alias("after_limit"),
    )


def mark_landed(
    plan: DataFrame, landed: DataFrame, *, order: Sequence[str] | None = None
) -> DataFrame:
    """``plan`` with a ``status``, ``pending`` or ``skipped``, and ``collision``.

    Blobs of other names or URLs may lead to one path: the first in listing order
    keeps it, the others get a path of their own (``collision`` is true, ``path`` is
    changed) and are fetched as well. Only repeats of a blob, with the same name and URL, and
    blobs that have landed are skipped. A path of its own depends on the blob alone,
    so a later run finds it again while the first blob of the path stays first.

    Firsts are least values, aggregated before they shuffle. A repeat of a row that is
    equal in all of the order's columns is pending twice, which fetches it once.
    """
    order = order or [c for c in ("page", "pos") if c in plan.columns]
    place = F.struct(*dict.fromkeys([*order, "name", "size", "downloadUrl"]))
    blob = F.struct("name", "downloadUrl")
    placed = plan.withColumn("_place", place).withColumn("_blob", blob)
    blobs = placed.groupBy("path", "_blob").agg(F.min("_place").alias("_first"))
    paths = blobs.groupBy("path").agg(F.min(F.struct("_first", "_blob"))["_blob"].alias("_owner"))
    blobs = blobs.join(paths, "path").select(
        "path",
        "_blob",
        "_first",
        (~F.col("_blob").eqNullSafe(F.col("_owner"))).alias("collision"),
    )
    final = F.when(F.col("collision"), own_path("path", F.col("_blob.name"), F.col("_blob.downloadUrl")))
    blobs = blobs.withColumn("_path", F.coalesce(final, "path"))
    here = landed.select(F.col("path").alias("_path")).join(blobs.select("_path"), "_path", "left_semi").distinct()
    blobs = blobs.join(here.withColumn("_here", F.lit(True)), "_path", "left")
    wanted = F.col("_here").isNull() & F.col("_place").eqNullSafe(F.col("_first"))
    return placed.join(blobs, ["path", "_blob"]).select(
        *[F.col("_path").alias(c) if c == "path" else F.col(c) for c in plan.columns],
        F.when(wanted, "pending").otherwise("skipped").alias("status"),
        "collision",
    )


def pending(plan: DataFrame, landed: DataFrame, **options) -> DataFrame:
    """The blobs of ``plan`` that still have to be fetched."""
    return mark_landed(plan, landed, **options).filter(F.col("status") == "pending").drop("status", "collision")


def status_counts(marked: DataFrame, statuses: Sequence[str] = ("pending", "skipped")) -> DataFrame:
    """Files per status; a status without files is reported as zero."""
    counts = marked.agg(*[F.count_if(F.col("status") == s).alias(s) for s in statuses])
    return counts.unpivot([], list(statuses), "status", "files")
