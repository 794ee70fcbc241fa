"""The batch jobs: listing to raw files, raw files to flat Parquet, flat Parquet to the table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import date_prefix
from ..operators import ledger, versions
from ..operators.blobs import plan_downloads, status_counts
from ..operators.flatten import flatten, flatten_by_date, rows_of_document
from ..operators.landing import fetch
from ..operators.quality import (
    EmptyResultError,
    NoDocumentsError,
    RefusedRowsError,
    RejectedDocumentsError,
    footer_session,
    observe_documents,
    observe_rows,
    partition_counts,
    verify_counts,
)
from ..operators.store import (
    date_groups,
    drop_dates,
    drop_table_dates,
    emptied_dates,
    empty_rows,
    open_writers,
    packing_session,
    partition_dates,
    quoted,
    record_dates,
    replace_partitions,
    replace_table_partitions,
    split_refused,
    to_table_rows,
    with_partition_column,
)
from ..schemas import CORRUPT_COLUMN, FLAT_NAMES, INDEX_SCHEMA
from ..sources.documents import passed_over, read_index_documents
from ..sources.listing import read_landed, read_listing
from ..sources.tables import read_index_files
from ..workspace import delete_path, folder_bytes, folder_names, path_exists, run_path

STAGE_ROW_GROUP_BYTES = 16 << 20
STAGE_DATE = "staged_date"
STAGE_ROWS = "staged_rows"  # how many flat rows a staged document yields, so that counting them does not read it
# Staged bytes from which a date is flattened without a shuffle: a task of the scan (128 MB by an open cost of 4 MB a file) then
# has fewer dates than files that it keeps open (operators.store.OPEN_FILES).
LARGE_DATE_BYTES = 8 << 20
DOCUMENT_TASK_BYTES = 32 << 20  # of files of documents, often compressed, that a task parses
DOCUMENT_OPEN_BYTES = 64 << 10  # that a file counts more than it has
MOST_DOCUMENT_ROWS = 10_000_000  # of a document that one task may write


def extract(
    spark: SparkSession,
    listing_url: str,
    root: str,
    *,
    source: str,
    file_type: str,
    max_files: int | None,
    max_size: int | None = None,
    suffix: str | None = None,
    headers: Mapping[str, str] | None = None,
    tasks: int | None = None,
) -> dict[str, int]:
    """Land the planned blobs of a listing below ``root``; skip those that the ledger has.

    Returns the files downloaded, skipped and failed, and how many of all had a collision of paths. A run that was stopped or
    had failures is taken up again by running it once more. What has landed is read from the ledger (``operators.ledger``), of the
    planned dates only. A date without a ledger adopts its files, once, where their sizes are those of the listing.
    """
    run = run_path(spark, "extract")
    one = spark.createDataFrame([("listing.json", listing_url)], "path string, downloadUrl string")
    saved = fetch(one, run, f"{run}/listing_report", tasks=1, headers=headers).first()
    if saved["status"] == "failed":
        raise OSError(f"no listing from {listing_url}: {saved['error']}")

    plan = plan_downloads(
        read_listing(spark, f"{run}/listing.json"),
        source=source,
        file_type=file_type,
        max_files=max_files,
        max_size=max_size,
        suffix=suffix,
    )
    book = ledger.ledger_path(root, source, file_type)
    turn = f"{datetime.now(timezone.utc).isoformat()} {uuid.uuid4().hex}"
    dates = sorted(row[0] for row in plan.select(ledger.ledger_date()).distinct().collect())  # few
    folder = f"{root.rstrip('/')}/{source}/{file_type}"
    for date in dates:
        before = f"{folder}/{date}"
        if not path_exists(spark, f"{book}/date={date}") and path_exists(spark, before):
            of_date = plan.filter(ledger.ledger_date() == date)
            ledger.append(ledger.adopt(of_date, read_landed(spark, before), turn), book)
    # Stored once: the statuses decide what is fetched and are counted afterwards,
    # when the ledger they were compared with has changed.
    marked_path = f"{run}/marked"
    ledger.mark(plan, ledger.read_ledger(spark, book, dates)).write.parquet(marked_path)
    marked = spark.read.parquet(marked_path)

    pending = marked.filter(F.col("status") == "pending")
    fetched = fetch(pending, root, f"{run}/report", tasks=tasks, headers=headers, replace=True)
    arrived = fetched.filter("status = 'downloaded'").select("path", "bytes").distinct()
    done = pending.join(arrived, "path").select("name", "downloadUrl", "path", "size", "bytes", F.lit(turn).alias("run"))
    ledger.append(done.distinct(), book)
    statuses = fetched.select("status").unionAll(
        marked.filter(F.col("status") == "skipped").select("status")
    )
    counts = status_counts(statuses, ("downloaded", "skipped", "failed"))
    found = {row["status"]: row["files"] for row in counts.collect()}
    found["collision"] = marked.filter("collision").count()
    if not found["failed"]:
        delete_path(spark, run)
    return found


@dataclass(frozen=True)
class TransformResult:
    """Counts of one transform run."""

    documents: int
    rejects: int
    rows: int
    null_counts: dict[str, int]
    stage: str | None  # None once it is deleted
    dates: list[str]  # of the documents read; what a load of this run takes
    passed_over: int = 0  # files like documents that were not read, as their names are hidden ones


def transform(
    spark: SparkSession,
    raw: str | list[str],
    processed: str,
    *,
    processed_at: str | datetime | None = None,
    pattern: str = "*.json",
    max_rejects: int = 0,
    partitions: int | None = None,
    stage: str | None = None,
    clear_empty: bool = False,
) -> TransformResult:
    """Parse the documents below ``raw`` and replace their dates in ``processed``.

    The text is parsed once, into a nested Parquet copy in the shared folder, by the date in the file's name
    (``stage``; by default a new path per run). That step has no shuffle, so its
    document and reject counts are exact also after the loss of an executor,
    and they are checked before anything in ``processed`` changes. The flatten
    then reads the columnar copy, and a lost task costs no second parse.
    The dates of the documents are replaced, also one whose documents now give no rows, and noted in a manifest
    (``operators.store.record_dates``). If no document gives a row the run stops, or with ``clear_empty`` removes their dates.
    A stage that the caller did not name is deleted unless there are rejects or a failure.
    """
    started = datetime.now(timezone.utc).isoformat()
    processed_at = processed_at or datetime.now()
    keep_stage, stage = stage is not None, stage or run_path(spark, "transform")

    read = Observation("documents")
    documents = read_index_documents(spark, raw, pattern).withColumn(STAGE_DATE, _date())
    stage_documents(observe_documents(documents, read), stage, by_date=True)
    found = read.get
    if not found.get("documents"):
        raise NoDocumentsError(f"no documents like {pattern} below {raw}")
    if found["rejects"] > max_rejects:
        raise RejectedDocumentsError(
            f"{found['rejects']} documents could not be parsed, {max_rejects} allowed; see {stage}"
        )

    dates, undated = document_dates(staged_documents(spark, stage))
    if undated and found["rejects"] + undated > max_rejects:
        raise RejectedDocumentsError(f"{undated} documents have no date in their name, {max_rejects} rejects allowed; see {stage}")
    rows_by_date = {d: n for d, (n, _) in dates.items()}
    counted = {"rows": 0} | dict.fromkeys(FLAT_NAMES, 0)
    if any(rows_by_date.values()):
        counted = write_staged(spark, stage, processed, processed_at, {d: most for d, (_, most) in dates.items()}, partitions)
    elif not clear_empty:
        raise EmptyResultError("the documents gave no rows; check the input files")
    drop_dates(spark, processed, [d for d, rows in rows_by_date.items() if not rows])
    record_dates(spark, processed, rows_by_date, started)
    rejects = found["rejects"] + undated
    if not (keep_stage or rejects):
        delete_path(spark, stage)
        stage = None
    return TransformResult(
        documents=found["documents"],
        rejects=rejects,
        rows=counted["rows"],
        null_counts={c: counted[c] for c in FLAT_NAMES},
        stage=stage,
        dates=sorted(rows_by_date),
        passed_over=len(passed_over(spark, raw, pattern)),
    )


def _date() -> Column:
    prefix = F.try_to_timestamp(date_prefix("source_file"), F.lit("yyyy-MM-dd"))
    return F.date_format(prefix, "yyyy-MM-dd")


def dated_documents(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """The documents below a folder with a folder for each date, such that a task has documents of few dates.

    One scan packs files by size, whatever their date, and a task of many small files would then write a staged file for each
    of many dates: as many files as there were. So there is a scan for each group of neighbouring dates.
    """
    sizes = {name: folder_bytes(spark, f"{folder}/{name}") for name in folder_names(spark, folder)}
    groups = date_groups(sizes, -(-sum(sizes.values()) // DOCUMENT_TASK_BYTES))
    if not groups:
        raise NoDocumentsError(f"no dates below {folder}")
    own = packing_session(spark, DOCUMENT_TASK_BYTES, DOCUMENT_OPEN_BYTES, all_cores=True)
    return reduce(DataFrame.unionByName, [read_index_documents(own, [f"{folder}/{d}" for d in group], pattern) for group in groups])


def document_dates(documents: DataFrame) -> tuple[dict[str, tuple[int, int]], int]:
    """Of each date in the names of documents (few) all flat rows and the most of one document; how many documents have none."""
    rows = F.col(STAGE_ROWS) if STAGE_ROWS in documents.columns else rows_of_document()
    found = documents.groupBy(_date().alias("date")).agg(F.count("*").alias("documents"), F.sum(rows).alias("rows"), F.max(rows).alias("most"))
    by_date = {row["date"]: row for row in found.collect()}
    undated = by_date.pop(None, None)
    return {d: (row["rows"] or 0, row["most"] or 0) for d, row in by_date.items()}, undated["documents"] if undated else 0


def stage_documents(documents: DataFrame, stage: str, by_date: bool = False) -> None:
    """Keep nested documents as Parquet, in row groups small enough to share out.

    A document becomes many rows, so the tasks that flatten should be able to
    take less of the copy than a row group of the usual size. ``by_date`` puts each date into a folder of its own, and
    notes the rows of each document.
    """
    if by_date:
        documents = documents.withColumn(STAGE_ROWS, rows_of_document())
    writer = documents.write.mode("overwrite").option("parquet.block.size", STAGE_ROW_GROUP_BYTES)
    with open_writers(documents.sparkSession):
        (writer.partitionBy(STAGE_DATE) if by_date else writer).parquet(stage)


def staged_documents(spark: SparkSession, stage: str, dates: Sequence[str] | None = None) -> DataFrame:
    """The documents of a stage by date; of these dates only, whose folders alone are then listed."""
    reader = spark.read.schema(f"source_file string, {INDEX_SCHEMA}, {STAGE_ROWS} bigint, {STAGE_DATE} string").option("basePath", stage)
    return reader.parquet(stage) if dates is None else reader.parquet(*[f"{stage}/{STAGE_DATE}={d}" for d in dates])


def large_dates(spark: SparkSession, stage: str, most_rows: Mapping[str, int], least_bytes: int = LARGE_DATE_BYTES) -> list[str]:
    """Dates that fill tasks of their own: of so many staged bytes, and without a document too large for one task."""
    return sorted(
        d for d, most in most_rows.items()
        if 0 < most <= MOST_DOCUMENT_ROWS and folder_bytes(spark, f"{stage}/{STAGE_DATE}={d}") >= least_bytes
    )


def flat_by_date(
    spark: SparkSession,
    stage: str,
    processed_at: str | datetime,
    most_rows: Mapping[str, int],
    partitions: int | None = None,
    least_bytes: int = LARGE_DATE_BYTES,
) -> DataFrame:
    """The flat rows of a stage for a write by date.

    Documents are staged by date, so those of a large date are read by tasks that hold hardly another date: they are flattened where they
    are, without a shuffle. The small dates, of which a task reads many, are brought together by date.
    """
    large = large_dates(spark, stage, most_rows, least_bytes)
    small = sorted(set(most_rows) - set(large))
    parts = []
    if large:
        parts.append(flatten(staged_documents(spark, stage, large), processed_at))
    if small:
        parts.append(flatten_by_date(staged_documents(spark, stage, small), processed_at, partitions))
    return with_partition_column(reduce(DataFrame.unionByName, parts))


def write_staged(
    spark: SparkSession,
    stage: str,
    processed: str,
    processed_at: str | datetime,
    most_rows: Mapping[str, int],
    partitions: int | None = None,
    least_bytes: int = LARGE_DATE_BYTES,
) -> dict[str, int]:
    """Flatten a stage into ``processed``, replacing its dates; gives row and null counts."""
    written = Observation("rows")
    rows = flat_by_date(spark, stage, processed_at, most_rows, partitions, least_bytes)
    replace_partitions(observe_rows(rows, written), processed)
    return written.get


def write_flat(
    documents: DataFrame,
    processed: str,
    processed_at: str | datetime,
    partitions: int | None = None,
    clustered: bool = False,
) -> dict[str, int]:
    """Flatten into ``processed``, replacing the dates found; gives row and null counts.

    ``clustered``: the documents lie by date already, so they are flattened where they are, without a shuffle.
    """
    written = Observation("rows")
    rows = with_partition_column(flatten(documents, processed_at) if clustered else flatten_by_date(documents, processed_at, partitions))
    replace_partitions(observe_rows(rows, written), processed)
    return written.get


def rejected_documents(spark: SparkSession, stage: str) -> DataFrame:
    """The texts that could not be parsed in a transform run, with their file."""
    staged = spark.read.parquet(stage)
    return staged.filter(F.col(CORRUPT_COLUMN).isNotNull()).select("source_file", CORRUPT_COLUMN)


def load(
    spark: SparkSession,
    processed: str,
    target: str | None = None,
    *,
    table: str | None = None,
    versioned: str | None = None,
    dates: Sequence[str] | None = None,
    loaded_at: datetime | Column | None = None,
    quarantine: str | None = None,
    max_refused: int = 0,
) -> int:
    """Load processed dates into the table at path ``target`` (or catalog ``table``, or ``versioned`` table).

    Each date of the batch replaces that date in the table and all others stay. A date of which nothing is
    left in ``processed`` is removed: one that the transform's manifest has as read without a row, and any
    that is named in ``dates`` while others have rows. A versioned table shows all dates of a load at once or none.

    Casts and required columns are checked in the writing job itself, which
    publishes nothing when it fails. With ``quarantine`` refused rows do not fail the load: they are added there with their
    reason, and the others are loaded, unless more than ``max_refused`` are refused. Afterwards the rows of every date are
    compared with the source, both from the files' footers. Returns the rows loaded. No shuffle: the
    processed files are by date already.
    """
    if sum(x is not None for x in (target, table, versioned)) != 1:
        raise ValueError("give one of target, table and versioned")
    asked = None if dates is None else {str(d) for d in dates}
    stored = set(partition_dates(spark, processed))
    present = stored if asked is None else stored & asked
    emptied = emptied_dates(spark, processed) - stored
    emptied = sorted(emptied if asked is None else (emptied & asked) | (asked - stored if present else set()))
    source = read_index_files(spark, processed, dates) if present else None
    if source is None or source.isEmpty():
        if not emptied:
            raise EmptyResultError(f"no rows to load in {processed}")
        if versioned is not None:
            versions.publish(empty_rows(spark), versioned, dates=emptied)
        elif table is not None:
            drop_table_dates(spark, table, emptied)
        else:
            drop_dates(spark, target, emptied)
        return 0

    counter = footer_session(spark)
    expected = read_index_files(counter, processed, dates)
    if quarantine is not None:
        run = run_path(spark, "load")
        source, refused, n = split_refused(source, f"{run}/split")
        expected = source
        refused.withColumn("refused_at", F.current_timestamp()).write.mode("append").parquet(quarantine)
        if n > max_refused:
            raise RefusedRowsError(f"{n} rows are refused, {max_refused} allowed; see {quarantine}")
    rows = to_table_rows(source, loaded_at)
    if versioned is not None:
        wanted = {str(r[0]): r[1] for r in partition_counts(expected).collect()}
        total = sum(versions.publish(rows, versioned, dates=emptied, expected=wanted).values())
    elif table is not None:
        replace_table_partitions(rows, table)
        drop_table_dates(spark, table, emptied)
        total = verify_counts(read_index_files(spark, processed, dates) if quarantine is None else source, spark.table(quoted(table)))
    else:
        replace_partitions(rows, target)
        drop_dates(spark, target, emptied)
        total = verify_counts(expected, counter.read.parquet(target) if quarantine is None else spark.read.parquet(target))
    if quarantine is not None:
        delete_path(spark, run)
    return total
