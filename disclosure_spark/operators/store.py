"""Writing the flat table: partitioned Parquet with per-date replacement."""

from __future__ import annotations

import re
import threading
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import FLAT_COLUMNS, LOADED_AT, PARTITION_COLUMN, TABLE_COLUMNS, FlatColumn
from ..workspace import delete_path, folder_names, path_exists


def with_partition_column(df: DataFrame) -> DataFrame:
    """Copy ``reporting_date`` to the partition column, so that it stays in the files too."""
    return df.withColumn(PARTITION_COLUMN, F.col("reporting_date"))


# Files that a task of a partitioned write keeps open. The scans of this library pack at most 32 files into a task (128 MB by
# an open cost of 4 MB each), so a task that reads files by date seldom has more dates.
OPEN_FILES = 32
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_writing: Counter = Counter()
_writing_lock = threading.Lock()


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """While this holds, partitioned writes of the session keep the files of up to ``OPEN_FILES`` partitions open in a task.

    Otherwise Spark sorts all rows of a task by partition before it writes them, which spills. Rows of further partitions
    are still sorted. A value that the session has is left, and else the setting is gone after the last of the writes.
    """
    with _writing_lock:
        if _writing[id(spark)] or spark.conf.get(_WRITERS, None) is None:
            _writing[id(spark)] += 1
            spark.conf.set(_WRITERS, str(OPEN_FILES))
            own = True
        else:
            own = False
    try:
        yield
    finally:
        with _writing_lock:
            if own:
                _writing[id(spark)] -= 1
                if not _writing[id(spark)]:
                    del _writing[id(spark)]
                    spark.conf.unset(_WRITERS)


@contextmanager
def file_rows(spark: SparkSession, most: int | None) -> Iterator[None]:
    """While this holds, files that the session writes have ``most`` rows; an insert into a table takes that from the session only."""
    key = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(key)
    if most is not None:
        spark.conf.set(key, most)
    try:
        yield
    finally:
        if most is not None:
            spark.conf.set(key, before)


# Columns whose many texts make dictionaries that are large, dear to look up and often given up. Their texts recur in
# neighbouring rows, so plain ones compress as well, in less time.
PLAIN_COLUMNS = ("source_file", "plan_name", "plan_id", "plan_sponsor_name", "issuer_name", "in_network_location", "allowed_amount_location")
NO_DICTIONARY = "parquet.enable.dictionary#"
COMPRESSION = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def write_options(plain: Sequence[str] = PLAIN_COLUMNS) -> dict[str, str]:
    """How flat rows are written as Parquet: quick compression, and no dictionaries of the ``plain`` columns."""
    return COMPRESSION | {f"{NO_DICTIONARY}{c}": "false" for c in plain}


def table_options(**others: str) -> str:
    """``write_options`` and others as the options of a catalog table."""
    return ", ".join(f"{literal(k)} {literal(v)}" for k, v in (write_options() | others).items())


def replace_partitions(df: DataFrame, path: str, plain: Sequence[str] = PLAIN_COLUMNS) -> None:
    """Write ``df``, replacing the dates it holds and keeping all others; ``plain`` as in :func:`write_options`.

    The files are published by the job's commit: a failing job leaves the old
    rows. The swap of several dates is not one transaction, though; plain
    Parquet offers none.
    """
    with open_writers(df.sparkSession):
        (
            df.write.mode("overwrite")
            .options(**write_options(plain))
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PARTITION_COLUMN)
            .parquet(path)
        )


def packing_session(spark: SparkSession, target_bytes: int, open_bytes: int = 0, all_cores: bool = False) -> SparkSession:
    """A session whose scans pack files into tasks up to a size, a file counting ``open_bytes`` more than it has.

    However many cores there are, unless ``all_cores`` asks for tasks for each of them. The settings are its own; those of
    ``spark`` stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(open_bytes))
    if not all_cores:
        own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own


MOST_GROUPS = 64


def date_groups(sizes: Mapping[str, int], n: int) -> list[list[str]]:
    """The dates in their order, cut into ``n`` groups of about the same size or fewer, and ``MOST_GROUPS`` at most.

    A scan packs files by their size, whatever their date. Scans of a group each leave hardly a task with many dates.
    """
    n = max(1, min(n, MOST_GROUPS, len(sizes)))
    total, before = max(1, sum(sizes.values())), 0
    groups: dict[int, list[str]] = {}
    for date in sorted(sizes):
        groups.setdefault(min(n - 1, (2 * before + sizes[date]) * n // (2 * total)), []).append(date)  # by its middle
        before += sizes[date]
    return list(groups.values())


def partition_dates(spark: SparkSession, path: str) -> list[str]:
    """The dates that ``path`` has a partition of; its folder alone is listed."""
    if not path_exists(spark, path):
        return []
    named = (name.partition("=") for name in folder_names(spark, path))
    return sorted(value for key, _, value in named if key == PARTITION_COLUMN)


def empty_rows(spark: SparkSession) -> DataFrame:
    """The table without a row."""
    columns = ", ".join(f"{c.name} {c.type}" for c in TABLE_COLUMNS)
    return spark.createDataFrame([], f"{columns}, {PARTITION_COLUMN} date")


def drop_dates(spark: SparkSession, path: str, dates: Sequence[str]) -> None:
    """Remove the partitions of these dates below ``path``, where there are any."""
    for date in dates:
        delete_path(spark, f"{path.rstrip('/')}/{PARTITION_COLUMN}={date}")


def drop_table_dates(spark: SparkSession, table: str, dates: Sequence[str]) -> None:
    """Like :func:`drop_dates`, for a catalog table."""
    for date in dates:
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS PARTITION ({PARTITION_COLUMN} = DATE {literal(date)})")


def to_table_rows(df: DataFrame, loaded_at: datetime | Column | None = None) -> DataFrame:
    """The 18 typed columns of the table, and the partition column.

    A null in a required column, and a text that is no date or timestamp, fail
    the job that evaluates this, in the same pass and also with ANSI mode off.
    """
    if loaded_at is None:
        loaded_at = F.current_timestamp()
    elif isinstance(loaded_at, datetime):
        loaded_at = F.lit(loaded_at.isoformat())
    typed = [_typed(c).alias(c.name) for c in FLAT_COLUMNS]
    rows = df.select(*typed, loaded_at.cast(LOADED_AT.type).alias(LOADED_AT.name))
    return with_partition_column(rows)


def _typed(column: FlatColumn) -> Column:
    value = F.col(column.name)
    if not column.required:
        return value.cast(column.type)
    found = F.coalesce(value.cast("string"), F.lit("null"))
    refusal = F.concat(F.lit(f"{column.name} must be a {column.type}, not "), found)
    return F.coalesce(value.try_cast(column.type), F.raise_error(refusal))


def refusals(df: DataFrame) -> Column:
    """What the typed load would refuse about a row, as text; null for a row that it takes."""
    reasons = [
        F.when(F.col(c.name).try_cast(c.type).isNull(), F.concat(F.lit(f"{c.name} must be a {c.type}, not "), F.coalesce(F.col(c.name).cast("string"), F.lit("null"))))
        for c in FLAT_COLUMNS
        if c.required
    ]
    return F.nullif(F.concat_ws("; ", *reasons), F.lit(""))


def split_refused(df: DataFrame, stage: str) -> tuple[DataFrame, DataFrame, int]:
    """Rows that the load takes, those that it refuses with a ``reason``, and how many these are.

    One pass over ``df`` writes both to ``stage`` in the shared folder and counts them while writing.
    """
    seen = Observation("refused")
    judged = df.withColumn("reason", refusals(df)).withColumn("refused", F.col("reason").isNotNull())
    judged = judged.observe(seen, F.count_if("refused").alias("refused"))
    with open_writers(df.sparkSession):
        judged.write.options(**write_options()).partitionBy("refused").parquet(stage)
    stored = df.sparkSession.read.schema(judged.schema).parquet(stage)
    taken = stored.filter(~F.col("refused")).drop("refused", "reason")
    return taken, stored.filter("refused").drop("refused"), seen.get["refused"]


def refused_rows(df: DataFrame) -> DataFrame:
    """Rows that the typed load would refuse, to look into after it failed."""
    refused = F.lit(False)
    for c in FLAT_COLUMNS:
        if c.required:
            refused = refused | F.col(c.name).try_cast(c.type).isNull()
    return df.filter(refused)


_IDENTIFIER = re.compile(r"[A-Za-z0-9_]+")
# Fixed value: the table option by which an overwrite replaces the partitions it has rows of, and no others.
DYNAMIC = ("partitionOverwriteMode", "dynamic")
NAME_PROPERTY = "disclosure.name"


def quoted(table: str) -> str:
    """A possibly qualified table name, checked and in backticks.

    Spark's catalog allows no hyphen in a name; it becomes an underscore. :func:`create_table` keeps the name as
    given, and :func:`check_table` refuses a table that was made under another one.
    """
    parts = table.replace("-", "_").split(".")
    if not all(_IDENTIFIER.fullmatch(part) for part in parts):
        raise ValueError(f"not a table name: {table!r}")
    return ".".join(f"`{part}`" for part in parts)


def create_table(spark: SparkSession, table: str, path: str | None = None, comment: str = "") -> None:
    """Create the catalog table if it is absent, partitioned by date.

    Required columns are enforced by the load, as Parquet tables do not check.
    """
    columns = ", ".join(f"{c.name} {c.type}" for c in TABLE_COLUMNS)
    ddl = (
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}, {PARTITION_COLUMN} date) "
        f"USING parquet OPTIONS ({table_options(**dict([DYNAMIC]))}) PARTITIONED BY ({PARTITION_COLUMN})"
    )
    if path is not None:
        ddl += f" LOCATION {literal(path)}"
    if comment:
        ddl += f" COMMENT {literal(comment)}"
    spark.sql(ddl + f" TBLPROPERTIES ('{NAME_PROPERTY}' = {literal(table)})")
    check_table(spark, table)


def check_table(spark: SparkSession, table: str) -> None:
    """Refuse a table that is another one's under a similar name, or whose overwrite would empty all other dates."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()}
    made = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)} ('{NAME_PROPERTY}')").first()["value"]
    if made.replace("-", "_") == table.replace("-", "_") and made != table:
        raise ValueError(f"{table!r} would be the same table as {made!r}")
    options = described.get("Storage Properties", "").strip("[]").split(", ")
    if f"{DYNAMIC[0]}={DYNAMIC[1]}" not in options:
        raise ValueError(f"{table!r} has no option {DYNAMIC[0]} {DYNAMIC[1]!r}, so an overwrite would remove all its dates; see create_table")


def literal(text: str) -> str:
    """A text in SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def replace_table_partitions(df: DataFrame, table: str) -> None:
    """Like :func:`replace_partitions`, for a table made by :func:`create_table`, by whose own option other dates stay."""
    check_table(df.sparkSession, table)
    names = [c.name for c in TABLE_COLUMNS] + [PARTITION_COLUMN]
    with open_writers(df.sparkSession):
        df.select(*names).write.mode("overwrite").insertInto(quoted(table))


def record_dates(spark: SparkSession, path: str, rows: Mapping[str, int], run: str) -> None:
    """Note which dates a transform has read, and of how many rows, in a manifest beside the partitions of ``path``."""
    if rows:
        noted = spark.createDataFrame([(d, n, run) for d, n in sorted(rows.items())], MANIFEST_SCHEMA)
        noted.coalesce(1).write.mode("append").parquet(manifest_path(path))


MANIFEST_SCHEMA = "date string, rows bigint, run string"


def manifest_path(path: str) -> str:
    """A folder that readers of ``path`` pass over."""
    return f"{path.rstrip('/')}/_dates"


def emptied_dates(spark: SparkSession, path: str) -> set[str]:
    """Dates that were read last without a row; without a manifest none."""
    if not path_exists(spark, manifest_path(path)):
        return set()
    noted = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path(path))
    last = noted.groupBy("date").agg(F.max_by("rows", "run").alias("rows"))
    return {r["date"] for r in last.filter("rows = 0").collect()}
