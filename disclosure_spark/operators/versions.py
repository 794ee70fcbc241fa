"""A catalog table of runs, and a view that says which run of each date is live.

A load adds its rows as partitions of a run of its own, beside all that is there. Only when the rows of all
its dates are written and counted is the view replaced, and that is a single catalog operation: readers
see all dates of the load or none, and a load that fails or is killed at any point has changed nothing that
they see. Rows of runs that are not live are removed by :func:`vacuum`.

The view selects by literal dates and runs, which are partition columns, so a query on it prunes both. One load at a time:
of two that run at once the later one's view would not know the earlier one's dates.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PARTITION_COLUMN, TABLE_COLUMNS
from ..workspace import folder_bytes
from .quality import CountMismatchError, EmptyResultError
from .store import date_groups, file_rows, literal, open_writers, packing_session, quoted, table_options

RUNS = "_runs"
PART = 3000  # signs of a table property, as catalogs bound their length

NAMES = [c.name for c in TABLE_COLUMNS] + [PARTITION_COLUMN]


def runs_table(table: str) -> str:
    return f"{table}{RUNS}"


def create_versioned(spark: SparkSession, table: str, path: str | None = None) -> None:
    """The table of runs and the view on it, if they are absent."""
    columns = ", ".join(f"{c.name} {c.type}" for c in TABLE_COLUMNS)
    place = f" LOCATION {literal(path)}" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(runs_table(table))} ({columns}, {PARTITION_COLUMN} date, run string) "
        f"USING parquet OPTIONS ({table_options()}) PARTITIONED BY ({PARTITION_COLUMN}, run){place}"
    )
    if not spark.catalog.tableExists(quoted(table)):
        _show(spark, table, {})


def live(spark: SparkSession, table: str) -> dict[str, str]:
    """The run of each date."""
    listed = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect()}
    parts = sorted((int(k.rpartition(".")[2]), v) for k, v in listed.items() if k.startswith("live."))
    return json.loads("".join(v for _, v in parts) or "{}")


def _show(spark: SparkSession, table: str, runs: dict[str, str]) -> None:
    """Replace the view: one operation of the catalog."""
    text = json.dumps(runs, sort_keys=True)
    parts = [text[i : i + PART] for i in range(0, len(text), PART)]
    properties = ", ".join(f"'live.{i}' = {literal(p)}" for i, p in enumerate(parts))
    dates: dict[str, list[str]] = {}
    for date, run in sorted(runs.items()):
        dates.setdefault(run, []).append(f"DATE {literal(date)}")
    chosen = " OR ".join(f"(run = {literal(r)} AND {PARTITION_COLUMN} IN ({', '.join(d)}))" for r, d in dates.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(table)} TBLPROPERTIES ({properties}) AS "
        f"SELECT {', '.join(NAMES)} FROM {quoted(runs_table(table))} WHERE {chosen or 'false'}"
    )


def write_run(rows: DataFrame, table: str, max_rows: int | None = None) -> str:
    """Add the rows as a run that no reader sees yet, in files of ``max_rows`` at most; its name."""
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    with open_writers(rows.sparkSession), file_rows(rows.sparkSession, max_rows):
        rows.select(*NAMES, F.lit(run).alias("run")).write.mode("append").insertInto(quoted(runs_table(table)))
    return run


def run_counts(spark: SparkSession, table: str, run: str) -> dict[str, int]:
    """Rows of each date of a run, from the files' footers."""
    stored = spark.table(quoted(runs_table(table)))
    counted = stored.filter(F.col("run") == run).groupBy(PARTITION_COLUMN).agg(F.count("*").alias("rows"))
    return {str(r[PARTITION_COLUMN]): r["rows"] for r in counted.collect()}


def publish(
    rows: DataFrame, table: str, *, dates: Sequence[str] | None = None, expected: dict[str, int] | None = None, max_rows: int | None = None
) -> dict[str, int]:
    """Replace the dates of ``rows`` at once, and those in ``dates`` of which it has none; the rows of each.

    ``expected``: rows of each date that must be there before anything is shown. ``max_rows`` of a file.
    """
    spark = rows.sparkSession
    run = write_run(rows, table, max_rows)
    counts = run_counts(spark, table, run)
    if not counts and not dates:
        raise EmptyResultError("no rows to publish")
    if expected is not None:
        wrong = sorted(d for d in set(counts) | set(expected) if counts.get(d, 0) != expected.get(d, 0))
        if wrong:
            first = wrong[0]
            raise CountMismatchError(f"{len(wrong)} date(s) differ; first {first}: expected {expected.get(first, 0)}, loaded {counts.get(first, 0)}")
    runs = live(spark, table)
    for date in dates or ():
        runs.pop(str(date), None)
    _show(spark, table, runs | dict.fromkeys(counts, run))
    return counts


def vacuum(spark: SparkSession, table: str) -> int:
    """Remove the partitions of runs that are not live; how many."""
    runs = live(spark, table)
    listed = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {quoted(runs_table(table))}").collect()]
    named = [dict(x.split("=", 1) for x in p.split("/")) for p in listed]
    dead = [n for n in named if runs.get(n[PARTITION_COLUMN]) != n["run"]]
    for n in dead:
        spark.sql(
            f"ALTER TABLE {quoted(runs_table(table))} DROP IF EXISTS PARTITION "
            f"({PARTITION_COLUMN} = DATE {literal(n[PARTITION_COLUMN])}, run = {literal(n['run'])})"
        )
    return len(dead)


def compact(spark: SparkSession, table: str, dates: Sequence[str], target_bytes: int = 128 << 20) -> dict[str, int]:
    """Pack the small files of these dates into files of about ``target_bytes``; the rows of each date.

    The packed rows are a run of their own, which is shown once it has as many rows of each date as before. Nothing is shuffled:
    Spark's scan packs files up to the size into a task, and a task writes one file a date. A scan does not look at the
    files' dates, so there is one for each group of neighbouring dates (``operators.store.date_groups``).
    """
    before = {d: n for d, n in live_counts(spark, table).items() if d in set(map(str, dates))}
    if not before:
        return {}
    rows = packing_session(spark, target_bytes).table(quoted(table))
    groups = date_groups(before, -(-folder_bytes(spark, _location(spark, table)) // target_bytes))
    parts = [rows.filter(F.col(PARTITION_COLUMN).isin([F.to_date(F.lit(d)) for d in group])) for group in groups]
    return publish(reduce(DataFrame.unionByName, parts), table, expected=before)


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(runs_table(table))}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def live_counts(spark: SparkSession, table: str) -> dict[str, int]:
    """Rows of each date that readers see."""
    counted = spark.table(quoted(table)).groupBy(PARTITION_COLUMN).agg(F.count("*").alias("rows"))
    return {str(r[PARTITION_COLUMN]): r["rows"] for r in counted.collect()}


def live_files(spark: SparkSession, table: str) -> DataFrame:
    """Files and rows of each live date; no column of the table is read."""
    runs = live(spark, table)
    shown = [F.struct(F.to_date(F.lit(d)), F.lit(r)) for d, r in runs.items()]
    stored = spark.table(quoted(runs_table(table))).select(PARTITION_COLUMN, "run", F.col("_metadata.file_path").alias("file"))
    kept = stored.filter(F.struct(PARTITION_COLUMN, "run").isin(shown) if shown else F.lit(False))
    per_file = kept.groupBy(PARTITION_COLUMN, "file").agg(F.count("*").alias("rows"))
    return per_file.groupBy(PARTITION_COLUMN).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))
