"""Readers of the stored flat table and of its CSV export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PARTITION_COLUMN, TABLE_COLUMNS

# Texts that pandas' CSV reader takes for a missing value.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_index_files(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DataFrame:
    """The stored flat table; ``dates`` restricts the scan to those partitions."""
    table = spark.read.parquet(path)
    if dates is None:
        return table
    return table.filter(F.col(PARTITION_COLUMN).isin([F.to_date(F.lit(d)) for d in dates]))


# What a reader gives for quotes with nothing in between, so that it can be told from a missing value.
EMPTY = "\u0001empty\u0001"


def read_csv_export(
    spark: SparkSession, path: str, na_texts: Sequence[str] = tuple(NA_TEXTS), multi_line: bool = False, empty: str | None = None
) -> DataFrame:
    """A CSV export of the 18-column table, typed, with missing-value texts as null.

    Header names match in any case, in table order; a different header is an
    error, and so is a row with more or fewer fields. ``plan_id`` is read as text, so
    leading zeros survive. ``multi_line`` reads line breaks inside quotes; such a file cannot be split.
    ``empty``: the text that stands for quotes with nothing in between while reading; without it they are a missing value.
    """
    text_schema = ", ".join(f"{c.name} string" for c in TABLE_COLUMNS)
    reader = spark.read if empty is None else spark.read.option("emptyValue", empty)
    rows = (
        reader.schema(text_schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .csv(path)
    )

    def value(name: str) -> Column:
        given = F.col(name) if not na_texts else F.when(~F.col(name).isin(list(na_texts)), F.col(name))
        return given if empty is None else F.when(given == empty, F.lit("")).otherwise(given)

    return rows.select(*[value(c.name).cast(c.type).alias(c.name) for c in TABLE_COLUMNS])


def write_csv_export(files: DataFrame, path: str, max_rows: int = 1_000_000) -> None:
    """The table as CSV files with a header, such that :func:`read_own_export` gives the same rows.

    Texts with commas, quotes or line breaks are quoted and a quote is doubled; a null is nothing between commas and an empty text is two quotes. Files have
    ``max_rows`` rows at most, as one with line breaks inside quotes cannot be split by its readers. They are gzip files: as plain
    text the table is some 20 times larger than it is stored.
    """
    text = lambda name: F.col(name).cast("string")
    refused = F.raise_error(F.lit("a text is the sign by which readers know an empty one"))
    kinds = dict(files.dtypes)
    # Only what is a text already may be the sign; looking at a date's text as well would make it twice.
    checked = lambda name: F.when(text(name) == EMPTY, refused).otherwise(text(name)) if kinds[name] == "string" else text(name)
    columns = [checked(c.name).alias(c.name) for c in TABLE_COLUMNS]
    (
        files.select(*columns)
        .write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", max_rows)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .csv(path)
    )


def read_own_export(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_csv_export` wrote, typed: no text stands for a missing value, and line breaks may be in quotes."""
    return read_csv_export(spark, path, na_texts=(), multi_line=True, empty=EMPTY)
