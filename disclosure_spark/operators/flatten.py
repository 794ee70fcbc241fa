"""Three-level flatten of nested index documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import date_prefix
from ..schemas import FLAT_COLUMNS

# A structure is cut into blocks of this many plans by this many files at most.
BLOCK = 10
# Blocks of one structure, and structures of one document, that stay together.
BLOCKS_TOGETHER = 1000
STRUCTURES_TOGETHER = 100

_DOCUMENT_COLUMNS = [
    "source_file",
    "reporting_entity_name",
    "reporting_entity_type",
    "last_updated_on",
    "version",
]


def flatten(documents: DataFrame, processed_at: str | datetime) -> DataFrame:
    """One row per structure, plan and in-network file: the 17 flat columns.

    Structures without plans vanish, and so do documents without structures; a
    structure without in-network files keeps one row per plan with null file
    columns. The result is a bag. ``reporting_date``, ``last_updated_on`` and
    ``processed_at`` are text here; the load casts them.

    Everything is a generator over the row's own arrays: no shuffle. Each level
    carries only the fields that the next one reads, so an exploded array is
    not copied to the rows it produced.
    """
    structures = documents.select(
        *_DOCUMENT_COLUMNS, F.explode("reporting_structure").alias("structure")
    )
    return _expand(structures.select(*_DOCUMENT_COLUMNS, *_structure_fields()), processed_at)


def _structure_fields() -> list[Column]:
    return [
        F.col("structure.reporting_plans").alias("plans"),
        F.col("structure.in_network_files").alias("network_files"),
        F.col("structure.allowed_amount_file").alias("allowed_file"),
    ]


def _expand(structures: DataFrame, processed_at: str | datetime) -> DataFrame:
    """Plans times files of each structure, as flat rows."""
    if isinstance(processed_at, datetime):
        processed_at = processed_at.isoformat()
    plans = structures.select(
        *_DOCUMENT_COLUMNS, "network_files", "allowed_file", F.explode("plans").alias("plan")
    )
    combinations = plans.select(
        *_DOCUMENT_COLUMNS,
        date_prefix("source_file").alias("reporting_date"),
        F.lit(processed_at).alias("processed_at"),
        "plan",
        "allowed_file",
        F.explode_outer("network_files").alias("network_file"),
    )
    return combinations.select(*[F.col(c.path).alias(c.name) for c in FLAT_COLUMNS])


def flatten_by_date(
    documents: DataFrame, processed_at: str | datetime, partitions: int | None = None
) -> DataFrame:
    """The rows of :func:`flatten`, brought together by date for a partitioned write.

    What is shuffled are parts of structures, before plans and files multiply:
    a fraction of the flat rows. The task that writes multiplies them.

    The rebalance is AQE's: small dates share a task, and a large one is split
    over as many as its size asks for
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each). AQE goes by the
    bytes shuffled, and it cannot split what comes from one input task. Hence
    the blocks: a structure is cut into products of ``BLOCK`` plans by ``BLOCK``
    files, which together give exactly its rows, so that no shuffled plan or
    file stands for more than a few rows. And a document or structure that
    exceeds the limits above goes to several partitions, however large it is.

    ``partitions`` is the number of shuffle partitions AQE starts from.
    """
    structures = documents.select(
        *_DOCUMENT_COLUMNS, F.posexplode("reporting_structure").alias("number", "structure")
    )
    sized = structures.select(
        *_DOCUMENT_COLUMNS,
        date_prefix("source_file").alias("date"),
        F.floor(F.col("number") / STRUCTURES_TOGETHER).alias("structure_run"),
        *_structure_fields(),
        _blocks("structure.reporting_plans").alias("plan_blocks"),
        _blocks("structure.in_network_files").alias("file_blocks"),
    )
    # One generator per array, as their product may be more than an array holds.
    by_plans = sized.select("*", _numbers("plan_blocks").alias("plan_block"))
    numbered = by_plans.select("*", _numbers("file_blocks").alias("file_block"))
    number = F.col("plan_block") * F.col("file_blocks") + F.col("file_block")
    blocks = numbered.select(
        *_DOCUMENT_COLUMNS,
        "date",
        "structure_run",
        F.floor(number / BLOCKS_TOGETHER).alias("block_run"),
        "allowed_file",
        _block("plans", "plan_block"),
        _block("network_files", "file_block"),
    )
    start = [] if partitions is None else [partitions]
    clustered = blocks.hint("rebalance", *start, "date", "structure_run", "block_run")
    return _expand(clustered, processed_at)


def _blocks(array: str) -> Column:
    """Number of blocks an array is cut into; a null or empty one counts as one."""
    size = F.coalesce(F.array_size(array), F.lit(0))
    return F.greatest(F.ceil(size / BLOCK), F.lit(1)).cast("bigint")


def _numbers(count: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))


def _block(array: str, number: str) -> Column:
    start = (F.col(number) * BLOCK + 1).cast("int")
    return F.slice(array, start, F.lit(BLOCK)).alias(array)


def rows_of_document(structures: str | Column = "reporting_structure") -> Column:
    """How many flat rows a document yields, from its array sizes alone."""

    def rows(structure: Column) -> Column:
        plans = F.coalesce(F.array_size(structure["reporting_plans"]), F.lit(0))
        files = F.coalesce(F.array_size(structure["in_network_files"]), F.lit(0))
        return plans.cast("bigint") * F.greatest(files, F.lit(1))

    total = F.aggregate(structures, F.lit(0).cast("bigint"), lambda acc, s: acc + rows(s))
    return F.coalesce(total, F.lit(0).cast("bigint"))


def flatten_counts(documents: DataFrame) -> DataFrame:
    """Row counts before and after the flatten, in one pass and without exploding."""
    rows = documents.select(rows_of_document().alias("rows"))
    return rows.agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("rows") == 0).alias("documents_without_rows"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("flat_rows"),
    )
