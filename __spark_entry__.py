"""Registered queries and the SQL that states the same results.

All queries run over the whole of ``lineitem`` (as nested documents, also in JSON files, and the flat
table made from them, see FIXTURES.md) or of ``documents`` and ``labels`` (as a
blob listing, also in JSON files, and what of it has landed).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure_spark import fixtures
from disclosure_spark.operators import blobs, ledger, partials, quality, store, versions
from disclosure_spark.operators.flatten import flatten, flatten_counts
from disclosure_spark.plans import explore, jobs, profile
from disclosure_spark.schemas import FLAT_NAMES, PARTITION_COLUMN, REQUIRED_NAMES
from disclosure_spark.sources.listing import read_listing
from disclosure_spark.sources.tables import read_index_files, read_own_export, write_csv_export
from disclosure_spark.workspace import run_path

try:
    from disclosure_spark.llm import queries as llm
except ImportError:  # the package and its pipeline may be left out, but if they are there an error is one
    if (HERE / "disclosure_spark/llm/queries.py").exists() and (HERE / "corpus_pipeline.py").exists():
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
ENTITY = "Carrier-A"
BLOBS = {"file_type": "in_network_rates", "max_size": 5000, "max_files": 200}
REPLACED_YEAR = "1998"
ONE_DATE = "1996-03-01"
SMALL_FILES = 8  # of a date, before they are packed


def entry(spark: SparkSession) -> DataFrame:
    """The most frequent plan names of the smallest data set."""
    return explore.top_plans(fixtures.index_files(spark, "/root/testdata/sf0.001"))


def _on_table(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(fixtures.index_files(spark, sf_dir))


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text and no run timestamps, so that engines agree on every value."""
    texts = [F.col(n).cast("string").alias(n) if t == "date" else F.col(n) for n, t in df.dtypes]
    kept = df.select(*texts)
    return kept.drop(*[n for n, t in df.dtypes if t.startswith("timestamp")])


def _flatten_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(fixtures.index_docs(spark, sf_dir), fixtures.PROCESSED_AT)


def _flatten_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_counts(fixtures.index_docs(spark, sf_dir))


def _load_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(store.to_table_rows(fixtures.processed_files(spark, sf_dir)))


def _partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(quality.stored_counts(spark, fixtures.stored(spark, sf_dir).table))


def _partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load everything, reload one year without the rows that have no network file."""
    target = run_path(spark, "partition_replace")
    rows = store.to_table_rows(fixtures.processed_files(spark, sf_dir))
    store.replace_partitions(rows, target)
    store.replace_partitions(_reload(rows), target)
    return _plain(quality.partition_counts(spark.read.parquet(target)))


def _load_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = fixtures.processed_files(spark, sf_dir)
    return _plain(quality.compare_counts(processed, fixtures.index_files(spark, sf_dir)))


def _of_year() -> Column:
    return F.year(PARTITION_COLUMN) == int(REPLACED_YEAR)


def _reload(rows: DataFrame) -> DataFrame:
    """One year without the rows that have no network file."""
    return rows.filter(_of_year() & F.col("in_network_location").isNotNull())


def _fresh_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


def _flatten_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From JSON files: parsed once, staged by date, flattened."""
    stage = run_path(spark, "flatten_files")
    documents = jobs.dated_documents(spark, f"{fixtures.landed_json(spark, sf_dir)}/mrf/index", "*.json.gz")
    documents = documents.withColumn("source_file", F.regexp_replace("source_file", "[.]gz$", ""))  # the document's name
    jobs.stage_documents(documents.withColumn(jobs.STAGE_DATE, F.substring("source_file", 1, 10)), stage, by_date=True)
    dates, _ = jobs.document_dates(jobs.staged_documents(spark, stage))
    rows = jobs.flat_by_date(spark, stage, fixtures.PROCESSED_AT, {d: most for d, (_, most) in dates.items()})
    return rows.select(FLAT_NAMES)


def _listing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blob listing read from its JSON pages."""
    page = F.regexp_extract("page", r"page_(\d+)[.]json$", 1).cast("long")
    return read_listing(spark, fixtures.landed_listing(spark, sf_dir)).withColumn("page", page)


def _one_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(read_index_files(spark, fixtures.stored(spark, sf_dir).table, [ONE_DATE]))


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the typed load refuses, with why."""
    _, refused, _ = store.split_refused(fixtures.damaged_files(spark, sf_dir), run_path(spark, "quarantine"))
    return refused.select(*[c for c in FLAT_NAMES if c != "processed_at"], "reason")


def _load_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a table that has lost rows of some dates."""
    kept = fixtures.index_files(spark, sf_dir).filter(~(_of_year() & F.col("in_network_location").isNull()))
    return _plain(quality.compare_counts(fixtures.processed_files(spark, sf_dir), kept))


def _catalog_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As partition_replace, in a catalog table."""
    table = _fresh_name("catalog_replace")
    store.create_table(spark, table, run_path(spark, "catalog_replace"))
    rows = store.to_table_rows(fixtures.processed_files(spark, sf_dir))
    store.replace_table_partitions(rows, table)
    store.replace_table_partitions(_reload(rows), table)
    counted = spark.table(table).groupBy(PARTITION_COLUMN).agg(F.count("*").alias("rows"), F.count_distinct("source_file").alias("source_files"))
    return _plain(counted)


def _publish_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates published at once, a year again, and a load that is refused and changes nothing."""
    table = _fresh_name("publish_dates")
    versions.create_versioned(spark, table, run_path(spark, "publish_dates"))
    rows = store.to_table_rows(fixtures.processed_files(spark, sf_dir))
    versions.publish(rows, table)
    versions.publish(_reload(rows), table)
    try:
        versions.publish(rows.filter(_of_year()), table, expected={ONE_DATE: 1})
    except quality.CountMismatchError:
        pass
    counted = spark.table(table).groupBy(PARTITION_COLUMN).agg(F.count("*").alias("rows"), F.count_distinct("source_file").alias("source_files"))
    return _plain(counted)


def _compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in many small files, packed."""
    table = _fresh_name("compaction")
    versions.create_versioned(spark, table, run_path(spark, "compaction"))
    rows = fixtures.index_files(spark, sf_dir)
    stored, dates = quality.stored_counts(spark, fixtures.stored(spark, sf_dir).table).agg(F.sum("rows"), F.count("*")).first()
    # Files of an eighth of a date's rows on average: the rows need no shuffle to be in small files.
    counts = versions.publish(rows, table, max_rows=-(-stored // (SMALL_FILES * dates)))
    versions.compact(spark, table, list(counts))
    return _plain(versions.live_files(spark, table))


def _csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with awkward texts, written as CSV and read again."""
    path = run_path(spark, "csv_export")
    ends = lambda x: F.col("plan_id").endswith(x)
    awkward = F.when(ends("1"), F.lit("")).when(ends("2"), F.lit("NA")).when(ends("3"), F.lit(' a "b",\n c ')).otherwise(F.col("plan_sponsor_name"))
    write_csv_export(fixtures.index_files(spark, sf_dir).withColumn("plan_sponsor_name", awkward), path)
    return _plain(read_own_export(spark, path))


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials of all dates, after one year was replaced and only it read again."""
    table, path = run_path(spark, "partials_table"), run_path(spark, "partials")
    rows = fixtures.index_files(spark, sf_dir)
    store.replace_partitions(rows, table)
    partials.refresh(spark, spark.read.parquet(table), path)
    store.replace_partitions(_reload(rows), table)
    dates = [str(r[0]) for r in rows.filter(_of_year()).select(PARTITION_COLUMN).distinct().collect()]
    partials.refresh(spark, spark.read.parquet(table), path, dates)
    return spark.read.parquet(path)


def _landed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing against what an earlier run, which listed the other way round, has noted."""
    marked = ledger.mark(fixtures.whole_plan(spark, sf_dir), fixtures.landed_ledger(spark, sf_dir))
    return marked.select("pos", "name", "path", "status", "collision")


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blobs.plan_downloads(fixtures.blob_listing(spark, sf_dir), source="mrf", **BLOBS)


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = blobs.landing_path("mrf", BLOBS["file_type"]).alias("path")
    return fixtures.landed_blobs(spark, sf_dir).select(path, "size")


def _whole_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blobs of all types and sizes."""
    listing = fixtures.blob_listing(spark, sf_dir)
    return blobs.plan_downloads(listing, source="mrf", file_type=BLOBS["file_type"], max_files=None, suffix="")


def _blob_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blobs.funnel(fixtures.blob_listing(spark, sf_dir), **BLOBS)


def _blob_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blobs.pending(_whole_plan(spark, sf_dir), _landed(spark, sf_dir))


def _blob_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = blobs.mark_landed(_whole_plan(spark, sf_dir), _landed(spark, sf_dir))
    marked = marked.unionByName(marked.filter("collision").withColumn("status", F.lit("collision")))
    return blobs.status_counts(marked, ("pending", "skipped", "collision"))


def library_queries() -> dict[str, Query]:
    """The queries of the library itself."""
    return {
        "flatten_index": _flatten_index,
        "flatten_counts": _flatten_counts,
        "overview": _on_table(explore.overview),
        "allowed_share": _on_table(explore.allowed_share),
        "sponsor_nulls": _on_table(explore.sponsor_nulls),
        "null_sponsor_files": _on_table(explore.null_sponsor_files),
        "top_plans": _on_table(explore.top_plans),
        "entity_profile": _on_table(explore.entity_profile),
        "entity_like": _on_table(lambda files: explore.entity_like(files, ENTITY)),
        "shared_plan_ids": _on_table(explore.shared_plan_ids),
        "sponsor_issuer_diff": _on_table(explore.sponsor_issuer_diff),
        "preview": _on_table(lambda files: _plain(explore.preview(files))),
        "null_profile": _on_table(lambda files: quality.null_profile(files, FLAT_NAMES)),
        "null_profile_pct": _on_table(lambda files: quality.null_profile_percent(files, FLAT_NAMES)),
        "not_null_check": _on_table(quality.not_null_check),
        "entity_profile_nb": _on_table(profile.entity_profile),
        "top_plans_nb": _on_table(profile.top_plans),
        "network_desc_counts": _on_table(profile.network_descriptions),
        "null_sponsor_entities": _on_table(profile.null_sponsor_entities),
        "allowed_presence": _on_table(profile.allowed_presence),
        "rows_per_file": _on_table(profile.rows_per_file),
        "rows_per_file_stats": _on_table(profile.rows_per_file_stats),
        "rows_per_file_hist": _on_table(profile.rows_per_file_histogram),
        "load_typed": _load_typed,
        "partition_counts": _partition_counts,
        "flatten_files": _flatten_files,
        "listing_file": _listing_file,
        "one_date": _one_date,
        "quarantine": _quarantine,
        "not_null_damaged": lambda spark, sf_dir: quality.not_null_check(fixtures.damaged_files(spark, sf_dir)),
        "load_mismatch": _load_mismatch,
        "catalog_replace": _catalog_replace,
        "publish_dates": _publish_dates,
        "compaction": _compaction,
        "csv_export": _csv_export,
        "overview_partials": lambda spark, sf_dir: partials.overview(_partials(spark, sf_dir)),
        "entity_partials": lambda spark, sf_dir: partials.entity_profile(_partials(spark, sf_dir)),
        "landed_ledger": _landed_ledger,
        "partition_replace": _partition_replace,
        "load_verify": _load_verify,
        "blob_plan": _plan,
        "blob_funnel": _blob_funnel,
        "blob_pending": _blob_pending,
        "blob_status": _blob_status,
    }


def queries() -> dict[str, Query]:
    """One entry per named query."""
    return library_queries() | (llm.queries() if llm else {})


_FILES = """
WITH line AS (
    SELECT l_orderkey AS o, l_partkey AS part, l_suppkey AS supplier, l_linenumber AS number,
           l_returnflag AS flag, l_linestatus AS status,
           strftime(l_shipdate, '%Y-%m-%d') AS day,
           strftime(l_shipdate, '%Y-%m-01') AS month,
           CAST(floor(l_quantity) AS INTEGER) AS quantity,
           CAST(round(l_tax * 100) AS INTEGER) AS tax,
           CAST(round(l_discount * 100) AS INTEGER) AS discount
    FROM lineitem
), combination AS (
    SELECT line.*, s, p, f,
           CASE WHEN tax <> 8
                THEN 'Sponsor-' || o || CASE WHEN number = 7 THEN ' LLC' ELSE '' END END AS sponsor
    FROM line
    JOIN (VALUES (1), (2)) AS structures(s)
      ON discount NOT IN (0, 10) AND s <= 1 + number % 2
    JOIN (VALUES (1), (2), (3)) AS plans(p) ON p <= (quantity + s) % 4
    LEFT JOIN (VALUES (1), (2), (3)) AS files(f) ON f <= (part + s) % 4
), index_files AS (
    SELECT month || '_issuer_' || supplier || '_index.json' AS source_file,
           month AS reporting_date,
           '2026-06-01T00:00:00' AS processed_at,
           'Carrier-' || flag || CASE WHEN status = 'O' THEN '-Inc' ELSE '' END
               AS reporting_entity_name,
           CASE WHEN status = 'O' THEN 'Third-Party Admin' ELSE 'Health Insurance Issuer' END
               AS reporting_entity_type,
           day AS last_updated_on,
           '1.' || discount || '.0' AS version,
           'Plan-' || tax || '-' || p AS plan_name,
           repeat('0', greatest(9 - length(CAST(o + p - 1 AS VARCHAR)), 0)) || (o + p - 1) AS plan_id,
           'EIN' AS plan_id_type,
           CASE WHEN quantity % 2 = 0 THEN 'group' ELSE 'individual' END AS plan_market_type,
           sponsor AS plan_sponsor_name,
           CASE WHEN tax = 0 OR sponsor IS NULL THEN 'Issuer-' || supplier ELSE sponsor END
               AS issuer_name,
           CASE WHEN f IS NOT NULL AND part % 12 <> 0 THEN 'network-' || (part % 12) END
               AS in_network_description,
           CASE WHEN f IS NOT NULL
                THEN 'https://files.example/' || supplier || '/' || part || '/' || f END
               AS in_network_location,
           CASE WHEN s = 1 AND flag = 'R' AND number <= 2 THEN 'allowed' END
               AS allowed_amount_description,
           CASE WHEN s = 1 AND flag = 'R' AND number <= 2
                THEN 'https://files.example/allowed/' || supplier || '/' || month END
               AS allowed_amount_location
    FROM combination
)
"""

_BLOBS = """
WITH listing AS (
    SELECT doc_id AS pos,
           '2024-0' || (doc_id % 3 + 1) || '-01_' || source || ' ' || lang || ' '
               || repeat('x', CAST(doc_id % 140 AS INTEGER)) || ' ' || doc_id
               || CASE doc_id % 3 WHEN 0 THEN '_index.json'
                                  WHEN 1 THEN '_in-network-rates.json.gz'
                                  ELSE '_allowed-amounts.json.gz' END AS name,
           n_chars AS size,
           'https://files.example/' || doc_id AS "downloadUrl"
    FROM documents
), renamed AS (
    SELECT *, replace(name, ' ', '_') AS plain,
           regexp_extract(name, '^[.]*[^.]*([.].*)$', 1) AS suffix
    FROM listing
), pathed AS (
    SELECT pos, name, size, "downloadUrl",
           'mrf/in_network_rates/' || substr(name, 1, 10) || '/'
               || CASE WHEN length(plain) > 130
                       THEN substr(plain, 1, 130 - length(suffix)) || suffix
                       ELSE plain END AS path
    FROM renamed
), plan AS (
    SELECT * FROM pathed
    WHERE name LIKE '%\\_in-network-rates.json.gz' ESCAPE '\\' AND size <= 5000
    ORDER BY pos LIMIT 200
), turned AS (
    SELECT *, name || chr(10) || "downloadUrl" <> first_value(name || chr(10) || "downloadUrl") OVER (PARTITION BY path ORDER BY pos)
               AS collision,
           pos > min(pos) OVER (PARTITION BY path, name, "downloadUrl") AS repeated
    FROM pathed
), own AS (
    SELECT pos, name, size, "downloadUrl", collision, repeated,
           CASE WHEN collision
                THEN 'mrf/in_network_rates/' || substr(name, 1, 10) || '/'
                     || substr(plain, 1, least(length(plain) - length(suffix), 113 - length(suffix))) || '-'
                     || substr(md5(name || chr(10) || "downloadUrl"), 1, 16) || suffix
                ELSE path END AS path
    FROM turned JOIN (SELECT DISTINCT pos, plain, suffix FROM renamed) USING (pos)
), marked AS (
    SELECT *, CASE WHEN path IN (SELECT path FROM pathed WHERE pos IN (SELECT doc_id FROM labels)) OR repeated
                   THEN 'skipped' ELSE 'pending' END AS status
    FROM own
)
"""


def _percent(part: str, whole: str) -> str:
    return f"CAST((2000 * ({part}) + ({whole})) // (2 * ({whole})) AS DOUBLE) / 10.0"


def _nulls(column: str) -> str:
    return f"count(*) FILTER (WHERE {column} IS NULL)"


_KEPT = f"(substr(reporting_date, 1, 4) <> '{REPLACED_YEAR}' OR in_network_location IS NOT NULL)"

_REPLACED = f"""
SELECT reporting_date AS {PARTITION_COLUMN}, count(*) AS rows, count(DISTINCT source_file) AS source_files
FROM index_files WHERE {_KEPT} GROUP BY reporting_date
"""

# The table's columns but for its timestamps, dates as text.
_TABLE_TEXTS = ", ".join(n for n in FLAT_NAMES if n != "processed_at")

_AWKWARD = """CASE WHEN plan_id LIKE '%1' THEN '' WHEN plan_id LIKE '%2' THEN 'NA'
    WHEN plan_id LIKE '%3' THEN ' a "b",' || chr(10) || ' c ' ELSE plan_sponsor_name END AS plan_sponsor_name"""

_DAMAGED = """
, damaged AS (
    SELECT * REPLACE (
        CASE WHEN plan_id LIKE '%7' THEN 'June' ELSE last_updated_on END AS last_updated_on,
        CASE WHEN NOT (in_network_description IS NULL AND plan_name LIKE '%-2') THEN version END AS version)
    FROM index_files
)
"""

_PER_FILE = "(SELECT source_file, count(*) AS n FROM index_files GROUP BY source_file)"

# Bins are decided by the edges, as computed in double precision.
_HISTOGRAM = f"""
, per_file AS {_PER_FILE}
, bounds AS (
    SELECT CAST(min(n) AS DOUBLE) - CASE WHEN min(n) = max(n) THEN 0.5 ELSE 0 END AS lo,
           CAST(max(n) AS DOUBLE) + CASE WHEN min(n) = max(n) THEN 0.5 ELSE 0 END AS hi
    FROM per_file
), edges AS (
    SELECT bin, bin * ((hi - lo) / 30.0) + lo AS bin_start,
           CASE WHEN bin = 29 THEN hi ELSE (bin + 1) * ((hi - lo) / 30.0) + lo END AS bin_end
    FROM range(30) AS bins(bin), bounds
)
SELECT bin, bin_start, bin_end, count(n) AS source_files
FROM edges LEFT JOIN per_file
  ON n >= bin_start AND (n < bin_end OR (bin = 29 AND n = bin_end))
GROUP BY bin, bin_start, bin_end
"""


def oracle_sql() -> dict[str, str]:
    """The same results in SQL over the given tables."""
    on_files = {
        "flatten_index": "SELECT * FROM index_files",
        "flatten_counts": """
            , per_line AS (
                SELECT coalesce(sum(((quantity + s) % 4) * greatest((part + s) % 4, 1)), 0) AS n
                FROM (SELECT row_number() OVER () AS id, * FROM line)
                LEFT JOIN (VALUES (1), (2)) AS structures(s)
                  ON discount NOT IN (0, 10) AND s <= 1 + number % 2
                GROUP BY id)
            SELECT count(*) AS documents, count(*) FILTER (WHERE n = 0) AS documents_without_rows,
                   (SELECT count(*) FROM index_files) AS flat_rows
            FROM per_line""",
        "overview": """
            SELECT count(*) AS total_rows, count(DISTINCT source_file) AS source_files
            FROM index_files""",
        "allowed_share": f"""
            SELECT count(DISTINCT source_file) AS files_with_allowed_amount,
                   {_percent("count(DISTINCT source_file)",
                             "SELECT count(DISTINCT source_file) FROM index_files")} AS pct
            FROM index_files WHERE allowed_amount_location IS NOT NULL""",
        "sponsor_nulls": """
            SELECT count(*) AS null_sponsor_rows, count(DISTINCT source_file) AS affected_files
            FROM index_files WHERE plan_sponsor_name IS NULL""",
        "null_sponsor_files": """
            SELECT DISTINCT source_file FROM index_files WHERE plan_sponsor_name IS NULL""",
        "top_plans": """
            SELECT plan_name, count(*) AS total FROM index_files
            GROUP BY plan_name ORDER BY total DESC, plan_name LIMIT 10""",
        "entity_profile": f"""
            SELECT reporting_entity_name, count(DISTINCT plan_id) AS unique_plan_id,
                   count(DISTINCT plan_name) AS unique_plans, count(*) AS total_rows,
                   {_percent("count(*)", "SELECT count(*) FROM index_files")} AS pct_of_total
            FROM index_files GROUP BY reporting_entity_name""",
        "entity_like": f"""
            SELECT reporting_entity_name, count(*) AS total FROM index_files
            WHERE reporting_entity_name LIKE '%{ENTITY}%' GROUP BY reporting_entity_name""",
        "shared_plan_ids": """
            SELECT plan_id, count(DISTINCT source_file) AS files,
                   count(DISTINCT plan_sponsor_name) AS sponsor_names
            FROM index_files GROUP BY plan_id HAVING count(DISTINCT source_file) > 1
            ORDER BY files DESC, plan_id LIMIT 10""",
        "sponsor_issuer_diff": """
            SELECT plan_sponsor_name, issuer_name, source_file FROM index_files
            WHERE plan_sponsor_name <> issuer_name
            ORDER BY plan_sponsor_name, issuer_name, source_file LIMIT 10""",
        "preview": f"""
            SELECT {", ".join(n for n in FLAT_NAMES if n != "processed_at")},
                   reporting_date AS {PARTITION_COLUMN}
            FROM index_files
            ORDER BY source_file, plan_id, in_network_location NULLS FIRST,
                     {", ".join(f"{n} NULLS FIRST" for n in FLAT_NAMES)} LIMIT 5""",
        "null_profile": f"""
            SELECT {", ".join(f"{_nulls(n)} AS {n}" for n in FLAT_NAMES)} FROM index_files""",
        "null_profile_pct": "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS column_name, {_nulls(n)} AS null_count, "
            f"{_percent(_nulls(n), 'count(*)')} AS pct FROM index_files"
            for n in FLAT_NAMES
        )
        + ") WHERE null_count > 0",
        "not_null_check": " UNION ALL ".join(
            f"SELECT '{n}' AS column_name, {_nulls(n)} AS null_count, "
            f"{_nulls(n)} = 0 AS passed FROM index_files"
            for n in REQUIRED_NAMES
        ),
        "entity_profile_nb": """
            SELECT reporting_entity_name, count(source_file) AS rows,
                   count(DISTINCT plan_id) AS unique_plans,
                   count(DISTINCT source_file) AS source_files
            FROM index_files WHERE reporting_entity_name IS NOT NULL
            GROUP BY reporting_entity_name""",
        "top_plans_nb": """
            SELECT plan_name, count(*) AS total FROM index_files WHERE plan_name IS NOT NULL
            GROUP BY plan_name ORDER BY total DESC, plan_name LIMIT 10""",
        "network_desc_counts": """
            SELECT in_network_description, count(*) AS total FROM index_files
            GROUP BY in_network_description""",
        "null_sponsor_entities": """
            SELECT reporting_entity_name, count(*) AS total FROM index_files
            WHERE plan_sponsor_name IS NULL AND reporting_entity_name IS NOT NULL
            GROUP BY reporting_entity_name""",
        "allowed_presence": f"""
            , per_file AS (
                SELECT source_file, bool_or(coalesce(allowed_amount_location, '') <> '') AS has
                FROM index_files GROUP BY source_file)
            SELECT 'with_allowed' AS presence, count(*) FILTER (WHERE has) AS source_files,
                   {_percent("count(*) FILTER (WHERE has)", "count(*)")} AS pct FROM per_file
            UNION ALL
            SELECT 'without_allowed', count(*) FILTER (WHERE NOT has),
                   {_percent("count(*) FILTER (WHERE NOT has)", "count(*)")} FROM per_file""",
        "rows_per_file": """
            SELECT source_file, count(*) AS rows FROM index_files GROUP BY source_file""",
        "rows_per_file_stats": f"""
            SELECT CAST(sum(n) AS DOUBLE) / count(*) AS mean_rows, min(n) AS min_rows,
                   max(n) AS max_rows, CAST(median(n) AS DOUBLE) AS median_rows
            FROM {_PER_FILE}""",
        "rows_per_file_hist": _HISTOGRAM,
        "load_typed": f"""
            SELECT {", ".join(
                f"CAST(CAST({n} AS DATE) AS VARCHAR) AS {n}"
                if n in ("reporting_date", "last_updated_on") else n
                for n in FLAT_NAMES if n != "processed_at")},
                   CAST(CAST(reporting_date AS DATE) AS VARCHAR) AS {PARTITION_COLUMN}
            FROM index_files""",
        "partition_counts": f"""
            SELECT reporting_date AS {PARTITION_COLUMN}, count(*) AS rows
            FROM index_files GROUP BY reporting_date""",
        "partition_replace": f"""
            SELECT reporting_date AS {PARTITION_COLUMN}, count(*) AS rows FROM index_files
            WHERE substr(reporting_date, 1, 4) <> '{REPLACED_YEAR}'
               OR in_network_location IS NOT NULL
            GROUP BY reporting_date""",
        "flatten_files": f"""
            SELECT substr(source_file, 1, 10) || '_issuers_'
                     || (CAST(regexp_extract(source_file, '_issuer_([0-9]+)_', 1) AS BIGINT) // {fixtures.ISSUERS_PER_FILE}) || '_index.json' AS source_file,
                   {", ".join(n for n in FLAT_NAMES if n != "source_file")}
            FROM index_files""",
        "one_date": f"""
            SELECT {_TABLE_TEXTS}, reporting_date AS {PARTITION_COLUMN}
            FROM index_files WHERE reporting_date = '{ONE_DATE}'""",
        "quarantine": f"""
            {_DAMAGED}
            SELECT {", ".join(n for n in FLAT_NAMES if n != "processed_at")},
                   concat_ws('; ', CASE WHEN last_updated_on = 'June' THEN 'last_updated_on must be a date, not June' END,
                                   CASE WHEN version IS NULL THEN 'version must be a string, not null' END) AS reason
            FROM damaged WHERE last_updated_on = 'June' OR version IS NULL""",
        "not_null_damaged": _DAMAGED + " UNION ALL ".join(
            f"SELECT '{n}' AS column_name, {_nulls(n)} AS null_count, {_nulls(n)} = 0 AS passed FROM damaged"
            for n in REQUIRED_NAMES
        ),
        "load_mismatch": f"""
            SELECT reporting_date AS {PARTITION_COLUMN}, count(*) AS rows_expected,
                   count(*) FILTER (WHERE {_KEPT}) AS rows_loaded, count(*) = count(*) FILTER (WHERE {_KEPT}) AS matches
            FROM index_files GROUP BY reporting_date""",
        "catalog_replace": _REPLACED,
        "publish_dates": _REPLACED,
        "compaction": f"""
            SELECT reporting_date AS {PARTITION_COLUMN}, CAST(1 AS BIGINT) AS files, count(*) AS rows
            FROM index_files GROUP BY reporting_date""",
        "csv_export": f"""
            SELECT {_TABLE_TEXTS.replace("plan_sponsor_name", _AWKWARD)} FROM index_files""",
        "overview_partials": f"""
            SELECT count(*) AS total_rows, count(DISTINCT source_file) AS source_files
            FROM index_files WHERE {_KEPT}""",
        "entity_partials": f"""
            SELECT reporting_entity_name, count(DISTINCT plan_id) AS unique_plan_id,
                   count(DISTINCT plan_name) AS unique_plans, count(*) AS total_rows,
                   {_percent("count(*)", f"SELECT count(*) FROM index_files WHERE {_KEPT}")} AS pct_of_total
            FROM index_files WHERE {_KEPT} GROUP BY reporting_entity_name""",
        "load_verify": f"""
            SELECT reporting_date AS {PARTITION_COLUMN}, count(*) AS rows_expected,
                   count(*) AS rows_loaded, true AS matches
            FROM index_files GROUP BY reporting_date""",
    }
    on_blobs = {
        "blob_plan": "SELECT * FROM plan",
        "blob_funnel": """
            SELECT count(*) AS total, count(*) FILTER (WHERE of_type) AS after_suffix,
                   count(*) FILTER (WHERE of_type AND size <= 5000) AS after_size,
                   least(count(*) FILTER (WHERE of_type AND size <= 5000), 200) AS after_limit
            FROM (SELECT size, suffix(name, '_in-network-rates.json.gz') AS of_type FROM listing)""",
        "listing_file": f"""
            SELECT pos // {fixtures.LISTING_PAGE} AS page,
                   row_number() OVER (PARTITION BY pos // {fixtures.LISTING_PAGE} ORDER BY pos) - 1 AS pos, name, size, "downloadUrl"
            FROM listing""",
        "landed_ledger": """
            , earlier AS (
                SELECT pos, path, CASE WHEN pos = max(pos) OVER (PARTITION BY path) THEN path END AS usual
                FROM pathed WHERE pos IN (SELECT doc_id FROM labels)
            ), known AS (
                SELECT DISTINCT pos, usual FROM earlier
            ), newest AS (
                SELECT pos, path, min(pos) OVER (PARTITION BY path) AS first_pos FROM pathed
                WHERE pos NOT IN (SELECT pos FROM known) AND path NOT IN (SELECT usual FROM known WHERE usual IS NOT NULL)
            ), assigned AS (
                SELECT pathed.*, plain, suffix,
                       CASE WHEN known.pos IS NOT NULL THEN known.usual IS NULL
                            ELSE pathed.pos NOT IN (SELECT pos FROM newest WHERE pos = first_pos) END AS collision,
                       CASE WHEN known.pos IS NOT NULL AND pathed.pos % 7 <> 0 THEN 'skipped' ELSE 'pending' END AS status
                FROM pathed JOIN (SELECT DISTINCT pos, plain, suffix FROM renamed) USING (pos) LEFT JOIN known ON known.pos = pathed.pos
            )
            SELECT pos, name, status, collision,
                   CASE WHEN collision
                        THEN 'mrf/in_network_rates/' || substr(name, 1, 10) || '/'
                             || substr(plain, 1, least(length(plain) - length(suffix), 113 - length(suffix))) || '-'
                             || substr(md5(name || chr(10) || "downloadUrl"), 1, 16) || suffix
                        ELSE path END AS path
            FROM assigned""",
        "blob_pending": """
            SELECT pos, name, size, "downloadUrl", path FROM marked WHERE status = 'pending'""",
        "blob_status": """
            SELECT 'pending' AS status, count(*) FILTER (WHERE status = 'pending') AS files FROM marked
            UNION ALL
            SELECT 'skipped', count(*) FILTER (WHERE status = 'skipped') FROM marked
            UNION ALL
            SELECT 'collision', count(*) FILTER (WHERE collision) FROM marked""",
    }
    sql = {k: _FILES + v for k, v in on_files.items()} | {k: _BLOBS + v for k, v in on_blobs.items()}
    return sql | (llm.oracle_sql() if llm else {})
