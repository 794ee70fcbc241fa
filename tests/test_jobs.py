"""The transform and load jobs, and what they refuse."""

import datetime

import pytest
from pyspark.sql import functions as F
from support import document, network, plan, spark_bag, write_document

from disclosure_spark.fixtures import PROCESSED_AT, index_docs
from disclosure_spark.operators import flatten as flatten_module
from disclosure_spark.operators import quality, store
from disclosure_spark.operators.flatten import flatten
from disclosure_spark.plans import jobs
from disclosure_spark.sources.documents import read_index_documents
from disclosure_spark.sources.tables import read_index_files

STRUCTURE = {"reporting_plans": [plan()], "in_network_files": network(1, 2)}
JUNE, JULY = "2026-06-01", "2026-07-01"


@pytest.fixture
def zone(tmp_path):
    """Paths of one landing zone, processed zone and table."""
    return {n: str(tmp_path / n) for n in ("raw", "processed", "table")}


def land(zone, tmp_path, date, company, *structures, **values):
    structures = structures or (STRUCTURE,)
    folder = tmp_path / "raw" / "src" / "index" / date
    return write_document(folder, f"{date}_{company}_index.json", document(*structures, **values))


def by_date(spark, path):
    counts = quality.partition_counts(spark.read.parquet(path))
    return {str(r["partition_date"]): r["rows"] for r in counts.collect()}


def test_transform_reports_counts(spark, zone, tmp_path):
    land(zone, tmp_path, JUNE, "a")
    land(zone, tmp_path, JULY, "b", {"reporting_plans": [plan(plan_sponsor_name=None)]})
    result = jobs.transform(spark, zone["raw"], zone["processed"], processed_at="2026-06-03T10:00:00")
    assert (result.documents, result.rejects, result.rows) == (2, 0, 3)
    nulls = {k: v for k, v in result.null_counts.items() if v}
    assert nulls == {
        "plan_sponsor_name": 1, "in_network_description": 1, "in_network_location": 1,
        "allowed_amount_description": 3, "allowed_amount_location": 3,
    }
    assert by_date(spark, zone["processed"]) == {JUNE: 2, JULY: 1}
    # The key is in the files as well as in the path.
    assert "reporting_date" in spark.read.parquet(zone["processed"]).columns


def test_number_of_partitions(spark, zone, sf_dir):
    jobs.write_flat(index_docs(spark, sf_dir), zone["processed"], PROCESSED_AT, partitions=1)
    assert files_of(spark, zone["processed"]) == len(by_date(spark, zone["processed"]))


def test_transform_keeps_other_dates(spark, zone, tmp_path):
    land(zone, tmp_path, JUNE, "a")
    jobs.transform(spark, zone["raw"], zone["processed"])
    july = write_document(tmp_path / "later", f"{JULY}_b_index.json", document(STRUCTURE))
    jobs.transform(spark, str(july.parent), zone["processed"])
    assert by_date(spark, zone["processed"]) == {JUNE: 2, JULY: 2}


def test_transform_without_input(spark, zone, tmp_path):
    (tmp_path / "raw").mkdir()
    with pytest.raises(quality.NoDocumentsError):
        jobs.transform(spark, zone["raw"], zone["processed"])


def test_transform_without_rows(spark, zone, tmp_path):
    land(zone, tmp_path, JUNE, "a", {"reporting_plans": []})
    with pytest.raises(quality.EmptyResultError):
        jobs.transform(spark, zone["raw"], zone["processed"])


def test_rejects_stop_the_transform_before_it_publishes(spark, zone, tmp_path):
    land(zone, tmp_path, JUNE, "a")
    jobs.transform(spark, zone["raw"], zone["processed"])
    before = spark_bag(spark.read.parquet(zone["processed"]))
    bad = land(zone, tmp_path, JUNE, "bad")
    bad.write_text(bad.read_text()[:-30])
    with pytest.raises(quality.RejectedDocumentsError):
        jobs.transform(spark, zone["raw"], zone["processed"])
    assert spark_bag(spark.read.parquet(zone["processed"])) == before

    stage = str(tmp_path / "stage")
    result = jobs.transform(spark, zone["raw"], zone["processed"], max_rejects=1, stage=stage)
    assert (result.documents, result.rejects, result.rows) == (2, 1, 2)
    assert [r["source_file"] for r in jobs.rejected_documents(spark, stage).collect()] == [bad.name]


def test_load_types_the_columns(spark, zone, tmp_path):
    land(zone, tmp_path, JUNE, "a")
    jobs.transform(spark, zone["raw"], zone["processed"], processed_at="2026-06-03T10:00:00.5")
    loaded_at = datetime.datetime(2026, 6, 4, 1, 2, 3)
    assert jobs.load(spark, zone["processed"], zone["table"], loaded_at=loaded_at) == 2
    table = spark.read.parquet(zone["table"])
    types = dict(table.dtypes)
    assert len(types) == 19
    assert types["reporting_date"] == types["last_updated_on"] == types["partition_date"] == "date"
    assert types["processed_at"] == types["loaded_at"] == "timestamp_ntz"
    row = table.first()
    assert row["processed_at"] == datetime.datetime(2026, 6, 3, 10, 0, 0, 500000)
    assert row["loaded_at"] == loaded_at
    assert row["plan_id"] == "012345678"


def test_load_replaces_a_date_and_keeps_the_others(spark, zone, tmp_path):
    land(zone, tmp_path, JUNE, "a")
    land(zone, tmp_path, JULY, "b")
    jobs.transform(spark, zone["raw"], zone["processed"])
    loaded_at = datetime.datetime(2026, 7, 2)
    jobs.load(spark, zone["processed"], zone["table"], loaded_at=loaded_at)
    july = spark_bag(spark.read.parquet(zone["table"]).filter(f"partition_date = '{JULY}'"))

    land(zone, tmp_path, JUNE, "c")
    jobs.transform(spark, zone["raw"], zone["processed"])
    for _ in range(2):
        total = jobs.load(spark, zone["processed"], zone["table"], dates=[JUNE], loaded_at=loaded_at)
        assert total == 4
        table = spark.read.parquet(zone["table"])
        assert by_date(spark, zone["table"]) == {JUNE: 4, JULY: 2}
        assert spark_bag(table.filter(f"partition_date = '{JULY}'")) == july


@pytest.mark.parametrize(
    "values, message",
    [
        ({"last_updated_on": "June"}, "last_updated_on must be a date, not June"),
        ({"version": None}, "version must be a string, not null"),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_refused_row_leaves_the_table_as_it_was(spark, zone, tmp_path, values, message, ansi):
    land(zone, tmp_path, JUNE, "a")
    jobs.transform(spark, zone["raw"], zone["processed"])
    jobs.load(spark, zone["processed"], zone["table"])
    before = spark_bag(spark.read.parquet(zone["table"]))
    land(zone, tmp_path, JUNE, "bad", **values)
    jobs.transform(spark, zone["raw"], zone["processed"])
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=message):
            jobs.load(spark, zone["processed"], zone["table"])
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert spark_bag(spark.read.parquet(zone["table"])) == before
    refused = store.refused_rows(spark.read.parquet(zone["processed"]))
    assert {r["source_file"] for r in refused.collect()} == {f"{JUNE}_bad_index.json"}


def test_file_name_without_a_date_is_a_reject(spark, zone, tmp_path):
    write_document(tmp_path / "raw", "undated_index.json", document(STRUCTURE))
    write_document(tmp_path / "raw", f"{JUNE}_dated_index.json", document(STRUCTURE))
    with pytest.raises(jobs.RejectedDocumentsError, match="1 documents have no date"):
        jobs.transform(spark, zone["raw"], zone["processed"])
    done = jobs.transform(spark, zone["raw"], zone["processed"], max_rejects=1)
    assert done.rejects == 1 and done.dates == [JUNE] and "undated_in" not in done.dates
    assert jobs.load(spark, zone["processed"], zone["table"], dates=done.dates) == done.rows


def test_load_into_catalog_table(spark, zone, tmp_path):
    name = "out_of_network_allowed-amounts"
    store.create_table(spark, name, zone["table"], comment="it's flat")
    store.create_table(spark, name, zone["table"])
    land(zone, tmp_path, JUNE, "a")
    land(zone, tmp_path, JULY, "b")
    jobs.transform(spark, zone["raw"], zone["processed"])
    assert jobs.load(spark, zone["processed"], table=name) == 4
    assert jobs.load(spark, zone["processed"], table=name, dates=[JULY]) == 2
    counted = spark.sql(f"SELECT count(*) AS n FROM {store.quoted(name)}").first()
    assert counted["n"] == 4
    with pytest.raises(ValueError):
        store.quoted("t; DROP TABLE x")


def test_a_date_that_gives_no_rows_any_more_is_emptied(spark, zone, tmp_path):
    """June's document loses its plans: its rows go from the processed zone, the table and the catalog table."""
    name = "emptied_dates"
    store.create_table(spark, name, str(tmp_path / "catalog"))
    land(zone, tmp_path, JUNE, "a")
    land(zone, tmp_path, JULY, "b")
    done = jobs.transform(spark, zone["raw"], zone["processed"])
    assert done.dates == [JUNE, JULY] and done.stage is None
    jobs.load(spark, zone["processed"], zone["table"], dates=done.dates)
    jobs.load(spark, zone["processed"], table=name, dates=done.dates)
    land(zone, tmp_path, JUNE, "a", {"reporting_plans": []})
    done = jobs.transform(spark, zone["raw"], zone["processed"])
    assert done.dates == [JUNE, JULY] and by_date(spark, zone["processed"]) == {JULY: 2}
    assert jobs.load(spark, zone["processed"], zone["table"], dates=done.dates) == 2
    assert by_date(spark, zone["table"]) == {JULY: 2}
    assert jobs.load(spark, zone["processed"], table=name, dates=done.dates) == 2
    assert [str(r[0]) for r in spark.table(name).select("partition_date").distinct().collect()] == [JULY]


def test_load_without_rows(spark, zone, tmp_path):
    land(zone, tmp_path, JUNE, "a")
    jobs.transform(spark, zone["raw"], zone["processed"])
    with pytest.raises(quality.EmptyResultError):
        jobs.load(spark, zone["processed"], zone["table"], dates=["2020-01-01"])


def test_verify_counts(spark):
    one = spark.createDataFrame([("a",), ("a",), ("b",)], "d string")
    assert quality.verify_counts(one, one, "d") == 3
    more = one.union(spark.createDataFrame([("c",)], "d string"))
    assert quality.verify_counts(one, more, "d") == 3
    with pytest.raises(quality.CountMismatchError, match="1 date.* first c: expected 1, loaded 0"):
        quality.verify_counts(more, one, "d")


def test_dates_prune_partitions(spark, zone, tmp_path, capsys):
    land(zone, tmp_path, JUNE, "a")
    land(zone, tmp_path, JULY, "b")
    jobs.transform(spark, zone["raw"], zone["processed"])
    table = read_index_files(spark, zone["processed"], [JUNE])
    assert table.count() == 2
    table.explain()
    filters = capsys.readouterr().out.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "partition_date" in filters


def files_of(spark, path):
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"))
    return files.groupBy("f").count().count()


def write_split(spark, documents, path, advisory="64k"):
    """Write with a small partition size, as if the data were large."""
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": advisory,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        counts = jobs.write_flat(documents, path, PROCESSED_AT)
    finally:
        for key in sizes:
            spark.conf.unset(key)
    assert counts["rows"] == spark.read.parquet(path).count()
    found = spark.read.parquet(path).drop("partition_date")
    expected = flatten(documents, PROCESSED_AT)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_hot_date_is_split_over_tasks(spark, zone, sf_dir):
    # Read by several tasks, as large data is.
    documents = index_docs(spark, sf_dir).repartition(8)
    documents = documents.withColumn("source_file", F.lit(f"{JUNE}_a_index.json"))
    write_split(spark, documents, zone["processed"])
    assert files_of(spark, zone["processed"]) > 1


def test_hot_structure_is_split_over_tasks(spark, zone, tmp_path, monkeypatch):
    """One structure gives nearly all rows: 450 plans by 320 files."""
    monkeypatch.setattr(flatten_module, "BLOCKS_TOGETHER", 50)
    large = {
        "reporting_plans": [plan(plan_id=str(i)) for i in range(450)],
        "in_network_files": network(*range(320)),
        "allowed_amount_file": {"description": "d", "location": "l"},
    }
    no_files = {"reporting_plans": [plan(plan_id=str(i)) for i in range(250)]}
    land(zone, tmp_path, JUNE, "a", STRUCTURE, large, no_files, {"in_network_files": network(1)})
    documents = read_index_documents(spark, zone["raw"])
    write_split(spark, documents, zone["processed"], advisory="16k")
    assert spark.read.parquet(zone["processed"]).count() == 2 + 450 * 320 + 250
    assert files_of(spark, zone["processed"]) > 1


def test_small_documents_give_one_file_per_date(spark, zone, sf_dir):
    jobs.write_flat(index_docs(spark, sf_dir), zone["processed"], PROCESSED_AT)
    assert files_of(spark, zone["processed"]) == len(by_date(spark, zone["processed"]))


def test_many_structures_are_split_over_tasks(spark, zone, tmp_path):
    many = [
        {"reporting_plans": [plan(plan_id=str(i))], "in_network_files": network(i, i + 1)}
        for i in range(2000)
    ]
    land(zone, tmp_path, JUNE, "a", *many)
    write_split(spark, read_index_documents(spark, zone["raw"]), zone["processed"], advisory="16k")
    assert files_of(spark, zone["processed"]) > 1
