"""Documents in files: reading and flattening, case by case."""

import gzip
import json

import pytest
from support import document, network, plan, spark_bag, write_document

from disclosure_spark.fixtures import PROCESSED_AT
from disclosure_spark.operators.flatten import flatten, flatten_counts
from disclosure_spark.schemas import FLAT_NAMES
from disclosure_spark.sources.documents import read_index_documents

NAME = "2026-06-01_acme_index.json"
ALLOWED = {"description": "allowed", "location": "https://files.example/a"}


@pytest.fixture
def flat(spark, tmp_path):
    """Flat rows of documents written as one file each, as dictionaries."""

    def run(*documents, name=NAME):
        for i, doc in enumerate(documents):
            write_document(tmp_path / f"d{i}" / "deep", name, doc)
        rows = flatten(read_index_documents(spark, str(tmp_path)), PROCESSED_AT)
        assert rows.columns == FLAT_NAMES
        return [r.asDict() for r in rows.collect()]

    return run


def test_plans_times_files(flat):
    structure = {
        "reporting_plans": [plan(plan_id="1"), plan(plan_id="2")],
        "in_network_files": network(1, 2, 3),
        "allowed_amount_file": ALLOWED,
    }
    rows = flat(document(structure))
    assert {(r["plan_id"], r["in_network_location"][-1]) for r in rows} == {
        (p, f) for p in "12" for f in "123"
    }
    assert len(rows) == 6
    assert {r["allowed_amount_location"] for r in rows} == {ALLOWED["location"]}
    assert {r["reporting_date"] for r in rows} == {"2026-06-01"}
    assert {r["source_file"] for r in rows} == {NAME}
    assert {r["processed_at"] for r in rows} == {PROCESSED_AT}


@pytest.mark.parametrize("files", [{"in_network_files": []}, {"in_network_files": None}, {}])
def test_no_files_keeps_one_row_per_plan(flat, files):
    rows = flat(document({"reporting_plans": [plan(), plan()], **files}))
    assert len(rows) == 2
    assert all(r["in_network_location"] is None for r in rows)
    assert all(r["allowed_amount_location"] is None for r in rows)


@pytest.mark.parametrize(
    "doc",
    [
        document({"reporting_plans": [], "in_network_files": network(1)}),
        document({"reporting_plans": None, "in_network_files": network(1)}),
        document({"in_network_files": network(1)}),
        document(),
        document(reporting_structure=None),
    ],
)
def test_without_plans_nothing_remains(flat, doc):
    assert flat(doc) == []


def test_structures_do_not_mix(flat):
    first = {"reporting_plans": [plan(plan_id="1")], "in_network_files": network(1)}
    second = {"reporting_plans": [plan(plan_id="2")], "in_network_files": network(2, 3)}
    rows = flat(document(first, second))
    assert sorted((r["plan_id"], r["in_network_location"][-1]) for r in rows) == [
        ("1", "1"), ("2", "2"), ("2", "3"),
    ]


def test_duplicates_are_kept(flat):
    structure = {"reporting_plans": [plan(), plan()], "in_network_files": network(1, 1)}
    assert len(flat(document(structure, structure))) == 8


def test_null_sponsor_is_kept(flat):
    rows = flat(document({"reporting_plans": [plan(plan_sponsor_name=None)]}))
    assert rows[0]["plan_sponsor_name"] is None
    assert rows[0]["plan_id"] == "012345678"


def test_batch_with_only_empty_file_lists(flat):
    structure = {"reporting_plans": [plan()], "in_network_files": []}
    assert len(flat(document(structure), document(structure))) == 2


def test_counts_without_exploding(spark, tmp_path):
    six = {"reporting_plans": [plan(), plan()], "in_network_files": network(1, 2, 3)}
    one = {"reporting_plans": [plan()], "in_network_files": []}
    write_document(tmp_path, "2026-06-01_a_index.json", document(six))
    write_document(tmp_path, "2026-06-01_b_index.json", document(one))
    write_document(tmp_path, "2026-06-01_c_index.json", document())
    documents = read_index_documents(spark, str(tmp_path))
    assert flatten_counts(documents).first().asDict() == {
        "documents": 3, "documents_without_rows": 1, "flat_rows": 7,
    }
    assert flatten(documents, PROCESSED_AT).count() == 7


def test_counts_equal_the_flatten_on_tables(spark, sf_dir):
    from disclosure_spark.fixtures import index_docs

    documents = index_docs(spark, sf_dir)
    assert flatten_counts(documents).first()["flat_rows"] == flatten(documents, PROCESSED_AT).count()


def test_truncated_file_is_a_reject(spark, tmp_path):
    text = json.dumps(document({"reporting_plans": [plan()]}), indent=1)
    (tmp_path / NAME).write_text(text[:-20])
    documents = read_index_documents(spark, str(tmp_path))
    row = documents.collect()[0]
    assert row["_corrupt_record"] and row["source_file"] == NAME
    assert flatten(documents, PROCESSED_AT).count() == 0


@pytest.mark.parametrize(
    "name, expected",
    [
        ("2026-06-01_a b_index.json", "2026-06-01_a%20b_index.json"),
        ("2026-06-01_a%b_index.json", "2026-06-01_a%25b_index.json"),
        ("2026-06-01_a+b_index.json", "2026-06-01_a+b_index.json"),
    ],
)
def test_source_file_stays_encoded(flat, name, expected):
    rows = flat(document({"reporting_plans": [plan()]}), name=name)
    assert rows[0]["source_file"] == expected


def test_array_of_documents_in_one_file(spark, tmp_path):
    doc = document({"reporting_plans": [plan()]})
    write_document(tmp_path, NAME, doc, doc, doc)
    assert flatten(read_index_documents(spark, str(tmp_path)), PROCESSED_AT).count() == 3


def test_gzip_and_pattern(spark, tmp_path):
    doc = document({"reporting_plans": [plan()]})
    write_document(tmp_path, "other.txt", doc)
    with gzip.open(tmp_path / f"{NAME}.gz", "wt") as out:
        json.dump(doc, out, indent=1)
    assert read_index_documents(spark, str(tmp_path)).count() == 0
    assert read_index_documents(spark, str(tmp_path), "*.json.gz").count() == 1


def test_files_give_the_same_rows_as_the_table(spark, sf_dir, tmp_path):
    """Nested rows, written as JSON files and read back, flatten to the same bag."""
    from disclosure_spark.fixtures import index_docs

    documents = index_docs(spark, sf_dir)
    by_file = {}
    for row in documents.collect():
        value = row.asDict(recursive=True)
        by_file.setdefault(value.pop("source_file"), []).append(value)
    for name, values in by_file.items():
        write_document(tmp_path / name[:10], name, *values)
    assert spark_bag(flatten(read_index_documents(spark, str(tmp_path)), PROCESSED_AT)) == spark_bag(
        flatten(documents, PROCESSED_AT)
    )


def test_flatten_does_not_shuffle_and_prunes(spark, sf_dir, capsys):
    from disclosure_spark.fixtures import index_docs

    flatten(index_docs(spark, sf_dir), PROCESSED_AT).select("plan_id", "in_network_location").explain()
    text = capsys.readouterr().out
    assert "Exchange" not in text
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "plan_id" in schema and "plan_market_type" not in schema and "version" not in schema
