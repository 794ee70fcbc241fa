"""Listing, selection, landing."""

import itertools
import json
from pathlib import Path

import pytest
from support import document, plan, write_document

from disclosure_spark.functions.scalars import base_name, landing_name
from disclosure_spark.operators import blobs, landing
from disclosure_spark.plans import jobs
from disclosure_spark.sources.documents import read_index_documents
from disclosure_spark.sources.listing import read_landed, read_listing

INDEX = "_index.json"


def blob(name, size=10, url=None):
    return {"name": name, "size": size, "downloadUrl": url or f"https://files.example/{name}"}


@pytest.fixture
def listing(spark, tmp_path):
    def make(*items):
        path = tmp_path / "listing.json"
        path.write_text(json.dumps({"blobs": list(items)}, indent=1))
        return read_listing(spark, str(path))

    return make


def names(df):
    return [r["name"] for r in df.orderBy("pos").collect()]


def make_plan(df, **options):
    return blobs.plan_downloads(df, **({"source": "src", "file_type": "index", "max_files": 100} | options))


def test_listing_without_blobs(spark, tmp_path):
    path = tmp_path / "listing.json"
    path.write_text('{\n "other": 1\n}')
    assert read_listing(spark, str(path)).count() == 0


def test_selection(listing):
    df = listing(
        blob("2026-06-01_a_index.json", 10),
        blob("2026-06-01_b_INDEX.JSON", 1),
        blob("2026-06-01_c_index.json", 11),
        blob("2026-06-01_d_in-network-rates.json.gz", 1),
        blob("2026-06-01_e_index.json", 9),
        blob("2026-06-01_f_index.json", 12),
    )
    assert names(make_plan(df)) == [f"2026-06-01_{x}_index.json" for x in "acef"]
    assert names(make_plan(df, max_size=11)) == [f"2026-06-01_{x}_index.json" for x in "ace"]
    assert names(make_plan(df, max_size=11, max_files=2)) == [f"2026-06-01_{x}_index.json" for x in "ac"]
    assert names(make_plan(df, suffix="_INDEX.JSON")) == ["2026-06-01_b_INDEX.JSON"]
    counts = blobs.funnel(df, file_type="index", max_size=11, max_files=2).first().asDict()
    assert counts == {"total": 6, "after_suffix": 4, "after_size": 3, "after_limit": 2}
    assert blobs.funnel(df, file_type="index", max_files=9).first()["after_limit"] == 4


def test_path(listing):
    df = listing(blob("2026-06-01_a b c_index.json"))
    assert make_plan(df).first()["path"] == "src/index/2026-06-01/2026-06-01_a_b_c_index.json"


def statuses(plan_df, landed):
    marked = blobs.mark_landed(plan_df, landed)
    return sorted((r["pos"], r["status"]) for r in marked.collect())


def test_status(spark, listing):
    df = listing(
        blob("2026-06-01_a_index.json", 5),
        blob("2026-06-01_b c_index.json", 6),
        blob("2026-06-01_b_c_index.json", 7),
        blob("2026-06-01_d_index.json", 8),
        blob("2026-06-01_d_index.json", 8),
    )
    planned = make_plan(df)
    landed = spark.createDataFrame(
        [("src/index/2026-06-01/2026-06-01_a_index.json", 4), ("src/index/other", 1)],
        "path string, size bigint",
    )
    # The third path would equal the second one, and the last two blobs are the same.
    assert statuses(planned, landed) == [
        (0, "skipped"), (1, "pending"), (2, "pending"), (3, "pending"), (4, "skipped"),
    ]
    assert names(blobs.pending(planned, landed)) == [f"2026-06-01_{x}_index.json" for x in ("b c", "b_c", "d")]
    counts = blobs.status_counts(blobs.mark_landed(planned, landed))
    assert {r["status"]: r["files"] for r in counts.collect()} == {"pending": 3, "skipped": 2}
    none = blobs.status_counts(blobs.mark_landed(planned.limit(0), landed))
    assert {r["status"]: r["files"] for r in none.collect()} == {"pending": 0, "skipped": 0}


# Names and where they land, worked out by hand.
LANDED_NAMES = {
    "a_index.json": "a_index.json",
    "a b c.json": "a_b_c.json",
    "_hidden_index.json": "x_hidden_index.json",
    ".hidden.json": "x.hidden.json",
    " spaced.json": "x_spaced.json",
    "e" * 125 + ".json": "e" * 125 + ".json",
    "e" * 126 + ".json": "e" * 125 + ".json",
    "e" * 140 + ".json.gz": "e" * 122 + ".json.gz",
    "é" * 140 + ".json": "é" * 125 + ".json",
    "e" * 140 + ".": "e" * 130,
    "e" * 140: "e" * 130,
    "ab.x" + "y" * 140: "ab.x" + "y" * 128 + ".x" + "y" * 140,
}


def test_landing_name(spark):
    df = spark.createDataFrame([(n,) for n in LANDED_NAMES], "name string")
    assert {r["name"]: r["out"] for r in df.select("name", landing_name("name").alias("out")).collect()} == LANDED_NAMES


PARTS = [".", "_", ".json", ".gz", "é", " ", "a", "b" * 40, "c" * 70]


def test_landing_names_are_visible(spark):
    items = ["".join(parts) for n in (1, 2, 3, 4) for parts in itertools.product(PARTS, repeat=n)]
    df = spark.createDataFrame([(n,) for n in items], "name string")
    for row in df.select("name", landing_name("name").alias("out")).collect():
        assert " " not in row["out"] and row["out"][0] not in "._", row


def test_blobs_that_meet_on_one_path(spark, listing):
    """Each different blob is fetched, at a path of its own; a repeat is not."""
    long = "2026-06-01_" + "x" * 130
    df = listing(blob(f"{long}A_index.json"), blob(f"{long}B_index.json"), blob(f"{long}B_index.json"), blob(f"{long}A_index.json"))
    planned = make_plan(df, max_files=None)
    nothing = spark.createDataFrame([], "path string, size bigint")
    marked = blobs.mark_landed(planned, nothing)
    rows = {r["pos"]: r for r in marked.collect()}
    assert [rows[i]["status"] for i in range(4)] == ["pending", "pending", "skipped", "skipped"]
    assert [rows[i]["collision"] for i in range(4)] == [False, True, True, False]
    assert rows[0]["path"] != rows[1]["path"] == rows[2]["path"] and rows[1]["path"].endswith("_index.json"[6:])
    assert len(rows[1]["path"].rpartition("/")[2]) == 130
    again = blobs.mark_landed(planned, marked.select("path", "size"))
    assert {r["status"] for r in again.collect()} == {"skipped"}
    assert "Window" not in marked._jdf.queryExecution().executedPlan().toString()


def test_a_path_has_no_hidden_part(listing):
    df = listing(blob("_06-01_a_index.json"), blob("../b_index.json"))
    paths = [r["path"] for r in make_plan(df).orderBy("pos").collect()]
    assert paths[0] == "src/index/x_06-01_a_i/x_06-01_a_index.json"
    assert not any(part.startswith(("_", ".")) for path in paths for part in path.split("/"))


def test_base_name(spark):
    df = spark.createDataFrame([("a/b/c.json",), ("a\\b\\c.json",), ("c.json",)], "p string")
    assert {r[0] for r in df.select(base_name("p")).collect()} == {"c.json"}


def test_landed_reads_no_content(spark, tmp_path, capsys):
    write_document(tmp_path / "src" / "index" / "2026-06-01", "2026-06-01_a_index.json", document())
    landed = read_landed(spark, str(tmp_path))
    row = landed.first()
    assert row["path"] == "src/index/2026-06-01/2026-06-01_a_index.json"
    assert row["size"] == (tmp_path / row["path"]).stat().st_size
    landed.explain()
    schema = capsys.readouterr().out.split("ReadSchema: ")[1]
    assert "content" not in schema


def test_extract_end_to_end(spark, tmp_path):
    """Files are fetched over file URLs; a second run skips them and retries the failed one."""
    remote = tmp_path / "remote"
    items = []
    for company in ("a", "b c", "d"):
        name = f"2026-06-01_{company}_index.json"
        path = write_document(remote, name, document({"reporting_plans": [plan()]}))
        items.append(blob(name, path.stat().st_size, path.as_uri()))
    missing = remote / "2026-06-01_e_index.json"
    items.append(blob(missing.name, 1, missing.as_uri()))
    listing = remote / "listing.json"
    listing.write_text(json.dumps({"blobs": items}, indent=1))
    root = tmp_path / "raw"
    options = {"source": "src", "file_type": "index", "max_files": 10}

    first = jobs.extract(spark, listing.as_uri(), str(root), **options)
    assert first == {"downloaded": 3, "skipped": 0, "failed": 1, "collision": 0}
    landed = root / "src" / "index" / "2026-06-01"
    assert sorted(p.name for p in landed.iterdir()) == [
        "2026-06-01_a_index.json", "2026-06-01_b_c_index.json", "2026-06-01_d_index.json",
    ]
    copied, original = landed / "2026-06-01_b_c_index.json", remote / "2026-06-01_b c_index.json"
    assert copied.read_bytes() == original.read_bytes()

    write_document(remote, missing.name, document({"reporting_plans": [plan()]}))
    second = jobs.extract(spark, listing.as_uri(), str(root), **options)
    assert second == {"downloaded": 1, "skipped": 3, "failed": 0, "collision": 0}
    assert read_index_documents(spark, str(root)).count() == 4

    with pytest.raises(OSError):
        jobs.extract(spark, Path("/nowhere/listing.json").as_uri(), str(root), **options)


def test_fetch_taken_up_again(spark, tmp_path):
    """A second attempt keeps what is complete, and nothing partial has a final name."""
    remote = tmp_path / "remote"
    remote.mkdir()
    (remote / "a").write_bytes(b"x" * 3_000_000)
    rows = [
        ("d/a", (remote / "a").as_uri()),
        ("d/b", (remote / "b").as_uri()),
        ("../c", (remote / "a").as_uri()),
    ]
    wanted = spark.createDataFrame(rows, "path string, downloadUrl string")
    root = str(tmp_path / "root")

    def outcome(report):
        found = landing.fetch(wanted, root, str(tmp_path / report), tasks=2)
        return {r["path"]: (r["status"], r["bytes"]) for r in found.collect()}

    outside = {"../c": ("failed", None)}
    assert outcome("r1") == {"d/a": ("downloaded", 3_000_000), "d/b": ("failed", None)} | outside
    assert [p.name for p in (tmp_path / "root" / "d").iterdir()] == ["a"]
    (remote / "a").write_bytes(b"changed")
    (remote / "b").write_bytes(b"y")
    assert outcome("r2") == {"d/a": ("downloaded", 3_000_000), "d/b": ("downloaded", 1)} | outside
    assert not (tmp_path / "c").exists()


def test_all_files_without_a_sort(spark):
    listing = spark.createDataFrame([(2, 0, "b_index.json", 1), (1, 0, "a_index.json", 1), (1, 1, "c_index.json", 1)], "page int, pos long, name string, size long")
    plan = blobs.plan_downloads(listing, source="s", file_type="index", max_files=None)
    assert plan.count() == 3
    assert "TakeOrdered" not in plan._jdf.queryExecution().executedPlan().toString()
    first = blobs.plan_downloads(listing, source="s", file_type="index", max_files=2)
    assert [r["name"] for r in first.collect()] == ["a_index.json", "c_index.json"], "pages before places"
    assert blobs.funnel(listing, file_type="index", max_files=None).first()["after_limit"] == 3
