"""The ledger, versioned tables, quarantine, staging by date, counts from footers, exports and partials."""

import contextlib
import gzip
import io
import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import when
from support import document, network, plan, spark_bag, write_document

import __spark_entry__ as registered
from disclosure_spark import fixtures
from disclosure_spark.operators import blobs, ledger, partials, quality, store, versions
from disclosure_spark.operators.flatten import flatten
from disclosure_spark.plans import explore, jobs
from disclosure_spark.sources import tables
from disclosure_spark.sources.tables import EMPTY, read_own_export, write_csv_export
from disclosure_spark.workspace import arrow_uri

JUNE, JULY = "2026-06-01", "2026-07-01"
STRUCTURE = {"reporting_plans": [plan()], "in_network_files": network(1, 2)}


def explained(df, mode=None):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode) if mode else df.explain()
    return out.getvalue()


# ---- ledger


def planned(spark, *items, order=None):
    rows = [(i, n, s, u or f"u/{n}") for i, (n, s, u) in enumerate(items)]
    df = spark.createDataFrame(rows, "pos long, name string, size long, downloadUrl string")
    return blobs.plan_downloads(df, source="s", file_type="index", max_files=None)


def noted(marked, run="1"):
    some = marked.filter("status = 'pending'").select("name", "downloadUrl", "path", "size")
    return some.select("*", F.col("size").alias("bytes"), F.lit(run).alias("run"), ledger.ledger_date().alias("date"))


def test_ledger_keeps_paths_when_the_listing_is_reordered(spark):
    """A landed on the shared path; a listing with B first must fetch B and not A again."""
    a, b = (f"{JUNE}_{'x' * 140}{c}_index.json" for c in "AB")
    nothing = spark.createDataFrame([], ledger.LEDGER_SCHEMA)
    first = ledger.mark(planned(spark, (a, 5, None)), nothing)
    usual = first.first()["path"]
    again = {r["name"]: r for r in ledger.mark(planned(spark, (b, 6, None), (a, 5, None)), noted(first)).collect()}
    assert (again[a]["status"], again[a]["path"], again[a]["collision"]) == ("skipped", usual, False)
    assert (again[b]["status"], again[b]["collision"]) == ("pending", True) and again[b]["path"] != usual
    both = noted(first).unionByName(noted(ledger.mark(planned(spark, (b, 6, None)), noted(first)), "2"))
    assert {r["status"] for r in ledger.mark(planned(spark, (b, 6, None), (a, 5, None), (a, 5, None)), both).collect()} == {"skipped"}


def test_ledger_fetches_what_changed(spark):
    name = f"{JUNE}_a_index.json"
    nothing = spark.createDataFrame([], ledger.LEDGER_SCHEMA)
    came = noted(ledger.mark(planned(spark, (name, 5, None)), nothing))
    status = lambda size: ledger.mark(planned(spark, (name, size, None)), came).first()["status"]
    assert [status(5), status(6), status(None)] == ["skipped", "pending", "skipped"]
    later = came.unionByName(came.withColumn("size", F.lit(6).cast("long")).withColumn("run", F.lit("2")))
    assert ledger.mark(planned(spark, (name, 6, None)), later).first()["status"] == "skipped"


def listing_of(remote, *names):
    items = []
    for name in names:
        path = remote / name
        items.append({"name": name, "size": path.stat().st_size, "downloadUrl": path.as_uri()})
    listing = remote / "listing.json"
    listing.write_text(json.dumps({"blobs": items}))
    return listing.as_uri()


def test_extract_with_ledger(spark, tmp_path, monkeypatch):
    """Another order, a partial file, a blob that has grown; old dates are not listed."""
    remote, root = tmp_path / "remote", tmp_path / "raw"
    a, b = (f"{JUNE}_{'x' * 140}{c}_index.json" for c in "AB")
    for name in (a, b):
        write_document(remote, name, document(STRUCTURE))
    options = {"source": "src", "file_type": "index", "max_files": None}
    counts = lambda *names: jobs.extract(spark, listing_of(remote, *names), str(root), **options)
    assert counts(a)["downloaded"] == 1
    assert counts(b, a) == {"downloaded": 1, "skipped": 1, "failed": 0, "collision": 1}
    folder = root / "src" / "index" / JUNE
    assert len(list(folder.iterdir())) == 2
    write_document(remote, b, document(STRUCTURE, STRUCTURE))
    assert counts(b, a) == {"downloaded": 1, "skipped": 1, "failed": 0, "collision": 1}
    assert {p.stat().st_size for p in folder.iterdir()} == {(remote / x).stat().st_size for x in (a, b)}
    # Files of other dates are neither read nor listed, whatever is there.
    c = f"{JULY}_c_index.json"
    write_document(remote, c, document(STRUCTURE))
    monkeypatch.setattr(jobs, "read_landed", None)
    assert counts(c)["downloaded"] == 1


def test_a_date_without_ledger_adopts_whole_files(spark, tmp_path):
    remote, root = tmp_path / "remote", tmp_path / "raw"
    whole, part = f"{JUNE}_whole_index.json", f"{JUNE}_part_index.json"
    folder = root / "src" / "index" / JUNE
    for name in (whole, part):
        text = write_document(remote, name, document(STRUCTURE)).read_text()
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text if name == whole else text[:-20])
    got = jobs.extract(spark, listing_of(remote, whole, part), str(root), source="src", file_type="index", max_files=None)
    assert got == {"downloaded": 1, "skipped": 1, "failed": 0, "collision": 0}
    assert (folder / part).read_bytes() == (remote / part).read_bytes()


def test_arrow_uri(spark):
    assert arrow_uri(spark, "/a/b") == "file:///a/b" == arrow_uri(spark, "file:/a/b") == arrow_uri(spark, "file:///a/b")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://store/")
    conf.set("fs.viewfs.mounttable.store.link./in", "file:///tmp")
    try:
        assert arrow_uri(spark, "/in/x") == "viewfs://store/in/x"
    finally:
        conf.set("fs.defaultFS", before)


# ---- transform and load


def land(folder, date, company, *structures, **values):
    return write_document(folder / "raw" / "src" / "index" / date, f"{date}_{company}_index.json", document(*structures, **values))


def dates_of(df):
    return {str(r[0]): r[1] for r in quality.partition_counts(df).collect()}


@pytest.fixture
def zone(tmp_path):
    return {n: str(tmp_path / n) for n in ("raw", "processed", "table")}


def test_the_only_date_of_a_batch_is_emptied(spark, zone, tmp_path):
    store.create_table(spark, "only_date", str(tmp_path / "catalog"))
    versions.create_versioned(spark, "only_date_v", str(tmp_path / "versions"))
    land(tmp_path, JUNE, "a", STRUCTURE)
    done = jobs.transform(spark, zone["raw"], zone["processed"])
    targets = [{"target": zone["table"]}, {"table": "only_date"}, {"versioned": "only_date_v"}]
    for t in targets:
        assert jobs.load(spark, zone["processed"], dates=done.dates, **t) == 2
    land(tmp_path, JUNE, "a", {"reporting_plans": []})
    with pytest.raises(quality.EmptyResultError):
        jobs.transform(spark, zone["raw"], zone["processed"])
    assert store.partition_dates(spark, zone["processed"]) == [JUNE], "without clear_empty nothing changes"
    done = jobs.transform(spark, zone["raw"], zone["processed"], clear_empty=True)
    assert (done.rows, done.dates) == (0, [JUNE]) and store.partition_dates(spark, zone["processed"]) == []
    for t in targets:
        assert jobs.load(spark, zone["processed"], dates=done.dates, **t) == 0
    assert store.partition_dates(spark, zone["table"]) == []
    assert spark.table("only_date").count() == spark.table("only_date_v").count() == 0
    # It comes back, and a date that was never read is still an error.
    land(tmp_path, JUNE, "a", STRUCTURE)
    done = jobs.transform(spark, zone["raw"], zone["processed"])
    assert jobs.load(spark, zone["processed"], zone["table"]) == 2
    with pytest.raises(quality.EmptyResultError):
        jobs.load(spark, zone["processed"], zone["table"], dates=["2020-01-01"])


def test_files_with_hidden_names_are_counted(spark, zone, tmp_path):
    """Names that others have landed: they are not read, and the run says how many."""
    good = land(tmp_path, JUNE, "a", STRUCTURE)
    for name in (f"_{good.name}", f".{good.name}", "_x/inner_index.json", "_SUCCESS", "_part.json.part"):
        other = good.parent / name
        other.parent.mkdir(exist_ok=True)
        other.write_text(good.read_text())
    done = jobs.transform(spark, zone["raw"], zone["processed"])
    assert (done.documents, done.passed_over) == (1, 3)
    good.parent.joinpath("_x", "inner_index.json").unlink()
    assert jobs.transform(spark, [str(good.parent)], zone["processed"]).passed_over == 2


def test_a_second_date_that_fails_leaves_all_dates(spark, zone, tmp_path, monkeypatch):
    versions.create_versioned(spark, "second_fails", str(tmp_path / "versions"))
    for date in (JUNE, JULY):
        land(tmp_path, date, "a", STRUCTURE)
    jobs.transform(spark, zone["raw"], zone["processed"])
    assert jobs.load(spark, zone["processed"], versioned="second_fails") == 4
    before = spark_bag(spark.table("second_fails"))
    land(tmp_path, JUNE, "b", STRUCTURE)
    bad = land(tmp_path, JULY, "b", STRUCTURE, last_updated_on="July")
    jobs.transform(spark, zone["raw"], zone["processed"])
    with pytest.raises(Exception, match="last_updated_on must be a date"):
        jobs.load(spark, zone["processed"], versioned="second_fails")
    assert spark_bag(spark.table("second_fails")) == before
    # Killed after the rows are written and before the view is replaced.
    bad.unlink()
    jobs.transform(spark, zone["raw"], zone["processed"])
    with monkeypatch.context() as m:
        m.setattr(versions, "_show", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            jobs.load(spark, zone["processed"], versioned="second_fails")
    assert spark_bag(spark.table("second_fails")) == before
    assert jobs.load(spark, zone["processed"], versioned="second_fails", dates=[JUNE]) == 4
    assert dates_of(spark.table("second_fails")) == {JUNE: 4, JULY: 2}
    assert versions.vacuum(spark, "second_fails") >= 2
    assert dates_of(spark.table("second_fails")) == {JUNE: 4, JULY: 2}
    assert set(versions.live(spark, "second_fails")) == {JUNE, JULY}


def test_many_dates_in_a_view(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "PART", 50)
    versions.create_versioned(spark, "many_dates", str(tmp_path / "versions"))
    runs = {f"20{i:02d}-01-01": f"run-{i % 3}'s" for i in range(30)}
    versions._show(spark, "many_dates", runs)
    assert versions.live(spark, "many_dates") == runs
    versions._show(spark, "many_dates", {})
    assert versions.live(spark, "many_dates") == {} and spark.table("many_dates").count() == 0


def test_tables_without_the_option_are_refused(spark, zone, sf_dir, tmp_path):
    rows = fixtures.index_files(spark, sf_dir).limit(5)
    columns = ", ".join(f"{c.name} {c.type}" for c in store.TABLE_COLUMNS)
    spark.sql(f"CREATE TABLE plain_files ({columns}, partition_date date) USING parquet PARTITIONED BY (partition_date)")
    with pytest.raises(ValueError, match="partitionOverwriteMode"):
        store.replace_table_partitions(rows, "plain_files")
    store.create_table(spark, "hyphen-files", str(tmp_path / "t"))
    with pytest.raises(ValueError, match="same table as 'hyphen-files'"):
        store.create_table(spark, "hyphen_files", str(tmp_path / "t"))
    with pytest.raises(ValueError, match="same table"):
        store.replace_table_partitions(rows, "hyphen_files")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"
    store.replace_table_partitions(rows, "hyphen-files")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_quarantine(spark, zone, tmp_path):
    land(tmp_path, JUNE, "good", STRUCTURE)
    land(tmp_path, JUNE, "bad", STRUCTURE, version=None, last_updated_on="June")
    jobs.transform(spark, zone["raw"], zone["processed"])
    aside = str(tmp_path / "aside")
    with pytest.raises(quality.RefusedRowsError, match="2 rows are refused"):
        jobs.load(spark, zone["processed"], zone["table"], quarantine=aside)
    assert store.partition_dates(spark, zone["table"]) == []
    assert jobs.load(spark, zone["processed"], zone["table"], quarantine=aside, max_refused=2) == 2
    assert {r["source_file"] for r in spark.read.parquet(zone["table"]).collect()} == {f"{JUNE}_good_index.json"}
    kept = spark.read.parquet(aside)
    assert kept.count() == 4  # of both attempts
    assert {r["reason"] for r in kept.collect()} == {"last_updated_on must be a date, not June; version must be a string, not null"}


def test_large_dates_are_flattened_without_a_shuffle(spark, sf_dir, tmp_path):
    stage = str(tmp_path / "stage")
    docs = fixtures.index_docs(spark, sf_dir).withColumn(jobs.STAGE_DATE, F.substring("source_file", 1, 10))
    jobs.stage_documents(docs, stage, by_date=True)
    dates, undated = jobs.document_dates(jobs.staged_documents(spark, stage))
    most = {d: m for d, (_, m) in dates.items()}
    assert undated == 0 and sum(n for n, _ in dates.values()) == fixtures.index_files(spark, sf_dir).count()
    expected = flatten(fixtures.index_docs(spark, sf_dir), "2026-06-01")
    rows = {least: jobs.flat_by_date(spark, stage, "2026-06-01", most, least_bytes=least) for least in (0, 12_000, 1 << 40)}
    for df in rows.values():
        found = df.drop("partition_date")
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    assert "Exchange" not in explained(rows[0]) and "Exchange" in explained(rows[1 << 40])
    some = jobs.large_dates(spark, stage, most, 12_000)
    assert 0 < len(some) < len(most)
    # A document too large for one task sends its date through the shuffle.
    assert jobs.large_dates(spark, stage, dict.fromkeys(most, jobs.MOST_DOCUMENT_ROWS + 1), 0) == []


def test_counts_come_from_footers(spark, sf_dir):
    counts = quality.stored_counts(spark, fixtures.stored(spark, sf_dir).table)
    assert "PushedAggregation: [COUNT(*)]" in explained(counts, "formatted")
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    assert dates_of(fixtures.index_files(spark, sf_dir)) == {str(r[0]): r[1] for r in counts.collect()}


def test_preview_reads_keys_first(spark, sf_dir):
    files = fixtures.index_files(spark, sf_dir)
    keys = ["source_file", "plan_id", "in_network_location"]
    for df, n in ((files, 5), (files, 300), (files.withColumn("source_file", F.when(F.col("version") > "1.2", F.col("source_file"))), 7), (files.limit(0), 5)):
        rest = [c for c in df.columns if c not in keys]
        plain = df.orderBy(*keys, *rest).limit(n)
        assert list(map(tuple, explore.preview(df, n=n).collect())) == list(map(tuple, plain.collect()))
    scans = [x for x in explained(explore.preview(files)).splitlines() if "FileScan" in x]
    assert {"plan_id" in x and "version" not in x for x in scans} == {True, False}


# ---- compaction, export, partials


def test_compaction(spark, sf_dir, tmp_path):
    versions.create_versioned(spark, "packed", str(tmp_path / "versions"))
    rows = fixtures.index_files(spark, sf_dir)
    counts = versions.publish(rows.repartition(8), "packed")
    before, bag = versions.live_files(spark, "packed").collect(), spark_bag(spark.table("packed"))
    assert min(r["files"] for r in before) > 1
    some = sorted(counts)[:40]
    assert versions.compact(spark, "packed", some) == {d: counts[d] for d in some}
    after = {str(r["partition_date"]): (r["files"], r["rows"]) for r in versions.live_files(spark, "packed").collect()}
    assert {after[d] for d in some} == {(1, counts[d]) for d in some}
    assert all(after[d][0] > 1 for d in counts if d not in some)
    assert spark_bag(spark.table("packed")) == bag
    small = versions.compact(spark, "packed", some[:2], target_bytes=2_000)
    assert small and spark_bag(spark.table("packed")) == bag
    assert versions.compact(spark, "packed", ["2020-01-01"]) == {}


def test_csv_round_trip(spark, sf_dir, tmp_path):
    odd = ["", " ", "NA", "null", '"', '""', ",", "a\nb", "a\r\nb", "\rx", "\t", "\\", '\\"', "007", "é", " a ", "#x", "'"]
    rows = fixtures.index_files(spark, sf_dir).limit(len(odd) * 3)
    pick = F.element_at(F.array(*map(F.lit, odd)), (F.pmod(F.monotonically_increasing_id(), F.lit(len(odd))) + 1).cast("int"))
    rows.withColumn("plan_sponsor_name", pick).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    write_csv_export(rows, str(tmp_path / "csv"), max_rows=7)
    back = read_own_export(spark, str(tmp_path / "csv"))
    assert spark_bag(back) == spark_bag(rows.select(back.columns))
    assert {r[0] for r in back.select("plan_sponsor_name").collect()} == set(odd)
    assert back.filter("in_network_location is null").count() == rows.filter("in_network_location is null").count() > 0
    with pytest.raises(Exception, match="empty one"):
        write_csv_export(rows.withColumn("version", F.lit(EMPTY)), str(tmp_path / "refused"))


def test_partials_read_only_new_dates(spark, sf_dir, tmp_path):
    table, path = str(tmp_path / "table"), str(tmp_path / "partials")
    rows = fixtures.index_files(spark, sf_dir)
    store.replace_partitions(rows, table)
    read = lambda: spark.read.parquet(table)
    partials.refresh(spark, read(), path)
    gone, changed = (str(r[0]) for r in rows.select("partition_date").distinct().orderBy("partition_date").limit(2).collect())
    store.replace_partitions(rows.filter(f"partition_date = DATE '{changed}' AND plan_name LIKE '%-1'"), table)
    store.drop_dates(spark, table, [gone])
    spark.catalog.refreshByPath(table)
    old = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "partials").iterdir() if changed not in p.name}
    partials.refresh(spark, read(), path, [gone, changed])
    kept = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "partials").iterdir() if changed not in p.name and "=" in p.name}
    assert kept == {k: v for k, v in old.items() if gone not in k and "=" in k}, "other dates are as they were"
    spark.catalog.refreshByPath(path)
    stored = spark.read.parquet(path)
    assert partials.overview(stored).collect() == explore.overview(read()).collect()
    assert spark_bag(partials.entity_profile(stored)) == spark_bag(explore.entity_profile(read()))


def test_json_files_are_written_whole(spark, sf_dir):
    """A page of the listing per file, in order; a second attempt replaces them."""
    root = fixtures.landed_listing(spark, sf_dir)
    rows = registered.queries()["listing_file"](spark, sf_dir).collect()
    assert len(rows) == fixtures.blob_listing(spark, sf_dir).count() and root


# ---- writes without a sort, inputs that are made by date
def test_dates_in_turn_are_written_without_a_sort(spark, sf_dir, tmp_path):
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    rows = fixtures.index_files(spark, sf_dir).limit(90).coalesce(1)
    dates = F.element_at(F.array(*[F.lit(f"2026-0{i}-01") for i in range(1, 4)]), (F.pmod(F.monotonically_increasing_id(), F.lit(3)) + 1).cast("int"))
    rows.withColumn("partition_date", dates.cast("date")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    spark.sql(f"CREATE TABLE in_turn (x INT, d INT) USING parquet PARTITIONED BY (d) LOCATION '{tmp_path / 'in_turn'}'")
    insert = "EXPLAIN INSERT OVERWRITE in_turn SELECT id, id % 3 FROM range(9)"
    with store.open_writers(spark):
        with store.open_writers(spark):
            pass
        assert "Sort" not in spark.sql(insert).first()[0]
    assert "Sort" in spark.sql(insert).first()[0] and spark.conf.get(setting, None) is None, "the setting is gone again"
    spark.conf.set(setting, "3")
    with store.open_writers(spark):
        assert spark.conf.get(setting) == "3"
    assert spark.conf.get(setting) == "3"
    spark.conf.unset(setting)
    store.replace_partitions(rows, str(tmp_path / "table"))
    back = spark.read.parquet(str(tmp_path / "table"))
    assert spark_bag(back.select(rows.columns)) == spark_bag(rows)
    assert len(list((tmp_path / "table").glob("*/*.parquet"))) == 3
    with pytest.raises(Exception, match="must be a date"):
        store.replace_partitions(store.to_table_rows(rows.withColumn("last_updated_on", F.lit("June"))), str(tmp_path / "table"))
    assert spark.conf.get(setting, None) is None and spark.read.parquet(str(tmp_path / "table")).count() == 90


def test_more_dates_than_open_files(spark, sf_dir, tmp_path):
    rows = fixtures.index_files(spark, sf_dir).coalesce(1)
    assert rows.select("partition_date").distinct().count() > store.OPEN_FILES
    store.replace_partitions(rows.orderBy("plan_id").coalesce(1), str(tmp_path / "table"))
    back = spark.read.parquet(str(tmp_path / "table"))
    assert spark_bag(back.select(rows.columns)) == spark_bag(rows)


def test_processed_rows_need_no_table(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fixtures, "_key", lambda spark, sf_dir: ("alone", sf_dir))
    monkeypatch.setattr(fixtures, "load", lambda *a, **b: pytest.fail("the table is not asked for"))
    expected = flatten(fixtures.index_docs(spark, sf_dir), fixtures.PROCESSED_AT)
    assert spark_bag(fixtures.processed_files(spark, sf_dir).select(expected.columns)) == spark_bag(expected)
    files = fixtures.index_docs(spark, sf_dir).select(F.col("_metadata.file_path").alias("file"), F.substring("source_file", 1, 10).alias("date"))
    spread = files.distinct().groupBy("date").count().agg(F.max("count")).first()[0]
    assert spread <= 2, "a date's documents are in few files"


def test_a_task_of_partials_writes_few_dates(spark, sf_dir, tmp_path):
    rows = fixtures.index_files(spark, sf_dir).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        partials.refresh(spark, rows, str(tmp_path / "partials"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [p.parent.name for p in (tmp_path / "partials").glob("*/*.parquet")]
    assert len(files) == len(set(files)), "one file a date"


def test_exports_and_landed_json_are_compressed(spark, sf_dir, tmp_path):
    write_csv_export(fixtures.index_files(spark, sf_dir).limit(20), str(tmp_path / "csv"), max_rows=7)
    parts = [p.name for p in (tmp_path / "csv").glob("part-*")]
    assert len(parts) >= 3 and all(p.endswith(".csv.gz") for p in parts)
    landed = [p for p in Path(fixtures.landed_json(spark, sf_dir)).rglob("*") if p.is_file() and not p.name.startswith(".")]
    assert landed and all(p.name.endswith("_index.json.gz") for p in landed)
    assert len({p.name for p in landed}) == len(landed)


def test_the_table_is_made_in_one_pass(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fixtures, "_key", lambda spark, sf_dir: ("table alone", sf_dir))
    for step in ("stage_documents", "write_flat"):
        monkeypatch.setattr(fixtures, step, lambda *a, **b: pytest.fail("no query asked for documents or flat rows"))
    found = fixtures.index_files(spark, sf_dir).drop("loaded_at")
    columns = sorted(found.columns)
    expected = store.to_table_rows(flatten(fixtures.make_index_docs(spark, sf_dir), fixtures.PROCESSED_AT))
    assert spark_bag(found.select(columns)) == spark_bag(expected.select(columns))


def test_a_table_with_too_few_rows_is_found_out(spark, sf_dir):
    path = fixtures.stored(spark, sf_dir).table
    rows = fixtures.index_files(spark, sf_dir).count()
    assert quality.verify_total(spark, path, rows) == rows
    with pytest.raises(quality.CountMismatchError):
        quality.verify_total(spark, path, rows + 1)
    with pytest.raises(quality.EmptyResultError):
        quality.verify_total(spark, path, 0)


def test_flat_rows_have_no_dictionaries_of_identifiers(spark, sf_dir, tmp_path):
    import pyarrow.parquet as pq

    rows = fixtures.index_files(spark, sf_dir).limit(500).coalesce(1)
    store.replace_partitions(rows, str(tmp_path / "table"))
    file = next((tmp_path / "table").glob("*/*.parquet"))
    columns = [pq.read_metadata(file).row_group(0).column(i) for i in range(len(store.TABLE_COLUMNS))]
    assert all(c.compression == "ZSTD" for c in columns)
    coded = {c.path_in_schema for c in columns if any("DICTIONARY" in e for e in c.encodings)}
    assert "version" in coded and not coded & set(store.PLAIN_COLUMNS)


def test_small_files_are_packed_by_date(spark, sf_dir, tmp_path):
    """No row is shuffled on the way into small files or out of them, and a date's files meet in one task."""
    rows = fixtures.index_files(spark, sf_dir)
    table = f"packed_{uuid.uuid4().hex}"
    versions.create_versioned(spark, table, str(tmp_path / "runs"))
    before = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    counts = versions.publish(rows, table, max_rows=20)
    assert spark.conf.get("spark.sql.files.maxRecordsPerFile") == before
    files = {str(r[0]): r["files"] for r in versions.live_files(spark, table).collect()}
    assert all(files[d] >= n / 20 for d, n in counts.items()) and sum(files.values()) > 4 * len(files)
    # Tasks of a fraction of the table: without a scan for each group of dates every task has files of most dates.
    size = sum(p.stat().st_size for p in (tmp_path / "runs").rglob("*.parquet"))
    assert versions.compact(spark, table, list(counts), target_bytes=size // 8) == counts
    packed = [r["files"] for r in versions.live_files(spark, table).collect()]
    assert sum(packed) <= 2 * len(packed)


def test_date_groups():
    sizes = {f"2024-01-{i:02d}": 10 for i in range(1, 31)}
    assert store.date_groups(sizes, 3) == [sorted(sizes)[i : i + 10] for i in (0, 10, 20)]
    assert store.date_groups(sizes, 1) == [sorted(sizes)]
    assert len(store.date_groups({f"{i:05d}": 1 for i in range(1000)}, 500)) == store.MOST_GROUPS
    hot = store.date_groups({"a": 1, "b": 1000, "c": 1}, 3)
    assert [d for g in hot for d in g] == ["a", "b", "c"]
    assert store.date_groups({"a": 0}, 5) == [["a"]]


def test_only_texts_of_an_export_are_compared_with_the_sign(spark, sf_dir, tmp_path, monkeypatch):
    """Dates and timestamps cannot be it, and are made into text once."""
    rows = fixtures.index_files(spark, sf_dir).limit(3)
    seen = []
    monkeypatch.setattr(tables.F, "when", lambda condition, value: seen.append(condition) or when(condition, value))
    write_csv_export(rows, str(tmp_path / "csv"))
    assert len(seen) == sum(c.type == "string" for c in store.TABLE_COLUMNS)


def test_shared_plan_ids_shuffles_no_sponsors(spark):
    rows = [(p, f"f{f}", s) for p, n in (("a", 3), ("b", 3), ("c", 2), (None, 4), ("d", 1)) for f in range(n) for s in (None, f"s{f % 2}", "")]
    files = spark.createDataFrame(rows + rows, "plan_id string, source_file string, plan_sponsor_name string")
    found = explore.shared_plan_ids(files, 3)
    assert [tuple(r) for r in found.collect()] == [(None, 4, 3), ("a", 3, 3), ("b", 3, 3)]
    assert "Expand" not in explained(found, "extended"), "one count over all ids"
    assert explore.shared_plan_ids(files.limit(0)).collect() == []


def test_a_task_of_documents_has_few_dates(spark, tmp_path, monkeypatch):
    dates = [f"2024-{m:02d}-01" for m in range(1, 13)]
    for d in dates:
        for i in range(20):
            write_document(tmp_path / "raw" / d, f"{d}_{i}_index.json", document(STRUCTURE))
    monkeypatch.setattr(jobs, "DOCUMENT_TASK_BYTES", 8 << 10)
    documents = jobs.dated_documents(spark, str(tmp_path / "raw"))
    assert documents.filter("reporting_entity_name IS NOT NULL").count() == 240
    stage = str(tmp_path / "stage")
    jobs.stage_documents(documents.withColumn(jobs.STAGE_DATE, F.substring("source_file", 1, 10)), stage, by_date=True)
    of_task = {}
    for p in Path(stage).glob("*/*.parquet"):
        of_task.setdefault(p.name.split("-")[1], set()).add(p.parent.name)
    assert len({d for of in of_task.values() for d in of}) == 12
    assert max(map(len, of_task.values())) <= 2, "neighbouring dates only"
    with pytest.raises(quality.NoDocumentsError):
        (tmp_path / "empty").mkdir()
        jobs.dated_documents(spark, str(tmp_path / "empty"))


def test_files_of_several_batches(spark, tmp_path):
    rows = [(f"d/{'ab'[i % 2]}.json{'.gz' * (i % 2)}", i, f"é{i}" if i % 5 else "") for i in range(60)]
    files = spark.createDataFrame(rows, "path string, pos int, text string").selectExpr("*", "'[' AS before", "', ' AS between", "']\n' AS after")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        fixtures.write_files(files, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for name, read in (("a.json", Path.read_bytes), ("b.json.gz", lambda p: gzip.decompress(p.read_bytes()))):
        expected = "[" + ", ".join(t for p, _, t in rows if p == f"d/{name}") + "]\n"
        assert read(tmp_path / "d" / name).decode() == expected


def test_dates_of_staged_documents_are_counted_without_reading_them(spark, sf_dir, tmp_path):
    docs = fixtures.index_docs(spark, sf_dir)
    jobs.stage_documents(docs.withColumn(jobs.STAGE_DATE, F.substring("source_file", 1, 10)), str(tmp_path / "stage"), by_date=True)
    staged = jobs.staged_documents(spark, str(tmp_path / "stage"))
    seen = []
    own_agg = type(staged.groupBy()).agg
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(staged.groupBy()), "agg", lambda self, *a: seen.append(own_agg(self, *a)) or seen[-1])
        found = jobs.document_dates(staged)
    assert found == jobs.document_dates(docs)
    assert "reporting_structure" not in explained(seen[0]).partition("ReadSchema")[2]
