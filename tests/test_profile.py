"""Analysis queries on small tables: edge cases, and plain SQL on the stored table."""

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from support import spark_bag

from disclosure_spark.fixtures import index_files, stored
from disclosure_spark.functions.scalars import percent
from disclosure_spark.operators import quality
from disclosure_spark.plans import explore, profile
from disclosure_spark.schemas import FLAT_NAMES, TABLE_COLUMNS
from disclosure_spark.sources.tables import NA_TEXTS, read_csv_export

COLUMNS = "source_file string, reporting_entity_name string, plan_id string, plan_name string, " \
    "plan_sponsor_name string, issuer_name string, allowed_amount_location string"


@pytest.fixture
def files(spark):
    def make(*rows):
        return spark.createDataFrame([r + (None,) * (7 - len(r)) for r in rows], COLUMNS)

    return make


def one(df):
    return df.first().asDict()


def test_empty_table(files):
    empty = files(("f",)).limit(0)
    assert one(explore.overview(empty)) == {"total_rows": 0, "source_files": 0}
    assert one(explore.allowed_share(empty)) == {"files_with_allowed_amount": 0, "pct": None}
    assert explore.entity_profile(empty).count() == 0
    assert [r["source_files"] for r in profile.allowed_presence(empty).collect()] == [0, 0]
    assert one(profile.rows_per_file_stats(empty))["mean_rows"] is None


def test_nulls_in_groups(files):
    df = files(("f1", None, "1", None), ("f1", "e", "1", "p"), ("f2", "e", None, "p"), (None, "e", "2", "p"))
    assert one(explore.overview(df)) == {"total_rows": 4, "source_files": 2}
    entity = {r["reporting_entity_name"]: r.asDict() for r in explore.entity_profile(df).collect()}
    assert entity[None]["total_rows"] == 1 and entity[None]["unique_plans"] == 0
    assert entity["e"] == {
        "reporting_entity_name": "e", "unique_plan_id": 2, "unique_plans": 1,
        "total_rows": 3, "pct_of_total": 75.0,
    }
    named = [r.asDict() for r in profile.entity_profile(df).collect()]
    assert named == [{"reporting_entity_name": "e", "rows": 2, "unique_plans": 2, "source_files": 2}]
    assert [tuple(r) for r in explore.top_plans(df).collect()] == [("p", 3), (None, 1)]
    assert [tuple(r) for r in profile.top_plans(df).collect()] == [("p", 3)]


def test_top_breaks_ties_by_name_and_keeps_n(files):
    df = files(*[("f", "e", "1", f"p{i:02d}") for i in range(12)])
    assert [r["plan_name"] for r in explore.top_plans(df).collect()] == [f"p{i:02d}" for i in range(10)]
    assert explore.top_plans(df, n=3).count() == 3


def test_shared_plan_ids_and_differences(files):
    df = files(
        ("f1", "e", "1", "p", "A", "A"), ("f2", "e", "1", "p", "B", "A"), ("f2", "e", "1", "p", None, "A"),
        ("f1", "e", "2", "p", "A", "B"), ("f1", "e", "2", "p", "A", "B"),
    )
    assert [tuple(r) for r in explore.shared_plan_ids(df).collect()] == [("1", 2, 2)]
    assert [tuple(r) for r in explore.sponsor_issuer_diff(df).collect()] == [
        ("A", "B", "f1"), ("A", "B", "f1"), ("B", "A", "f2"),
    ]


def test_empty_location_is_no_reference(files):
    row = ("e", "1", "p", "s", "i")
    df = files(("f1", *row, ""), ("f2", *row, "x"), ("f2", *row, None), ("f3", *row, None))
    assert {r["presence"]: (r["source_files"], r["pct"]) for r in profile.allowed_presence(df).collect()} == {
        "with_allowed": (1, 33.3), "without_allowed": (2, 66.7),
    }


def test_percent_rounds_half_up(spark):
    pairs = [(a, b) for b in (1, 3, 7, 8, 16, 400, 996, 10**12 + 1) for a in {0, 1, 2, b // 2, b - 1, b}]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for row in df.select("a", "b", percent(F.col("a"), F.col("b")).alias("p")).collect():
        exact = (Decimal(row["a"]) * 100 / Decimal(row["b"])).quantize(Decimal("0.1"), ROUND_HALF_UP)
        assert row["p"] == float(exact)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("bins", [30, 7])
def test_histogram_equals_numpy(spark, seed, bins):
    rng = np.random.default_rng(seed)
    values = rng.integers(1, [2, 11, 31, 50, 61, 1000][seed], size=500).tolist() + [1]
    df = spark.createDataFrame([(int(v),) for v in values], "v bigint")
    rows = profile.histogram(df, "v", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=bins)
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["bin_start"] for r in rows] == edges[:-1].tolist()
    assert [r["bin_end"] for r in rows] == edges[1:].tolist()


def test_stats_equal_pandas(spark, files):
    sizes = [1, 2, 3, 10]
    df = files(*[(f"f{n}",) for n in sizes for _ in range(n)])
    expected = pd.Series(sizes)
    assert one(profile.rows_per_file_stats(df)) == {
        "mean_rows": expected.mean(), "min_rows": 1, "max_rows": 10, "median_rows": expected.median(),
    }


def test_null_profile(files):
    df = files(("f", None), ("f", "e"), ("f", "e"))
    assert one(quality.null_profile(df, ["source_file", "reporting_entity_name"])) == {
        "source_file": 0, "reporting_entity_name": 1,
    }
    long = quality.null_profile_percent(df, ["source_file", "reporting_entity_name"]).collect()
    assert [tuple(r) for r in long] == [("reporting_entity_name", 1, 33.3)]
    checked = quality.not_null_check(df, ["source_file", "reporting_entity_name"]).collect()
    assert {r["column_name"]: r["passed"] for r in checked} == {
        "source_file": True, "reporting_entity_name": False,
    }


def test_preview(files):
    df = files(("b",), ("a",), ("c",))
    assert [r["source_file"] for r in explore.preview(df, keys=["source_file"], n=2).collect()] == ["a", "b"]


def write_csv(path, rows):
    header = ",".join(c.name.upper() for c in TABLE_COLUMNS)
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


ROW = (
    '2026-06-01_a_index.json,2026-06-01,2026-06-03 10:00:00.000,"Carrier, Inc",TPA,2026-05-30,1.0.0,'
    '"Plan ""A""",000123456,EIN,group,{sponsor},Acme,net,https://x,,,2026-06-03 20:19:00.123'
)


def test_csv_export(spark, tmp_path):
    path = write_csv(tmp_path / "export.csv", [ROW.format(sponsor="Acme")])
    df = read_csv_export(spark, path)
    assert dict(df.dtypes)["reporting_date"] == "date"
    assert dict(df.dtypes)["loaded_at"] == "timestamp_ntz"
    row = df.select("REPORTING_ENTITY_NAME", "plan_name", "plan_id", "allowed_amount_location").first()
    assert tuple(row) == ("Carrier, Inc", 'Plan "A"', "000123456", None)
    assert str(df.first()["loaded_at"]) == "2026-06-03 20:19:00.123000"


def test_csv_missing_values_are_those_of_pandas(spark, tmp_path):
    texts = [t for t in NA_TEXTS if t] + ["", '""', "nil", "Na", "NONE", " "]
    path = write_csv(tmp_path / "export.csv", [ROW.format(sponsor=t) for t in texts])
    expected = pd.read_csv(path)["PLAN_SPONSOR_NAME"].isna().tolist()
    found = [r["plan_sponsor_name"] is None for r in read_csv_export(spark, path).collect()]
    assert found == expected


def test_csv_with_another_header_is_refused(spark, tmp_path):
    path = tmp_path / "export.csv"
    names = [c.name.upper() for c in TABLE_COLUMNS]
    path.write_text(",".join(reversed(names)) + "\n" + ROW.format(sponsor="A") + "\n")
    with pytest.raises(Exception, match="header"):
        read_csv_export(spark, str(path)).collect()


def test_plain_sql_on_the_table(spark, sf_dir):
    """The functions say what one would write in SQL over the stored table."""
    table = index_files(spark, sf_dir)
    table.createOrReplaceTempView("index_files")
    same = {
        """SELECT count(1) AS total_rows, count(DISTINCT source_file) AS source_files
           FROM index_files""": explore.overview(table),
        """SELECT plan_name, count(*) AS total FROM index_files
           GROUP BY plan_name ORDER BY total DESC, plan_name LIMIT 10""": explore.top_plans(table),
        """SELECT reporting_entity_name, count(DISTINCT plan_id) AS unique_plan_id,
                  count(DISTINCT plan_name) AS unique_plans, count(*) AS total_rows,
                  CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS DOUBLE) AS pct_of_total
           FROM index_files GROUP BY reporting_entity_name""": explore.entity_profile(table),
        """SELECT count(DISTINCT source_file) AS files_with_allowed_amount,
                  CAST(round(count(DISTINCT source_file) * 100.0
                       / (SELECT count(DISTINCT source_file) FROM index_files), 1) AS DOUBLE) AS pct
           FROM index_files WHERE allowed_amount_location IS NOT NULL""": explore.allowed_share(table),
        """SELECT plan_id, count(DISTINCT source_file) AS files,
                  count(DISTINCT plan_sponsor_name) AS sponsor_names
           FROM index_files GROUP BY plan_id HAVING files > 1
           ORDER BY files DESC, plan_id LIMIT 10""": explore.shared_plan_ids(table),
    }
    for text, result in same.items():
        assert spark_bag(spark.sql(text)) == spark_bag(result)


@pytest.mark.parametrize(
    "query, columns",
    [
        (explore.overview, {"source_file"}),
        (explore.top_plans, {"plan_name"}),
        (explore.sponsor_nulls, {"source_file", "plan_sponsor_name"}),
        (explore.entity_profile, {"reporting_entity_name", "plan_id", "plan_name"}),
        (explore.allowed_share, {"source_file", "allowed_amount_location"}),
        (profile.rows_per_file_histogram, {"source_file"}),
        (quality.partition_counts, set()),
    ],
)
def test_queries_read_only_their_columns(spark, sf_dir, capsys, query, columns):
    query(index_files(spark, sf_dir)).explain()
    text = capsys.readouterr().out
    schemas = [s.split(">")[0] for s in text.split("ReadSchema: struct<")[1:]]
    read = {f.split(":")[0] for s in schemas for f in s.split(",") if f}
    assert read == columns
    assert "Exchange SinglePartition" not in text or "Window" not in text


def test_like_and_null_filters_reach_the_scan(spark, sf_dir, capsys):
    table = index_files(spark, sf_dir)
    explore.entity_like(table, "A-Inc").explain()
    explore.null_sponsor_files(table).explain()
    text = capsys.readouterr().out
    assert "StringContains(reporting_entity_name,A-Inc)" in text
    assert "IsNull(plan_sponsor_name)" in text


@pytest.mark.parametrize(
    "query",
    [lambda df: quality.null_profile(df, FLAT_NAMES), quality.not_null_check, quality.partition_counts],
)
def test_counts_can_come_from_footers(spark, sf_dir, capsys, query):
    """With aggregates pushed into the Parquet scan no data page is read."""
    path = stored(spark, sf_dir).table
    expected = spark_bag(query(spark.read.parquet(path)))
    settings = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        result = query(spark.read.parquet(path))
        result.explain()
        found = spark_bag(result)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "PushedAggregation: [COUNT" in capsys.readouterr().out
    assert found == expected
