"""Every registered query against its SQL, over whole tables."""

import pytest
from pyspark.sql import functions as F
from support import TABLES, connect, spark_bag, sql_bag

import __spark_entry__ as registered
from disclosure_spark.fixtures import read_table

QUERIES = registered.library_queries()
SQL = registered.oracle_sql()
SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    types, expected = sql_bag(con, SQL[name])
    assert {n: SQL_TYPES[t] for n, t in result.dtypes} == types
    found = spark_bag(result)
    assert found == expected
    assert expected, "the data should exercise the query"


@pytest.fixture(scope="module")
def skewed_dir(spark, sf_dir, tmp_path_factory):
    """The same tables, with copies of one row of each making up a third of all rows."""
    folder = tmp_path_factory.mktemp("skewed")
    for table in TABLES:
        rows = read_table(spark, sf_dir, table)
        if table in ("lineitem", "documents"):
            # A row that has flat rows, and a blob that is selected.
            chosen = "l_discount = 0.05 AND l_quantity = 1" if table == "lineitem" else "doc_id = 1"
            hot = rows.filter(chosen).orderBy(*rows.columns).limit(1)
            times = F.sequence(F.lit(1), F.lit(rows.count() // 2))
            copies = hot.select("*", F.explode(times).alias("_copy")).drop("_copy")
            rows = rows.unionByName(copies).repartition(8)
        rows.write.parquet(str(folder / f"{table}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql_on_skewed_tables(spark, skewed_dir, name):
    con = connect(skewed_dir)
    _, expected = sql_bag(con, SQL[name])
    assert spark_bag(QUERIES[name](spark, skewed_dir)) == expected


def test_entry(spark):
    assert registered.entry(spark).count() == 10
