"""Helpers shared by the tests."""

from __future__ import annotations

import datetime
import json
from collections import Counter
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        files = f"{sf_dir}/{table}.parquet"
        files += "/*.parquet" if Path(files).is_dir() else ""
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    return con


def _value(v):
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def bag(columns: list[str], rows) -> Counter:
    """The rows as a bag, columns in the order of their names."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def spark_bag(df) -> Counter:
    return bag(df.columns, df.collect())


def sql_bag(con, sql: str) -> tuple[dict[str, str], Counter]:
    """Column types and rows of a query."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    return types, bag(list(types), result.fetchall())


def write_document(folder: Path, name: str, *documents: dict) -> Path:
    """One file with one document, or with an array of several, over many lines."""
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    content = documents[0] if len(documents) == 1 else list(documents)
    path.write_text(json.dumps(content, indent=1))
    return path


def plan(**values) -> dict:
    base = {
        "plan_name": "POS",
        "plan_id": "012345678",
        "plan_id_type": "EIN",
        "plan_market_type": "group",
        "plan_sponsor_name": "Acme",
        "issuer_name": "Acme",
    }
    return base | values


def document(*structures: dict, **values) -> dict:
    base = {
        "reporting_entity_name": "Carrier",
        "reporting_entity_type": "Third-Party Admin",
        "last_updated_on": "2026-06-01",
        "version": "1.0.0",
    }
    return base | {"reporting_structure": list(structures)} | values


def network(*numbers: int) -> list[dict]:
    return [{"description": f"net {i}", "location": f"https://files.example/{i}"} for i in numbers]
