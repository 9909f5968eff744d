"""One local session for all tests, and a comparison with DuckDB."""

from __future__ import annotations

import decimal
import os
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, (bytes, str)):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    return str(v)


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def duck():
    """(sql, folder of tables) -> (sorted column names, sorted rows)."""

    def run(sql: str, folder: str = DATA):
        con = duckdb.connect()
        for p in Path(folder).glob("*.parquet"):
            src = f"{p}/*.parquet" if p.is_dir() else str(p)
            con.execute(f"CREATE VIEW {p.name.removesuffix('.parquet')} AS SELECT * FROM '{src}'")
        cur = con.execute(sql)
        names = [x[0] for x in cur.description]
        return sorted(names), sorted_rows(names, cur.fetchall())

    return run


@pytest.fixture(scope="session")
def same_as_sql(duck):
    def check(df, sql: str, folder: str = DATA) -> None:
        names, want = duck(sql, folder)
        assert sorted(df.columns) == names
        assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == want

    return check
