"""Every registered query against its DuckDB counterpart, on the smallest scale."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from assetweave.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(rows):
    return sorted(tuple("~" if v is None else str(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = oracle.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert plain(df.select(*columns).collect()) == plain([[row[i] for i in order] for row in result.fetchall()])


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_statuses_add_up(spark):
    totals = entry.queries()["scan_totals"](spark, SF_DIR).first()
    counts = entry.queries()["write_status_counts"](spark, SF_DIR).collect()
    assert totals["matched"] == sum(r["messages"] for r in counts)
