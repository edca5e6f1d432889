from __future__ import annotations

import glob
import os

import duckdb
import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def oracle(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="session")
def docs(spark):
    """Build a documents table with extra columns whose names clash with inner ones."""

    def build(rows, schema="doc_id long, text string"):
        df = spark.createDataFrame(rows, schema)
        from pyspark.sql import functions as F

        return df.withColumns({
            "lang": F.lit("en"), "source": F.concat(F.lit("s"), F.col("doc_id") % 3), "n_chars": F.length("text").cast("long"),
            "ids": F.lit("x"), "digest": F.lit("y"), "spans": F.lit(1), "key": F.lit(None).cast("string"),
        })

    return build


@pytest.fixture(scope="session")
def same_rows():
    def check(df, result):
        names = [d[0] for d in result.description]
        columns = sorted(df.columns)
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        plain = lambda rows: sorted(tuple("~" if v is None else str(v) for v in row) for row in rows)
        assert plain(df.select(*columns).collect()) == plain([[row[i] for i in order] for row in result.fetchall()])

    return check
