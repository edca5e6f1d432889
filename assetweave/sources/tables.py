"""Keyed wide tables and the document index as stored DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from assetweave.functions import text as X
from assetweave.operators.upsert import encode_cell


def table_scan(table: DataFrame, columns: Sequence[str] = (), limit: int = 0, key: str = "row_key") -> DataFrame:
    """Chosen columns of a table; only these reach the file scan."""
    rows = table.select(key, *columns) if columns else table
    return rows.limit(limit) if limit > 0 else rows


def read_table(spark: SparkSession, path: str, columns: Sequence[str] = (), limit: int = 0) -> DataFrame:
    return table_scan(spark.read.parquet(path), columns, limit)


def cells_to_columns(rows: DataFrame, columns: Sequence[str], cells: str = "cells", family: str = "cf") -> DataFrame:
    """Rows with a map of `family:qualifier` to bytes or text, as one text column for each wanted qualifier."""
    def cell(name: str) -> Column:
        value = F.try_element_at(F.col(cells), F.lit(f"{family}:{name}"))
        return F.make_valid_utf8(value.cast("string")).alias(name)

    return rows.select("row_key", *[cell(c) for c in columns])


def row_cells(rows: DataFrame, key: str = "row_key", family: str = "cf") -> DataFrame:
    """Rows as they are put into a table: (key, cells), a map of `family:column` to the encoded cell, without absent ones."""
    cells = F.array(*[
        F.struct(F.lit(f"{family}:{c}").alias("key"), encode_cell(rows, c).alias("value")) for c in rows.columns if c != key
    ])
    return rows.select(key, F.map_from_entries(F.filter(cells, lambda e: e["value"].isNotNull())).alias("cells"))


def listed_cells(rows: DataFrame, cells: str = "cells", family: str = "cf", key: str = "row_key") -> DataFrame:
    """(key, column, value) of every cell, the columns without their family."""
    listed = rows.select(key, F.explode(cells).alias("qualified", "value"))
    return listed.select(key, X.strip_family(F.col("qualified"), family).alias("column"), "value")


def qualifiers(rows: DataFrame, cells: str = "cells") -> DataFrame:
    """All qualifiers in use."""
    return rows.select(F.explode(F.map_keys(cells)).alias("name")).select(X.after_colon(F.col("name")).alias("name")).distinct()
