"""Integer vectors from float ones, with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and has neither null nor non-finite components."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(~odd, F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """array<bigint> of floor(scale * x), x as double."""
    return F.transform(vector, lambda c: F.floor(c * float(scale)).cast("bigint"))


def integer_vectors(rows: DataFrame, scale: int, *others: str, vector: str = "embedding") -> DataFrame:
    """(vec_id, v) and the columns `others` of the rows whose vector is whole."""
    x = rows[vector].cast("array<double>")
    return rows.where(finite(x)).select(*[rows[c].alias(c) for c in ("vec_id", *others)], floored(x, scale).alias("v"))
