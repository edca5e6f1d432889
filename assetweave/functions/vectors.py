"""Checks on base64 vectors of little-endian float32 values. Vectors stay text; only their length is checked."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from assetweave.functions.text import let, parse_integer, strip

DEFAULT_DIMENSION = 1024
BYTES_PER_VALUE = 4
BASE64_PATTERN = r"^[A-Za-z0-9+/]*={0,2}$"


def decoded_length(text: Column) -> Column:
    """Bytes of strictly valid base64, else null. Reads the length off the text; nothing is decoded.

    The pattern admits at most two closing `=`, so with a length divisible by four the text is valid base64.
    """
    size = F.char_length(text)
    padding = size - F.char_length(F.rtrim(text, F.lit("=")))
    quads = F.when((size % 4 == 0) & text.rlike(BASE64_PATTERN), (size / 4).cast("bigint"))
    return F.when((padding == 0) | (quads > 0), quads * 3 - padding)


def positive_dimension(col: Column, default: int = DEFAULT_DIMENSION) -> Column:
    parsed = parse_integer(col)
    return F.when(parsed > 0, parsed).otherwise(F.lit(default).cast("bigint"))


def is_valid(vector: Column, dimension: Column, default: int = DEFAULT_DIMENSION) -> Column:
    """Not blank, strict base64, and four bytes for each declared value."""
    size = let(strip(vector), lambda text: F.when(text != "", decoded_length(text)))
    return F.coalesce(size == positive_dimension(dimension, default) * BYTES_PER_VALUE, F.lit(False))


def status(vector: Column, is_string: Column, dimension: Column) -> Column:
    """Struct (status, bytes, dimension) of one vector value against an expected dimension."""
    null, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")

    def outcome(name: Column, size: Column, dim: Column) -> Column:
        return F.struct(name.alias("status"), size.alias("bytes"), dim.alias("dimension"))

    def measured(length: Column) -> Column:
        whole = F.when(length % BYTES_PER_VALUE == 0, (length / BYTES_PER_VALUE).cast("bigint"))
        label = F.when(length == dimension * BYTES_PER_VALUE, "valid").otherwise("length_invalid")
        return F.when(length.isNull(), outcome(F.lit("base64_invalid"), null, null)).otherwise(outcome(label, length, whole))

    def checked(text: Column) -> Column:
        return F.when(text == "", outcome(F.lit("blank"), zero, zero)).otherwise(let(decoded_length(text), measured))

    return (
        F.when(vector.isNull(), outcome(F.lit("missing"), null, null))
        .when(~is_string, outcome(F.lit("not_string"), null, null))
        .otherwise(let(strip(vector), checked))
    )
