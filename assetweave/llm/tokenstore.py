"""Token ids as Parquet list columns, in document order, for selective reads.

Ids are dictionary-encoded (a page keeps small indexes into the ids it uses), document ids and counts delta-encoded.
Row groups and pages have fixed sizes, and pages carry column and offset indexes, so that a read of a few documents or
of the counts alone touches those pages only. Files follow each other in ascending document order: rows are dealt out by
ranges of (doc_id, hash of the text), so equal ids cannot fill one file, and sorted inside each file.

Defined results: a null text is an empty one and keeps its end id; null document ids come first; repeated ids keep
every row; an empty table gives an empty store with its schema. Other columns are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from assetweave.llm.bpe import encode_column
from assetweave.llm.scratch import partitions_for
from assetweave.llm.streams import arrow_stream

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
SCHEMA = "doc_id long, n_tokens long, ids array<int>"


def crc32_column(ids: str | Column) -> Column:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    def crc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            data = memoryview(np.ascontiguousarray(batch.flatten().to_numpy(zero_copy_only=False), "<i4")).cast("B")
            ends = np.cumsum(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) * 4
            yield pa.array([zlib.crc32(data[i:j]) for i, j in zip([0, *ends.tolist()], ends.tolist())], pa.int64())

    return arrow_stream(crc, "bigint")(ids)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode `text` of each document and write (doc_id, n_tokens, ids) below `path`."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    ranged = texts.repartitionByRange(partitions_for(docs), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    ids = ranged.select("doc_id", encode_column(docs.sparkSession, "text", tokenizer, end).alias("ids"))
    options = {
        "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes, "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "true", "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#n_tokens": "false", "compression": "zstd",
    }
    ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids").write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids); a filter on doc_id skips row groups and pages, and unused columns are not read."""
    return spark.read.schema(SCHEMA).parquet(path)


def with_starts(spark: SparkSession, path: str, *more: Column) -> DataFrame:
    """(doc_id, start, n_tokens, more...): start counts the ids of all documents before this one.

    The files are in document order, so a start is the total of the files before plus a running sum inside the file.
    The totals are one row a file.
    """
    file = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("file")
    rows = read_tokens(spark, path).select("doc_id", "n_tokens", file, F.col("_metadata.row_index").alias("row"), *more)
    totals = read_tokens(spark, path).select("n_tokens", file).groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    running = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    start = (F.col("base") + F.col("inside")).alias("start")
    names = [c for c in rows.columns if c not in ("doc_id", "n_tokens", "file", "row")]
    return running.join(bases, "file").select("doc_id", start, "n_tokens", *names)
