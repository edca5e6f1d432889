"""Folders and partition counts for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"
FILE_ROWS = 20_000


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one the cluster names, or below the warehouse where none is set."""
    shared = spark.conf.get(SHARED, None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def free_name(columns: list[str], wish: str) -> str:
    """`wish`, with as many underscores before it as no column has."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def files_for(spark: SparkSession, rows: int) -> int:
    """As many files as the cluster has cores, or one for each `FILE_ROWS` rows."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS))


def land(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write `df` once in a shared folder and read it back, so that lost executors cost a read, not the lineage.

    A table of narrow rows that has at most `rows` of them gets no more files than `files_for`. On a local file system every
    file costs its executor some processes, which set permissions. Where the rows are few but dear to make, `df` is dealt
    out by repartition(files_for(...)) instead, which leaves the work before it in as many tasks as it has.
    """
    spark = df.sparkSession
    path, schema = new_folder(spark, name), df.schema
    if rows is not None:
        df = df.coalesce(files_for(spark, rows))
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def partitions_for(df: DataFrame) -> int:
    """As many partitions as a shuffle of the session has; operators that deal out whole texts use it."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
