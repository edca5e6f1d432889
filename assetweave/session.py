"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"
# Settings of Parquet's writer with their defaults: bytes of a column's dictionary in a file, and the rows before the first
# look at the size of a page and of a row group.
DICTIONARY_BYTES = ("parquet.dictionary.page.size", 1 << 20)
CHECKED_ROWS = (("parquet.page.size.row.check.min", 100), ("parquet.block.size.row.check.min", 100))
UNCHECKED_BYTES, UNCHECKED_ROWS = 64 << 20, 10


def build_session(app: str = "assetweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; any keyword overrides a default.

    Executor count, memory and shuffle partitions are left to the cluster unless given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # A repeated member of a JSON object counts with its last value.
        "spark.sql.variant.allowDuplicateKeys": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: the one the cluster names, or one below the warehouse where none is set."""
    folder = spark.conf.get(SHARED_DIR_CONF, None) or spark.sparkContext.getCheckpointDir()
    return folder or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "assetweave-scratch")


def new_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Cuts lineage in a way that survives executor loss, and later passes read only the columns they use.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def expect_long_values(spark: SparkSession, longest: int) -> None:
    """Let what this session writes as Parquet hold values of up to `longest` bytes, each shared by many rows.

    With the writer's defaults a value beyond 1 MB is written anew for each of its rows, and 100 such rows are buffered before it
    first looks at their size. From here on a file keeps several values of that length once each, and the writer looks after about
    64 MB of them, or 10 rows: a first page of one row would show no use of a dictionary. The settings are the session's, as
    rows are written after a query has returned them; they stay as they are for short values, and what the session has set
    itself is never made worse.
    """
    def current(name: str, default: int) -> int:
        return int(spark.conf.get(name, None) or spark.conf.get(f"spark.hadoop.{name}", None) or default)

    name, default = DICTIONARY_BYTES
    wanted = min(4 * longest, 1 << 30)
    if wanted > current(name, default):
        spark.conf.set(name, str(wanted))
    for name, default in CHECKED_ROWS:
        rows = max(UNCHECKED_ROWS, UNCHECKED_BYTES // max(1, longest))
        if rows < current(name, default):
            spark.conf.set(name, str(rows))
