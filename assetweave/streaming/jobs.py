"""Streaming jobs that stop at the end of the available input, and the settings their state needs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from assetweave.operators import status
from assetweave.operators.scan import HOT_ROWS
from assetweave.operators.upsert import column_merge, current_rows, guard_status
from assetweave.session import materialize, new_path
from assetweave.streaming.gates import VERSION_LIFETIME_MS

# State variables with a lifetime need the RocksDB provider. A processing-time operator asks for one more empty batch
# after every batch, so a run over the available input would never end with empty batches on.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
# State partitions of a new checkpoint for each core. Each of them costs its start, its commit and its files in every micro-batch,
# with or without rows, so there are no more of them than keep the cores busy.
_STATE_PARTITIONS = 2


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """Settings for a bounded streaming run; the session's own ones are put back."""
    most = _STATE_PARTITIONS * spark.sparkContext.defaultParallelism
    settings = _SETTINGS | {"spark.sql.shuffle.partitions": str(min(most, int(spark.conf.get("spark.sql.shuffle.partitions"))))}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def run_available(stream: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process what is there, exactly once, into a Parquet table, and return that table.

    Started again with the same folders the job goes on where it stopped.
    """
    spark = stream.sparkSession
    path, checkpoint = path or new_path(spark, name), checkpoint or new_path(spark, f"{name}-checkpoint")
    with stream_settings(spark):
        query = (
            stream.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def guard_in_batches(documents: DataFrame, root: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Guarded upsert of a stream with large micro-batches: (row_key, arrival, status) of each document.

    Every batch runs the batch operator on top of what earlier batches stored of its keys (key, version, time), so a
    hot key is split as in a batch job, where the state operator would hand it to one task. What a batch stores goes
    into a folder of its own, only for the keys it touched, so no table is rewritten and a repeated batch replaces
    its own output. Started again with the same `root` it goes on.
    """
    spark = documents.sparkSession
    root = root or new_path(spark, "guard")
    fields = ["version", "time"]

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(batch, "guard-batch")
        stored = None
        if batch_id:
            log = batch.sparkSession.read.parquet(f"{root}/guard").where(F.col("batch") < batch_id)
            touched = log.join(rows.select("row_key").distinct(), "row_key", "left_semi")
            latest = touched.groupBy("row_key").agg(F.max("batch").alias("batch"))
            stored = materialize(touched.join(latest, ["row_key", "batch"], "left_semi").drop("batch"), "guard-stored")
        statuses = materialize(guard_status(rows, stored, hot_rows=hot_rows, presence=fields), "guard-status")
        statuses.select("row_key", "arrival", "status").write.mode("overwrite").parquet(f"{root}/status/batch={batch_id}")
        written = current_rows(rows, statuses, fields)
        table = written if stored is None else column_merge(stored, written)
        table.write.mode("overwrite").parquet(f"{root}/guard/batch={batch_id}")

    narrow = documents.select("row_key", "partition", "offset", *fields)
    query = (
        narrow.writeStream.foreachBatch(apply).option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/status").drop("batch")


_CARRIED = ["kind", "partition", "offset", "time", "offline"]
_STORED = "doc_id string, version bigint, passed_at bigint, batch int"


def _gated(messages: DataFrame, root: str, put: Callable[[DataFrame, int], DataFrame], lifetime_ms: int, hot_rows: int) -> None:
    """Run the version gate over every micro-batch; `put` lands the passed messages of a batch and returns them.

    The batch operator runs on top of what earlier batches let pass, so the gate costs a shuffle of the batch and no call for
    each key, and a hot key is split as in a batch job. The highest version a batch lets pass of a document goes into a folder
    of that batch, with the time of the run; versions past their lifetime are not read. A version only falls after
    all higher ones have expired, so the highest one left is the stored one.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        now, rows = int(time.time() * 1000), materialize(batch, "gate-batch")
        stored = None
        if batch_id:
            log = batch.sparkSession.read.schema(_STORED).parquet(f"{root}/gate").where(F.col("batch") < batch_id)
            live = log.where(F.col("passed_at") > now - lifetime_ms).join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
            stored = materialize(live.groupBy("doc_id").agg(F.max("version").alias("version")), "gate-stored")
        passed = put(status.version_gate(rows, hot_rows, stored), batch_id)
        kept = passed.groupBy("doc_id").agg(F.max("version").alias("version")).withColumn("passed_at", F.lit(now).cast("bigint"))
        kept.write.mode("overwrite").parquet(f"{root}/gate/batch={batch_id}")

    query = (
        messages.writeStream.foreachBatch(apply).option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def gate_in_batches(messages: DataFrame, root: str | None = None, lifetime_ms: int = VERSION_LIFETIME_MS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The version gate of a stream with large micro-batches: passed messages as (doc_id, arrival, version). For many keys a batch;
    `gates.gate_stream` asks its state several times for each of them. Started again with the same `root` it goes on."""
    spark = messages.sparkSession
    root = root or new_path(spark, "gate")
    columns = "doc_id string, arrival bigint, version bigint"

    def put(passed: DataFrame, batch_id: int) -> DataFrame:
        path = f"{root}/passed/batch={batch_id}"
        passed.select("doc_id", "arrival", "version").write.mode("overwrite").parquet(path)
        return passed.sparkSession.read.schema(columns).parquet(path)

    _gated(messages.select("doc_id", "partition", "offset", "version"), root, put, lifetime_ms, hot_rows)
    return read_output(spark, root, "passed").select("doc_id", "arrival", "version")


def propagate_status(
    messages: DataFrame, programs: DataFrame, root: str, update_time: int, cache_prefix: str, lifetime_ms: int = VERSION_LIFETIME_MS,
    hot_rows: int = HOT_ROWS,
) -> None:
    """Gate a stream of usable status messages and send every batch's effects to all outputs below `root`.

    The gate runs once; `foreachBatch` lands its result and derives the outputs from it: change events, updates for each
    store, cache entries to delete, liveness markers. Each output of a batch is a folder named by the batch number, so a
    batch that is repeated after a failure replaces what it wrote before and changes nothing. Started again with the same
    `root` the job goes on after the last finished batch. Stops at the end of the available input.
    """
    def put(passed: DataFrame, batch_id: int) -> DataFrame:
        return write_status_batch(passed, batch_id, programs, root, update_time, cache_prefix)

    _gated(messages.select("doc_id", "version", *_CARRIED), root, put, lifetime_ms, hot_rows)


def write_status_batch(accepted: DataFrame, batch_id: int, programs: DataFrame, root: str, update_time: int, cache_prefix: str) -> DataFrame:
    """All outputs of one batch of accepted messages, which are returned as landed; written again they replace themselves."""
    def put(rows: DataFrame, output: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{root}/{output}/batch={batch_id}")
        return rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/{output}/batch={batch_id}")

    rows = put(accepted.select("doc_id", "version", *_CARRIED), "accepted")
    offline = put(status.offline_ids(rows), "offline")
    events = put(status.offline_events(rows, programs, update_time), "events")
    put(status.status_fanout(offline, programs, update_time), "stores")
    put(status.cache_keys(offline, cache_prefix), "cache_deletes")
    put(status.offline_heartbeat(events), "markers")
    return rows


def read_output(spark: SparkSession, root: str, output: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{output}").drop("batch")


def store_updates(spark: SparkSession, root: str) -> DataFrame:
    """The updates of all batches, one for each target and document. They only differ in the score, which rises."""
    rows = read_output(spark, root, "stores")
    keys = [c for c in rows.columns if c != "score"]
    return rows.groupBy(*keys).agg(F.max("score").alias("score")).select(*rows.columns)
