"""Exact copies by a stream with keyed state that never expires.

Arrivals carry the digest of the normalised text (all blanks deleted), the stable identifier, the length of the original
text and the locator of the content: the file and the row it lies in. A streaming aggregation keyed by digest, with its state
on disk (RocksDB) and no watermark, so without expiry, keeps for each digest the identifier and locator of the row that stays, and
the number of arrivals. On hits, that is digests with several arrivals, full bytes are compared: each copy's normalised text with
that of the row that stays, read by its locator. Digests with different bytes are grouped again by the bytes themselves.

Built-in expressions only. A hot group's copies are dealt out by a salt before they meet the text that stays. The
stream's output and all tables between lie in the shared folder.

Defined results: a null text is an empty one; all empty and blank texts are copies of each other; a null doc_id loses
against any other and groups like any row; repeated rows are copies of each other, and `keep_row` marks one of them; an
empty table gives no rows. Only doc_id and text are used; columns with the names of inner ones stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from assetweave.llm.scratch import files_for, free_name, land, new_folder

BLANKS = " \t\n\u000b\f\r"
SALT = 500  # copies of a group that meet the kept text in one task
BROADCAST_ROWS = 200_000  # locators: 200 bytes each, 40 MB at most
FILE, ROW = "_at_file", "_at_row"

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # A store leaves the memory of its executor when its part of a batch is done.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # No run goes on from another one's state, so no checksum files are kept beside its files.
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
}
# A single batch changes each key once, so the log of changes is all there is to keep; with more of them it would be played again.
_ONE_BATCH = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def located(docs: DataFrame, file: str = FILE, row: str = ROW) -> DataFrame:
    """The documents with file and row; a table that is not read from files is landed first."""
    try:
        return docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    except AnalysisException:
        return located(land(docs, "located"), file, row)


def normalised(text: str | Column) -> Column:
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), BLANKS, "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A landed table, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= rows else df


def keep_in_state(arrivals: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """(digest, group_size, keep) of each digest: the stream over the landed arrivals, and its last word on each key."""
    spark = arrivals.sparkSession
    folder, out = new_folder(spark, "arrivals"), new_folder(spark, "kept")
    many = arrivals.count()
    files = files_for(spark, many)
    arrivals.coalesce(files).write.parquet(folder)
    schema = spark.read.parquet(folder).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    best = F.struct("n_points", F.negative("doc_id").alias("order"), "doc_id", FILE, ROW)
    state = reader.parquet(folder).groupBy("digest").agg(F.count("*").alias("group_size"), F.max(best).alias("keep"))
    settings = _STATE if files_per_batch else _STATE | _ONE_BATCH
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        state.writeStream.outputMode("update").option("checkpointLocation", new_folder(spark, "state")).trigger(
            availableNow=True
        ).foreachBatch(
            lambda batch, number: batch.repartition(files).write.mode("overwrite").parquet(f"{out}/batch={number}")
        ).start().awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    if arrivals_empty(spark, out):
        return spark.read.schema(schema).parquet(folder).groupBy("digest").agg(F.count("*").alias("group_size"), F.max(best).alias("keep"))
    # A later batch repeats a key with a larger count, so the last word is the largest.
    words = spark.read.parquet(out).groupBy("digest").agg(F.max(F.struct("group_size", "keep")).alias("last"))
    return land(words.select("digest", "last.*"), "state", many)


def arrivals_empty(spark, out: str) -> bool:
    """Whether the stream had no batch at all."""
    try:
        spark.read.parquet(out)
    except AnalysisException:
        return True
    return False


def exact_groups(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None, salt: int = SALT
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, keep_row, file, row) of each document."""
    rows = located(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]))
    keyed = rows.select(
        "doc_id", FILE, ROW, F.length(F.coalesce("text", F.lit(""))).alias("n_points"), digest(normalised("text")).alias("digest")
    )
    arrivals = land(keyed, "keyed")
    many = arrivals.count()
    state = keep_in_state(arrivals, files_per_batch)
    several = state.where("group_size > 1")

    # Full bytes of all hits against the row that stays.
    hits = land(arrivals.join(several.select("digest", "group_size"), "digest").select(FILE, ROW, "group_size"), "hits", many)
    place = [FILE, ROW]
    read = rows.join(small(hits, BROADCAST_ROWS), place).select(
        "doc_id", *place, "group_size", normalised("text").alias("bytes"), F.length(F.coalesce("text", F.lit(""))).alias("n_points")
    ).withColumn("digest", digest(F.col("bytes")))
    salts = F.ceil(F.col("group_size") / salt).cast("int")
    stays = several.select(F.col("keep")[FILE].alias(FILE), F.col("keep")[ROW].alias(ROW), "digest")
    kept = read.drop("digest").join(stays, place).select(
        "digest", F.col("bytes").alias("kept_bytes"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")
    )
    dealt = read.withColumn("salt", F.pmod(F.xxhash64(*place), salts))
    differing = land(
        dealt.join(kept, ["digest", "salt"]).where("bytes <> kept_bytes").select("digest").distinct(), "differing", many
    )
    result = arrivals.join(state, "digest").select(
        "doc_id", *place, "digest", F.col("keep.doc_id").alias("keep_id"), "group_size",
        ((F.col("keep")[FILE] == F.col(FILE)) & (F.col("keep")[ROW] == F.col(ROW))).alias("keep_row"),
    )
    if not differing.isEmpty():
        # Different bytes under one digest: these few groups are made again, keyed by the bytes.
        mixed = read.join(F.broadcast(differing) if differing.count() <= BROADCAST_ROWS else differing, "digest")
        best = F.max(F.struct("n_points", F.negative("doc_id").alias("order"), "doc_id", FILE, ROW)).alias("keep")
        again = land(mixed.groupBy("digest", "bytes").agg(F.count("*").alias("size"), best), "again")
        split = mixed.join(again, ["digest", "bytes"]).select(
            "doc_id", *place, "digest", F.col("keep.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
            ((F.col("keep")[FILE] == F.col(FILE)) & (F.col("keep")[ROW] == F.col(ROW))).alias("keep_row"),
        )
        result = result.join(differing, "digest", "left_anti").unionByName(split)
    return result.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"), "keep_row", *place,
    )


def without_rows(whole: DataFrame, dropped: DataFrame, place: list[str], columns: list[str], few: int = BROADCAST_ROWS) -> DataFrame:
    """`whole` with the columns `columns`, without the rows at the places of the landed table `dropped`, broadcast if these are `few`."""
    return whole.join(small(dropped, few), place, "left_anti").select(*columns)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents without all copies but the one that stays, with all their columns, whatever these are called."""
    place = [free_name(docs.columns, FILE), free_name(docs.columns, ROW)]
    whole = located(docs, *place)
    groups = exact_groups(whole.drop(*place))
    dropped = land(groups.where("NOT keep_row").select(F.col(FILE).alias(place[0]), F.col(ROW).alias(place[1])), "dropped", whole.count())
    return without_rows(whole, dropped, place, docs.columns)
