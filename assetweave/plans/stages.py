"""Intermediate tables shared by the queries, each computed from the given tables and landed once in a session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from assetweave.operators import ingest, profile
from assetweave.session import materialize, new_path
from assetweave.sources.derived import load
from assetweave.sources.topic import stream_files

PARTITIONS = 4  # of every derived topic
PART_ROWS = 1_000_000  # of one micro-batch whose documents of a key meet in one task

_stages: dict[tuple[str, str, str], DataFrame] = {}


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stages:
        _stages[key] = materialize(build(), name)
    return _stages[key]


def forget() -> None:
    """Build every stage anew from now on."""
    _stages.clear()


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector topic with payload, error and resolved type."""
    def build() -> DataFrame:
        return ingest.resolve_type(ingest.decode_messages(load(spark, sf_dir, "vector_topic"))).drop("value", "text")

    return stage(spark, sf_dir, "decoded", build)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector documents of the matching messages, valid or with `reject_reason`."""
    def build() -> DataFrame:
        typed = decoded(spark, sf_dir).where(F.col("error").isNull() & ingest.matches_type("140"))
        return ingest.vector_documents(typed)

    return stage(spark, sf_dir, "documents", build)


def valid_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).where("reject_reason IS NULL").drop("reject_reason")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of each matching message of the vector topic."""
    def build() -> DataFrame:
        topic = ingest.decode_messages(load(spark, sf_dir, "vector_topic"), profile.PROFILE_BODY)
        typed = ingest.resolve_type(topic).where(F.col("error").isNull() & ingest.matches_type("140"))
        return profile.message_profile(typed)

    return stage(spark, sf_dir, "messages", build)


def in_parts(spark: SparkSession, sf_dir: str, name: str, run: Callable[[DataFrame], None], part_rows: int | None = None) -> None:
    """Let a topic arrive in its arrival order, partition by partition, and run a job over each part as a stream. Each run
    is a new start of the job that goes on from its checkpoint. With `part_rows` a partition arrives in ranges of its
    offsets of about so many rows, which bounds what one micro-batch has of a key. The topic is then dealt out to its parts in
    one pass, so that no part reads it again."""
    topic, path = load(spark, sf_dir, name), new_path(spark, f"{name}-parts")
    part, parts = F.lit(None).cast("int"), 0
    for partition in range(PARTITIONS):
        rows = topic.where(F.col("partition") == partition)
        wanted = -(-rows.count() // part_rows) if part_rows else 1
        cuts = rows.approxQuantile("offset", [n / wanted for n in range(1, wanted)], 0.1 / wanted) if wanted > 1 else []
        cuts = sorted({int(cut) for cut in cuts})
        place = sum(((F.col("offset") > cut).cast("int") for cut in cuts), F.lit(parts))
        part, parts = F.when(F.col("partition") == partition, place).otherwise(part), parts + len(cuts) + 1
    rows = topic.withColumn("_part", part)
    if parts > PARTITIONS:
        salt = F.pmod(F.xxhash64("offset"), F.lit(spark.sparkContext.defaultParallelism))
        rows.where("_part IS NOT NULL").repartition("_part", salt).write.partitionBy("_part").parquet(f"{path}-dealt")
        rows = spark.read.schema(rows.schema).parquet(f"{path}-dealt")
    for n in range(parts):
        rows.where(F.col("_part") == n).drop("_part").write.mode("append").parquet(path)
        run(stream_files(spark, path, topic.schema))
