"""File sinks: reports, summaries, samples, and keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from assetweave.operators.upsert import column_merge
from assetweave.session import materialize

TASKS_PER_BUCKET = 4
BUCKET = "_bucket"


def write_csv(report: DataFrame, path: str) -> None:
    """Report as CSV with a header in every part; quotes are doubled as spreadsheet readers expect."""
    report.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_json(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path)


def write_samples(samples: DataFrame, path: str) -> None:
    """Sample payloads with their record metadata, one JSON object on each line."""
    samples.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def write_change_log(events: DataFrame, path: str) -> None:
    """Append change events, laid out by kind."""
    events.write.mode("append").partitionBy("kind").parquet(path)


def write_report(lines: DataFrame, path: str, key: str = "row_key") -> None:
    """Report lines (key, hit, line_no, line) as text, by ranges of the key: the files in their order are the whole report."""
    order = [key, "hit", "line_no"]
    lines.repartitionByRange(key).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def write_table(rows: DataFrame, path: str, buckets: int, key: str = "row_key", tasks: int = TASKS_PER_BUCKET) -> None:
    """Keyed table as Parquet, partitioned by key hash, so that a merge only writes the partitions it must. A partition is
    written by up to `tasks` tasks, so its size does not bound the task's."""
    dealt = rows.withColumns({BUCKET: bucket_of(key, buckets), "_salt": F.pmod(F.xxhash64(key), F.lit(tasks))})
    dealt = dealt.repartition(buckets * tasks, BUCKET, "_salt").drop("_salt")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def merge_table(spark: SparkSession, path: str, incoming: DataFrame, buckets: int, key: str = "row_key", tasks: int = TASKS_PER_BUCKET) -> int:
    """Column-merge `incoming` into the table; only partitions with incoming keys are read and overwritten.

    `buckets` is the number the table was written with. The merged rows are landed before anything is overwritten, so a merge
    that fails while it computes leaves the table as it was. A new column has to be merged into all partitions at once
    or read with a schema that names it. Returns the number of partitions written.
    """
    touched = [r[0] for r in incoming.select(bucket_of(key, buckets)).distinct().collect()]  # at most `buckets` numbers
    if not touched:
        return 0
    stored = spark.read.parquet(path).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    write_table(materialize(column_merge(stored, incoming, key), "merged"), path, buckets, key, tasks)
    return len(touched)
