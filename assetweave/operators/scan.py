"""Running aggregates over the arrival order of each key, safe for keys that hold a large share of all rows.

A window puts all rows of one key into one task. Here a key with more than `hot_rows` rows is cut into
chunks of its arrival order, each at most `hot_rows` long. Every chunk is scanned on its own; the totals of
the chunks are scanned per key, and that carry is joined back. Maximum and sum are associative, so the
result equals the one-window result for every key. Other keys keep the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from assetweave.session import expect_long_values, materialize

HOT_ROWS = 1_000_000
SHARE_ROWS = 10_000
PARTITION_BITS = 48

Runner = Callable[[DataFrame, dict[str, tuple[str, Column]]], DataFrame]
_AGGREGATES = {"max": F.max, "sum": F.sum}


def arrival(partition: str = "partition", offset: str = "offset") -> Column:
    """Place in the arrival order as one number: partition first, then offset. Stored rows come before all."""
    return F.shiftleft(F.col(partition).cast("bigint"), PARTITION_BITS) + F.col(offset)


def rows_at(df: DataFrame, places: DataFrame) -> DataFrame:
    """The records at the given places of the arrival order. Finding the places on narrow columns first means that
    wide payloads are never sorted, and are shuffled only when the places are too many to broadcast."""
    return df.withColumn("arrival", arrival()).join(places.select("arrival"), "arrival", "left_semi").drop("arrival")


def _plain(key: str, order: str) -> Runner:
    window = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def run(df: DataFrame, wanted: dict[str, tuple[str, Column]]) -> DataFrame:
        return df.withColumns({out: _AGGREGATES[how](expr).over(window) for out, (how, expr) in wanted.items()})

    return run


def _chunked(key: str, order: str) -> Runner:
    inside = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    def run(df: DataFrame, wanted: dict[str, tuple[str, Column]]) -> DataFrame:
        totals = df.groupBy(key, "_chunk").agg(*[_AGGREGATES[how](e).alias(f"_t_{out}") for out, (how, e) in wanted.items()])
        carry = totals.select(key, "_chunk", *[
            _AGGREGATES[how](f"_t_{out}").over(across).alias(f"_c_{out}") for out, (how, _) in wanted.items()
        ])
        local = df.withColumns({f"_l_{out}": _AGGREGATES[how](e).over(inside) for out, (how, e) in wanted.items()})
        both = local.join(carry, [key, "_chunk"], "left")
        for out, (how, _) in wanted.items():
            parts = (F.col(f"_c_{out}"), F.col(f"_l_{out}"))
            merged = F.greatest(*parts) if how == "max" else F.coalesce(parts[0] + parts[1], *parts)
            both = both.withColumn(out, merged).drop(f"_c_{out}", f"_l_{out}")
        return materialize(both, "chunk-scan")

    return run


def scan_by_key(
    df: DataFrame,
    key: str,
    body: Callable[[DataFrame, Runner], DataFrame],
    order: str = "arrival",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Apply `body(rows, run)`; `run` adds running aggregates over the rows before each row of its key.

    `df` should be a landed table: it is read once to find hot keys and once to scan. `order` must be unique
    within a key, with consecutive values for consecutive arrivals of one partition, so that a chunk of
    `hot_rows` consecutive values never holds more rows than that.
    """
    # At most rows / hot_rows keys can be hot, which bounds both the table and its broadcast.
    hot = materialize(df.groupBy(key).count().where(F.col("count") > hot_rows).select(key), "hot-keys")
    if hot.isEmpty():
        return body(df, _plain(key, order))
    hot = F.broadcast(hot)
    cold_rows = body(df.join(hot, key, "left_anti"), _plain(key, order))
    chunk = F.expr(f"{order} div {int(hot_rows)}")
    hot_part = df.join(hot, key, "left_semi").withColumn("_chunk", chunk)
    return cold_rows.unionByName(body(materialize(hot_part, "hot-rows"), _chunked(key, order)).drop("_chunk"))


def longest_value(df: DataFrame) -> int:
    """Bytes of the longest text in any column."""
    texts = [F.max(F.octet_length(f.name)) for f in df.schema.fields if f.dataType.typeName() == "string"]
    return max([0, *(n for n in df.agg(*texts).first() if n is not None)]) if texts else 0


def fetch_shared(rows: DataFrame, shared: DataFrame, key: str, spread: str, share_rows: int = SHARE_ROWS) -> DataFrame:
    """Inner join of `rows` with `shared`, which is landed, has one row a key, and may hold very long values.

    The rows always stream past the one shared row of their key: with the rows on the other side of the join, all results
    of a key would be held in memory before the first is passed on. A key with more than `share_rows` rows is dealt out by
    the column `spread` over tasks of its own, for its results are long where its rows are not, so their size shows no skew.
    Whoever writes the rows writes a long value once for each of them, so the session's writer is told how long they get.
    """
    expect_long_values(rows.sparkSession, longest_value(shared))
    rows = materialize(rows, "sharing-rows")
    # At most rows / share_rows keys, which bounds both the table and its broadcast.
    counts = rows.groupBy(key).count().where(F.col("count") > share_rows)
    hot = materialize(counts.select(key, F.ceil(F.col("count") / share_rows).alias("_shares")), "shared-keys")
    tasks = hot.agg(F.sum("_shares")).first()[0]
    if tasks is None:
        return rows.hint("merge").join(shared, key)
    hot = F.broadcast(hot)
    cold = rows.join(hot, key, "left_anti").hint("merge").join(shared, key)
    dealt = rows.join(hot, key).withColumn("_share", F.pmod(F.xxhash64(spread), F.col("_shares"))).drop("_shares")
    copies = shared.join(hot, key).withColumn("_share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_shares") - 1))).drop("_shares")
    dealt, copies = (df.repartition(int(tasks), key, "_share") for df in (dealt, copies))
    return cold.unionByName(dealt.hint("merge").join(copies, [key, "_share"]).drop("_share"))


def places(df: DataFrame, order: Sequence[str | Column], name: str = "place") -> DataFrame:
    """Add the place of each row, from 1, in the total order of `order`, without a window over all rows.

    Rows are dealt out by ranges of the order and sorted there; a row's place is its place in its part plus the rows of
    the parts before, one number a part. The sorted parts are landed, so part and place never disagree. Rows that
    are equal in `order` get places in any order.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_inside": inside})
    parts = materialize(parts, "places")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # one row a part
    return parts.join(F.broadcast(sizes), "_part").withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_inside", "_before")
