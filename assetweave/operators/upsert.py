"""Keyed upserts: column merge, last present value per column, and the version-guarded upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from assetweave.functions.text import is_present, parse_time, parse_version, version_key
from assetweave.operators.scan import HOT_ROWS, Runner, arrival, fetch_shared, rows_at, scan_by_key
from assetweave.session import materialize

WRITTEN = "written"
INVALID = "skipped_invalid_payload"
MISSING_VERSION = "skipped_missing_incoming_version"
OLD_VERSION = "skipped_old_version"
OLD_TIME = "skipped_old_time"


def encode_cell(df: DataFrame, column: str) -> Column:
    """Cell text: JSON of nested values, plain text of others; null stays absent."""
    kind = df.schema[column].dataType.typeName()
    return F.to_json(column) if kind in ("struct", "array", "map") else F.col(column).cast("string")


def column_merge(stored: DataFrame, incoming: DataFrame, key: str = "row_key", cells: DataFrame | None = None, ref: str = "asset_id") -> DataFrame:
    """Put only the present columns of `incoming`; every other stored value stays. One row per key on each side.

    With `cells` the rows of `incoming` are (key, ref) alone and their values stand in `cells`, landed and one row a ref. They are
    fetched after the keys have met, so a long value of many rows is never shuffled once for each of them.
    """
    names = incoming.columns if cells is None else [c for c in cells.columns if c != ref]
    columns = list(dict.fromkeys([c for c in [*stored.columns, *names] if c != key]))

    def put(rows: DataFrame, old: dict[str, str], new: dict[str, str]) -> DataFrame:
        return rows.select(key, *[F.coalesce(*[F.col(side[c]) for side in (new, old) if c in side]).alias(c) for c in columns])

    old = {c: f"old.{c}" for c in stored.columns if c != key}
    if cells is None:
        merged = stored.alias("old").join(incoming.alias("new"), key, "full_outer")
        return put(merged, old, {c: f"new.{c}" for c in names if c != key})
    kept = stored.select(key, *[F.col(c).alias(f"_old_{c}") for c in old])
    met = materialize(kept.join(incoming.select(key, F.col(ref).alias("_ref")), key, "full_outer"), "merge-keys")
    old = {c: f"_old_{c}" for c in old}
    fetched = fetch_shared(met, cells.select(F.col(ref).alias("_ref"), *[F.col(c).alias(f"_new_{c}") for c in names]), "_ref", key)
    alone = met.join(cells.select(F.col(ref).alias("_ref")), "_ref", "left_anti").select(met.columns)
    both = fetched.unionByName(alone, allowMissingColumns=True)
    return put(both, old, {c: f"_new_{c}" for c in names})


def last_present(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], place: str) -> DataFrame:
    """For each key and column the last non-null value in the order of the number `place`, unique within a key.

    The winning places are found on numbers, combined before the shuffle, so skew is harmless; only winning rows,
    at most one a column and key, are fetched and put together.
    """
    rows = materialize(rows, "last-present")
    wins = rows.groupBy(*keys).agg(*[F.max(F.when(F.col(c).isNotNull(), F.col(place))).alias(f"_win_{c}") for c in columns])
    places = F.explode(F.array_compact(F.array_distinct(F.array(*[F.col(f"_win_{c}") for c in columns]))))
    chosen = wins.withColumn(place, places).join(rows, [*keys, place])
    gathered = chosen.groupBy(*keys, *[f"_win_{c}" for c in columns]).agg(F.collect_list(F.struct(place, *columns)).alias("_rows"))

    def winning(column: str) -> Column:
        return F.get(F.filter("_rows", lambda r: r[place] == F.col(f"_win_{column}")), F.lit(0))[column].alias(column)

    return gathered.select(*keys, *map(winning, columns))


def _guard(rows: DataFrame, run: Runner) -> DataFrame:
    """Status of each row from running aggregates only; no per-key loop.

    The stored time behaves as a running maximum that restarts: a written row whose time cannot be read
    clears it, and a row with a higher version replaces it. Counting the restarts numbers the stretches,
    and the maximum of (stretch, time) over earlier rows is the stored time. The stored version is a running
    maximum too, from the first row on that has a readable version and passes the time test.
    """
    iv, it, timed = F.col("_iv"), F.col("_it"), F.col("_timed")

    def stored_time(df: DataFrame, restart: Column, time: Column, name: str) -> DataFrame:
        df = df.withColumns({"_restart": F.coalesce(restart, F.lit(False)).cast("int"), "_seen": time})
        df = run(df, {"_n": ("sum", F.col("_restart"))})
        stretch = F.struct((F.coalesce("_n", F.lit(0)) + F.col("_restart")).alias("n"), F.col("_seen").alias("t"))
        df = run(df.withColumn("_stretch", stretch), {"_m": ("max", F.col("_stretch"))})
        return df.withColumn(name, F.col("_m")["t"]).drop("_restart", "_seen", "_n", "_stretch", "_m")

    rows = stored_time(rows, timed & it.isNull(), it, "_first_et")
    opens = iv.isNotNull() & ~F.coalesce(it < F.col("_first_et"), F.lit(False))
    rows = run(rows.withColumn("_opens", opens.cast("int")), {"_opened": ("max", F.col("_opens"))})
    counted = F.when((F.coalesce("_opened", F.lit(0)) == 1) | (F.col("_opens") == 1), iv)
    rows = run(rows.withColumn("_counted", counted), {"_ev": ("max", F.col("_counted"))})

    ev = F.col("_ev")
    higher = F.coalesce(iv > ev, F.lit(False))
    live = ev.isNull() | F.coalesce(iv >= ev, F.lit(False))
    rows = stored_time(rows, live & timed & (higher | it.isNull()), F.when(live & timed, it), "_et")

    status = (
        F.when(ev.isNotNull() & iv.isNull(), MISSING_VERSION)
        .when(iv < ev, OLD_VERSION)
        .when(~higher & (it < F.col("_et")), OLD_TIME)
        .otherwise(WRITTEN)
    )
    return rows.withColumn("status", status).drop("_first_et", "_opens", "_opened", "_counted", "_ev", "_et")


def guard_status(
    documents: DataFrame,
    stored: DataFrame | None = None,
    key: str = "row_key",
    hot_rows: int = HOT_ROWS,
    presence: Sequence[str] = (),
) -> DataFrame:
    """(key, arrival, status) of each valid document, applied one after another on top of `stored`.

    Reads only the key, version and time columns, and whether the `presence` columns are null: these come
    back as booleans `_has_<column>`. A stored row acts as the first arrival of its key.
    """
    flags = [f"_has_{c}" for c in presence]

    def narrow(df: DataFrame, place: Column, seed: bool) -> DataFrame:
        has = [(F.lit(False) if seed else F.col(c).isNotNull()).alias(f) for c, f in zip(presence, flags)]
        return df.select(
            *has,
            key,
            place.alias("arrival"),
            F.lit(seed).alias("_seed"),
            version_key(parse_version(F.col("version"))).alias("_iv"),
            parse_time(F.col("time")).alias("_it"),
            is_present(F.col("time")).alias("_timed"),
        )

    rows = narrow(documents, arrival(), False)
    if stored is not None:
        touched = stored.join(documents.select(key).distinct(), key, "left_semi")
        rows = rows.unionByName(narrow(touched, F.lit(-1).cast("bigint"), True))
    scanned = scan_by_key(rows, key, _guard, hot_rows=hot_rows)
    return scanned.where(~F.col("_seed")).select(key, "arrival", "status", *flags)


def current_rows(documents: DataFrame, statuses: DataFrame, columns: Sequence[str], key: str = "row_key") -> DataFrame:
    """Rows after all written documents: for each key and column the last present value.

    `statuses` comes from `guard_status(..., presence=columns)`. The winning arrivals are found on these narrow
    rows, as numbers and combined before the shuffle; only then are the winning payloads fetched.
    """
    wins = statuses.where(F.col("status") == WRITTEN).groupBy(key).agg(*[
        F.max(F.when(F.col(f"_has_{c}"), F.col("arrival"))).alias(f"_win_{c}") for c in columns
    ])
    places = F.explode(F.array_compact(F.array_distinct(F.array(*[F.col(f"_win_{c}") for c in columns]))))
    payload = documents.select(arrival().alias("arrival"), *columns)
    chosen = wins.withColumn("arrival", places).join(payload, "arrival")
    return chosen.groupBy(key).agg(*[
        F.max(F.when(F.col("arrival") == F.col(f"_win_{c}"), F.col(c))).alias(c) for c in columns
    ])


def guarded_upsert(
    documents: DataFrame,
    columns: Sequence[str],
    stored: DataFrame | None = None,
    key: str = "row_key",
    hot_rows: int = HOT_ROWS,
    operate_time: str | None = None,
) -> DataFrame:
    """The table after the guarded upsert of `documents` (a landed table) on top of `stored`.

    With `operate_time` every written row carries the time of the run in a column of that name.
    """
    statuses = guard_status(documents, stored, key, hot_rows, presence=columns)
    written = current_rows(documents, statuses, columns, key)
    if operate_time is not None:
        written = written.withColumn("operate_time", F.lit(operate_time))
    return written if stored is None else column_merge(stored, written, key)


def latest_by_version(documents: DataFrame, columns: Sequence[str], key: str = "row_key") -> DataFrame:
    """Latest record of each key by version, then time, then arrival."""
    rank = F.struct(version_key(parse_version(F.col("version"))), parse_time(F.col("time")), arrival().alias("arrival"))
    places = documents.groupBy(key).agg(F.max(rank).alias("_top")).select("_top.arrival")
    return rows_at(documents, places).select(key, *columns)
