"""Profile of a topic: totals, types, duplicates, and the state of the vectors in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from assetweave.functions import payload as J, search, text as X, vectors as V
from assetweave.operators.scan import arrival, places, rows_at
from assetweave.operators.upsert import WRITTEN

ITEM = "struct<type:string,vectorDimension:string,vector:variant>"
PROFILE_BODY = ("struct<type:string,assetId:string,asset_id:string,assert_id:string,vector:variant,"
                "vectorItem:struct<type:string,vector:variant>,"
                f"data:struct<type:string,assetId:string,asset_id:string,vectorList:array<{ITEM}>>>")
VECTOR_ALIASES = search.aliases("vector", search.PROFILE_ALIASES)


def type_label(empty_is_missing: bool) -> Column:
    """Type to count: undecodable and missing types have labels; the ingest also counts empty types as missing."""
    missing = F.col("msg_type").isNull()
    if empty_is_missing:
        missing = missing | (F.col("msg_type") == "")
    return (
        F.when(F.col("error").isNotNull(), "<invalid_json>")
        .when(missing, "<missing>")
        .otherwise(F.col("msg_type"))
    )


def type_counts(typed: DataFrame, empty_is_missing: bool = True) -> DataFrame:
    return typed.groupBy(type_label(empty_is_missing).alias("type")).agg(F.count(F.lit(1)).alias("messages"))


def _typed(value: Column) -> tuple[Column, Column]:
    """Text of a variant and whether it was a JSON string that does not itself hold an object or array."""
    text = F.try_variant_get(value, "$", "string")
    string = F.schema_of_variant(value) == "STRING"
    opened = J.opening(text).isin("{", "[") & J.is_json(X.strip(text))
    return text, F.coalesce(string & ~opened, F.lit(False))


def _item(is_object: Column, item: Column) -> Column:
    text, is_string = _typed(item["vector"])
    return F.struct(
        is_object.alias("is_object"),
        item["type"].alias("type"),
        item["vectorDimension"].alias("declared"),
        F.when(is_object, text).alias("vector"),
        is_string.alias("is_string"),
    )


def message_profile(typed: DataFrame, expected_dimension: int = V.DEFAULT_DIMENSION) -> DataFrame:
    """One row for each message: asset id, vector item, vector status, and the elements of the vector list.

    `typed` was decoded with `PROFILE_BODY`. Where the schema explains every mention of a name in the payload,
    its value is taken from the parsed columns; only the other payloads are searched.
    """
    payload, body = F.col("payload"), F.col("body")
    listing = body["data"]["vectorList"]
    names = F.col("_names")
    count = {
        "asset": J.mentions(names, *search.aliases("assetId")),
        "item": J.mentions(names, *search.VECTOR_ITEM_NAMES),
        "list": J.mentions(names, *search.VECTOR_LIST_NAMES),
        "vector": J.mentions(names, *VECTOR_ALIASES),
    }
    asset = F.coalesce(*[body[name] for name in ("assetId", "asset_id", "assert_id")], body["data"]["assetId"], body["data"]["asset_id"])
    rows = J.once(typed.withColumn("_names", J.without_long_strings(payload)), "_asset", asset).withColumns({f"_n_{name}": expr for name, expr in count.items()})
    n = {name: F.col(f"_n_{name}") for name in count}

    direct_vectors = F.size(F.filter(listing, lambda x: x["vector"].isNotNull()))
    first_vector = F.get(listing, F.lit(0))["vector"]
    known_vector = n["vector"] == direct_vectors  # without one in the first element a search finds none
    item_direct = (n["item"] == 1) & body["vectorItem"].isNotNull() & J.has_key(payload, "vectorItem")
    needs_vector = (n["vector"] > 0) & ~F.coalesce(known_vector, F.lit(False)) & ~(
        F.coalesce(item_direct & body["vectorItem"]["vector"].isNotNull(), F.lit(False)))
    asset_direct = (n["asset"] == 1) & J.searches_to_itself(F.col("_asset"))
    needs_asset = (n["asset"] > 0) & ~F.coalesce(asset_direct, F.lit(False))

    rows = rows.withColumns({
        "_found": search.search_fields(
            F.when(needs_asset | needs_vector, payload), [search.aliases("assetId"), VECTOR_ALIASES]),
        "_item_text": search.find_nested(
            F.when((n["item"] > 0) & ~F.coalesce(item_direct, F.lit(False)), payload), search.VECTOR_ITEM_NAMES, "object"),
        "_list_text": search.find_nested(
            F.when((n["list"] > 0) & ~F.coalesce((n["list"] == 1) & listing.isNotNull(), F.lit(False)), payload),
            search.VECTOR_LIST_NAMES, "array"),
    })
    found_item = F.from_json(F.col("_item_text"), "type string, vector variant")
    rows = J.once(rows, "_item", F.coalesce(F.when(item_direct, body["vectorItem"]), found_item))
    texts = F.from_json(F.col("_list_text"), "array<string>")
    searched = F.transform(texts, lambda t: _item(
        F.coalesce((J.opening(t) == "{") & J.is_json(t), F.lit(False)),
        F.from_json(F.when(J.opening(t) == "{", t), ITEM)))
    direct = F.when((n["list"] == 1) & F.col("_list_text").isNull(), F.transform(listing, lambda x: _item(x.isNotNull(), x)))
    rows = J.once(rows, "items", F.coalesce(direct, searched))

    item_text, item_string = _typed(F.col("_item")["vector"])
    first_text, first_string = _typed(first_vector)
    searched_hit = F.get("_found", F.lit(1))
    in_item = F.coalesce(F.col("_item")["vector"].isNotNull(), F.lit(False))
    raw = F.when(in_item, item_text).when(needs_vector, searched_hit["text"]).when(n["vector"] > 0, first_text)
    is_string = F.when(in_item, item_string).when(needs_vector, searched_hit["type"] == "string").otherwise(first_string)
    rows = rows.withColumns({
        "_raw": raw,
        "_is_string": F.coalesce(is_string, F.lit(False)),
        "asset_id": F.when(needs_asset, F.get("_found", F.lit(0))["text"]).when(n["asset"] > 0, F.col("_asset")),
    })
    status = V.status(F.col("_raw"), F.col("_is_string"), F.lit(expected_dimension).cast("bigint"))
    return rows.select(
        "partition", "offset", "payload",
        X.present(F.col("asset_id")).alias("asset_id"),
        F.col("_item").isNotNull().alias("has_item"),
        F.when(F.col("_item").isNotNull(), F.coalesce(F.col("_item")["type"], F.lit("<missing>"))).alias("item_type"),
        status.alias("vector"),
        "items",
    )


def scan_totals(typed: DataFrame, expected_type: str = "140") -> DataFrame:
    matched = F.col("error").isNull() & F.coalesce(F.col("msg_type") == expected_type, F.lit(False))
    return typed.agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(matched).alias("matched"),
        F.count_if(F.col("error").isNotNull()).alias("parse_errors"),
        F.count_if(F.col("error").isNull() & ~matched).alias("skipped"),
    )


def asset_counts(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("asset_id").isNotNull()).groupBy("asset_id").agg(F.count(F.lit(1)).alias("messages"))


def duplicate_stats(profile: DataFrame) -> DataFrame:
    """Counted per asset id first, nulls being one more group, so no set of ids is ever held in one place."""
    per_asset = profile.groupBy("asset_id").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("asset_id").isNotNull()
    totals = per_asset.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("matched"),
        F.count_if(known).alias("unique_assets"),
        F.count_if(known & (F.col("n") > 1)).alias("duplicated_assets"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing_asset"),
    )
    spare = F.col("matched") - F.col("unique_assets") - F.col("missing_asset")
    return totals.withColumn("duplicate_messages", F.greatest(F.lit(0).cast("bigint"), spare))


def top_duplicates(profile: DataFrame, top_n: int = 20) -> DataFrame:
    repeated = asset_counts(profile).where(F.col("messages") > 1)
    return repeated.orderBy(F.desc("messages"), "asset_id").limit(top_n)


def missing_asset_examples(profile: DataFrame, top_n: int = 20) -> DataFrame:
    missing = profile.where(F.col("asset_id").isNull())
    return missing.orderBy("partition", "offset").limit(top_n).select("partition", "offset", "payload")


def vector_item_counts(profile: DataFrame) -> DataFrame:
    return profile.groupBy("has_item", "item_type").agg(F.count(F.lit(1)).alias("messages"))


def vector_status_counts(profile: DataFrame) -> DataFrame:
    return profile.groupBy("vector.status", "vector.bytes", "vector.dimension").agg(F.count(F.lit(1)).alias("messages"))


def vector_list_totals(profile: DataFrame) -> DataFrame:
    objects = F.size(F.filter("items", lambda x: x["is_object"]))
    size = F.size("items")
    return profile.agg(
        F.count_if(F.col("items").isNotNull()).alias("list_present"),
        F.count_if(F.col("items").isNull()).alias("list_missing"),
        F.coalesce(F.sum(F.when(F.col("items").isNotNull(), size)), F.lit(0)).alias("items"),
        F.coalesce(F.sum(F.when(F.col("items").isNotNull(), size - objects)), F.lit(0)).alias("not_objects"),
    )


def list_items(profile: DataFrame, fallback_dimension: int = V.DEFAULT_DIMENSION) -> DataFrame:
    """One row for each object in a vector list, with declared dimension and vector status."""
    objects = profile.select("partition", "offset", "asset_id", F.posexplode("items").alias("pos", "item"))
    declared = X.parse_integer(F.col("item.declared"))
    expected = F.when(declared != 0, declared).otherwise(F.lit(fallback_dimension).cast("bigint"))
    rows = objects.where(F.col("item.is_object"))
    rows = rows.withColumn("_v", V.status(F.col("item.vector"), F.col("item.is_string"), expected))  # left out where nobody reads it
    return rows.select(
        "partition", "offset", "pos", "asset_id",
        F.coalesce("item.type", F.lit("<missing>")).alias("type"),
        declared.alias("declared"),
        "_v.status", "_v.bytes", "_v.dimension",
    )


def vector_type_counts(profile: DataFrame) -> DataFrame:
    """Items, messages and distinct asset ids for each list type.

    Items are reduced to one row for each (type, asset) before anything is counted per type; a type is
    counted once per message by its first item in the list.
    """
    objects = F.filter("items", lambda x: x["is_object"])
    types = F.transform(objects, lambda x: F.coalesce(x["type"], F.lit("<missing>")))
    rows = profile.withColumn("_types", types).select(
        "asset_id", F.explode(F.array_distinct("_types")).alias("type"), "_types"
    )
    rows = rows.withColumn("_n", F.size(F.filter("_types", lambda t: t == F.col("type"))))
    per_asset = rows.groupBy("type", "asset_id").agg(F.sum("_n").alias("items"), F.count(F.lit(1)).alias("messages"))
    return per_asset.groupBy("type").agg(
        F.sum("items").alias("items"),
        F.sum("messages").alias("messages"),
        F.count("asset_id").alias("assets"),
    )


def vector_dim_counts(items: DataFrame) -> DataFrame:
    label = F.coalesce(F.col("declared").cast("string"), F.lit("<missing>"))
    return items.groupBy("type", label.alias("dimension")).agg(F.count(F.lit(1)).alias("items"))


def vector_type_status(items: DataFrame) -> DataFrame:
    return items.groupBy("type", "status", "bytes", "dimension").agg(F.count(F.lit(1)).alias("items"))


def type_subtotal(items: DataFrame, wanted: str = "1") -> DataFrame:
    return items.where(F.col("type") == wanted).agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("status") == "valid").alias("valid")
    )


def field_paths(decoded: DataFrame) -> DataFrame:
    """Every flattened field path of all payloads with its type, and how many messages have it."""
    fields = decoded.where(F.col("payload").isNotNull()).select(F.explode(search.flatten_paths(F.col("payload"))).alias("f"))
    return fields.groupBy("f.path", "f.type").agg(F.count(F.lit(1)).alias("messages"))


def _cut(rows: DataFrame, limit: int, hit: Column, chunk_rows: int) -> int | None:
    """The arrival of the `limit`-th row for which `hit` holds; None if there are fewer.

    Counts by chunk of the arrival order find the chunk of the cut; only that chunk is ranked. So a large limit
    does not sort the topic, and it does not pass through one task.
    """
    chunk = F.expr(f"arrival div {chunk_rows}")
    sizes = rows.where(hit).groupBy(chunk.alias("_chunk")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    cut = before.where(F.col("before") < limit).orderBy(F.desc("_chunk")).limit(1).collect()
    if not cut:
        return None
    wanted = int(limit - cut[0]["before"])
    inside = rows.where(hit & (chunk == cut[0]["_chunk"])).select("arrival").orderBy("arrival").limit(wanted)
    last, seen = inside.agg(F.max("arrival"), F.count(F.lit(1))).first()
    return last if seen == wanted else None


def first_rows(df: DataFrame, limit: int, counted: Column | None = None, chunk_rows: int = 1_000_000) -> DataFrame:
    """Rows in arrival order up to the `limit`-th one for which `counted` holds (all rows by default)."""
    if limit <= 0:
        return df.limit(0)
    hit = F.coalesce(counted, F.lit(False)) if counted is not None else F.lit(True)
    last = _cut(df.withColumn("arrival", arrival()), limit, hit, chunk_rows)
    return df if last is None else df.where(arrival() <= last)


def first_written(statuses: DataFrame, limit: int, chunk_rows: int = 1_000_000) -> DataFrame:
    """Statuses of a guarded upsert (landed, see `upsert.guard_status`) of a run that stops with its `limit`-th written row.

    A verdict depends on earlier documents of its key only, so the verdicts of the whole topic hold for every run
    that stops earlier; the place of the stop comes from counts of written rows.
    """
    last = _cut(statuses, limit, F.col("status") == WRITTEN, chunk_rows)
    return statuses if last is None else statuses.where(F.col("arrival") <= last)


def first_match(documents: DataFrame, key: str = "row_key") -> DataFrame:
    """Earliest record of each key in scan order."""
    return rows_at(documents, documents.groupBy(key).agg(F.min(arrival()).alias("arrival")))


def first_by_key(table: DataFrame, limit: int, key: str = "row_key") -> DataFrame:
    """The first `limit` rows in the order of their keys, in which a table is scanned; no limit with 0. The cut is found on
    the keys alone."""
    if limit <= 0:
        return table
    cut = places(table.select(key), [key]).where(F.col("place") == limit).select(key).first()
    return table if cut is None else table.where(F.col(key).isNull() | (F.col(key) <= cut[0]))


def table_profile(table: DataFrame, key: str = "row_key", limit: int = 0) -> DataFrame:
    """(column, present): the number of rows, of rows without any cell and of those with a cell of each column, in one pass.

    The first row, without a `column`, has the totals alone, so a table of empty rows keeps them. With a limit only the
    first rows by key are looked at, and `truncated` says whether the limit was reached.
    """
    scanned = first_by_key(table, limit, key)
    columns = [c for c in table.columns if c != key]
    empty = F.coalesce(*[F.col(c).cast("string") for c in columns]).isNull()
    totals = scanned.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(empty).alias("empty_rows"),
        *[F.count(c).alias(f"_{n}") for n, c in enumerate(columns)],
    )
    cells = F.explode(F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("bigint").alias("present")), *[
        F.struct(F.lit(c).alias("column"), F.col(f"_{n}").alias("present")) for n, c in enumerate(columns)
    ])).alias("cell")
    rows = totals.select("row_count", "empty_rows", _truncated(limit), cells).select("row_count", "empty_rows", "truncated", "cell.*")
    return rows.where("column IS NULL OR present > 0")


def _truncated(limit: int) -> Column:
    reached = F.col("row_count") >= limit if limit > 0 else F.lit(False)
    return reached.alias("truncated")


def map_profile(table: DataFrame, cells: str = "cells", family: str = "cf") -> DataFrame:
    """The same for rows whose unknown columns sit in a map of qualified names."""
    names = table.select(F.explode(F.map_keys(cells)).alias("qualified"))
    return names.groupBy(X.strip_family(F.col("qualified"), family).alias("column")).agg(F.count(F.lit(1)).alias("present"))


def table_samples(table: DataFrame, size: int = 5, limit: int = 80, key: str = "row_key") -> DataFrame:
    """The first rows by key with their cells cut short. Every task keeps `size` rows at most."""
    rows = table.orderBy(key).limit(size)
    return rows.select(key, *[F.when(F.col(c).isNotNull(), X.truncate(F.col(c), limit)).alias(c) for c in table.columns if c != key])


def table_summary(table: DataFrame, size: int = 3, limit: int = 0, key: str = "row_key") -> DataFrame:
    """One row for the JSON summary of a table: totals, sorted columns, presence by column, samples, truncated flag.

    Apart from the samples, which are `size` rows, it holds one entry a column.
    """
    profiled = table_profile(table, key, limit)
    named = F.col("column").isNotNull()
    listed = F.sort_array(F.collect_list(F.when(named, F.struct("column", "present"))))
    totals = profiled.groupBy("row_count", "empty_rows", "truncated").agg(listed.alias("columns"))
    cells = [F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in sorted(table.columns) if c != key]
    samples = table_samples(table, size, key=key).select(F.struct(
        F.col(key).alias("row_key"), F.map_from_entries(F.filter(F.array(*cells), lambda e: e["value"].isNotNull())).alias("columns")
    ).alias("sample"))
    gathered = samples.agg(F.collect_list("sample").alias("samples")).select(
        F.array_sort("samples", lambda a, b: F.when(a["row_key"] < b["row_key"], -1).when(a["row_key"] > b["row_key"], 1).otherwise(0)).alias("samples")
    )
    columns = F.col("columns")
    return totals.join(gathered, F.lit(True)).select(  # one row each
        "row_count", "empty_rows", F.transform(columns, lambda c: c["column"]).alias("unique_columns"),
        F.map_from_entries(columns).alias("column_presence"), "samples", "truncated",
    )


def listing(counters: Sequence[DataFrame]) -> DataFrame:
    """All counters as one ordered list: (place, section, key, value, n). Sections follow in the given order, keys rise, and
    within a key counts fall; equal counts are ordered by their values. Each counter has (section, key, value, n)."""
    rows = counters[0].withColumn("_section", F.lit(0))
    for number, counter in enumerate(counters[1:], 1):
        rows = rows.unionByName(counter.withColumn("_section", F.lit(number)))
    return places(rows, ["_section", F.asc_nulls_first("key"), F.desc("n"), F.asc_nulls_first("value")]).drop("_section")


def counter(rows: DataFrame, section: str, value: str, key: str | None = None, n: Column | None = None) -> DataFrame:
    """Counts of a column, or of a column within each key, as `listing` takes them."""
    text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    counts = rows.where(F.col(value).isNotNull()).select(text(key).alias("key"), text(value).alias("value"), (n if n is not None else F.lit(1)).alias("_n"))
    return counts.groupBy("key", "value").agg(F.sum("_n").cast("bigint").alias("n")).select(F.lit(section).alias("section"), "key", "value", "n")
