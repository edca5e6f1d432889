"""Chart descriptions and chart contents: upserts, withdrawals, and the index that ties contents to charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetweave.functions import payload as J, text as X
from assetweave.operators.scan import HOT_ROWS, Runner, arrival, scan_by_key
from assetweave.operators.upsert import last_present
from assetweave.session import materialize

# Optional columns of a chart description and the members they come from.
CHART_COLUMNS = {
    "chart_name": "chartName",
    "desc": "desc",
    "chart_category": "chartCategory",
    "chart_type": "chartType",
    "length": "length",
    "content_time_span": "contentTimeSpan",
    "metric_time_span": "metricTimeSpan",
    "execution_cycle": "executionCycle",
    "execution_time": "executionTime",
    "is_recommend": "isRecommend",
    "is_valid": "isValid",
}
# Members of a content class and the columns that list them.
CLASS_COLUMNS = {
    "firstclass_name": "firstClassName",
    "firstclass_code": "firstClassCode",
    "secondclass_name": "secondClassName",
    "secondclass_code": "secondClassCode",
}
# Optional columns of a chart content and the members they come from.
CONTENT_COLUMNS = {"content_type": "contentType", "rank": "rank", "chart_score": "chartScore", "is_shield": "isShield"}
# Fixed value: prefix of the row keys of the index.
INDEX_PREFIX = "__chart_index__"

_HEAD = "id:string,type:string,operation:string,version:string,time:string,tableName:string,data:string"
CHART_BODY = f"struct<{_HEAD}>"
_CHART_SHAPE = "chartId:string,contentClasses:string," + ",".join(f"{m}:string" for m in CHART_COLUMNS.values())
_ITEM = "contentId string, chartId string, " + ", ".join(f"{m} string" for m in CONTENT_COLUMNS.values())


def class_rollup(df: DataFrame, listing: Column) -> DataFrame:
    """Add the columns of a content-class list: the list itself, and each member's sorted distinct values.

    Text that is not JSON is kept as it is; JSON other than a filled list gives nothing.
    """
    shape = ", ".join(f"{m} string" for m in CLASS_COLUMNS.values())

    def read(text: Column) -> Column:
        def kept(p: Column) -> Column:
            json = F.coalesce(p["bad"].isNull() & (p["z"] == J.seal(text)), F.lit(False))
            return F.struct(
                F.when(~json, text).when(J.opening(text) == "[", p["w"]).alias("kept"),
                F.when(json & (J.opening(text) == "["), F.from_json(p["w"], "array<string>")).alias("entries"),
            )

        return X.let(J.parse_strict(text, "string"), kept)

    rows = J.once(df, "_classes", F.when(X.is_present(listing), X.let(listing, read)))
    objects = F.filter(F.col("_classes.entries"), lambda e: J.opening(e) == "{")
    rows = J.once(rows, "_members", F.transform(objects, lambda e: F.from_json(e, shape)))
    empty = F.coalesce(F.size("_classes.entries") == 0, F.lit(False))

    def joined(member: str) -> Column:
        values = F.filter(F.transform("_members", lambda m: m[member]), X.is_present)
        return F.nullif(F.array_join(F.array_sort(F.array_distinct(values)), ","), F.lit(""))

    return rows.withColumns({
        "content_classes": F.when(~empty, F.col("_classes.kept")),
        **{c: joined(m) for c, m in CLASS_COLUMNS.items()},
    }).drop("_classes", "_members")


def _head(decoded: DataFrame, kind: str, base: str, test_tables: bool) -> DataFrame:
    rows = decoded.where(F.col("error").isNull() & (F.col("body.type") == kind))
    return rows.select(
        "partition", "offset",
        arrival().alias("arrival"),
        X.route(base, F.col("body.tableName"), test_tables).alias("target"),
        X.present(F.col("body.id")).alias("id"),
        F.col("body.operation").alias("operation"),
        X.classify_operation(F.col("body.operation")).alias("class"),
        X.present(F.col("body.version")).alias("message_time"),
        X.format_time(X.parse_time(F.col("body.time"))).alias("time"),
        F.col("body.data").alias("data"),
    )


def chart_messages(decoded: DataFrame, test_tables: bool = True) -> DataFrame:
    """Chart description messages with their class (release, withdraw, unsupported) and `reject_reason`."""
    rows = _head(decoded, "chart", "description", test_tables)
    # Text that was held in a JSON string counts as JSON only as a whole; `from_json` alone would ignore what follows.
    rows = rows.withColumn("_empty", ~F.coalesce(F.col("data") != "", F.lit(False)))
    rows = J.once(rows, "_chart", F.when(J.opening(F.col("data")) == "{", J.parse_strict(F.col("data"), f"struct<{_CHART_SHAPE}>")))
    rows = J.once(rows, "chart", F.when(J.accepted(F.col("_chart"), F.col("data")), F.col("_chart")["w"])).drop("_chart")
    reason = (
        F.when(F.col("id").isNull(), "blank_id")
        .when(F.col("class") == "unsupported", "unsupported_operation")
        .when((F.col("class") == "release") & F.col("chart").isNull() & ~F.col("_empty"), "data_not_object")
        .when((F.col("class") == "release") & ~X.is_present(F.col("chart.chartId")), "blank_chart_id")
    )
    return rows.withColumn("reject_reason", reason).drop("data", "_empty")


def chart_upsert(messages: DataFrame, operate_time: str) -> DataFrame:
    """Chart table after all messages: a release sets its present columns, a withdrawal only marks the row."""
    release = F.col("class") == "release"
    rows = class_rollup(messages.where(F.col("reject_reason").isNull()), F.when(release, F.col("chart.contentClasses")))
    columns = {
        "id": F.when(release, F.col("id")),
        "type": F.when(release, "chart"),
        "chart_id": F.when(release, F.col("chart.chartId")),
        "offline_flg": F.col("operation"),
        "operate_time": F.lit(operate_time),
        "message_time": F.when(release, F.col("message_time")),
        "time": F.when(release, F.col("time")),
        **{c: F.when(release, X.present(F.col(f"chart.{m}"))) for c, m in CHART_COLUMNS.items()},
        **{c: F.col(c) for c in ("content_classes", *CLASS_COLUMNS)},
    }
    flat = rows.select("target", F.col("id").alias("row_key"), "arrival", *[e.alias(c) for c, e in columns.items()])
    return last_present(flat, ["target", "row_key"], list(columns), "arrival")


def content_messages(decoded: DataFrame, test_tables: bool = True) -> DataFrame:
    """Content messages with `items`: for each row key the last item of the message, in list order."""
    rows = _head(decoded, "chart_content", "content", test_tables)
    rows = rows.where(F.col("id").isNotNull() & (F.col("class") != "unsupported"))
    is_list = (F.col("class") == "release") & (J.opening(F.col("data")) == "[") & J.is_json(F.col("data"))
    texts = F.when(is_list, F.from_json("data", "array<string>"))
    objects = F.filter(texts, lambda t: (J.opening(t) == "{") & J.is_json(t))
    parsed = F.filter(
        F.transform(objects, lambda t: F.from_json(t, _ITEM)),
        lambda i: X.is_present(i["contentId"]) & X.is_present(i["chartId"]),
    )
    keyed = F.transform(parsed, lambda i, n: F.struct(
        F.concat(i["chartId"], F.lit("_"), i["contentId"]).alias("row_key"), n.alias("pos"), i.alias("item")
    ))
    return J.once(rows, "items", keyed).drop("data")


def content_rejects(decoded: DataFrame, test_tables: bool = True) -> DataFrame:
    """(partition, offset, pos, reject_reason): content messages that `content_messages` leaves out, without a `pos`,
    and items of the others that it leaves out, with their place in the list."""
    rows = _head(decoded, "chart_content", "content", test_tables)
    whole = (J.opening(F.col("data")) == "[") & J.is_json(F.col("data"))
    rows = J.once(rows, "_list", F.when(whole, F.from_json("data", "array<string>")))
    reason = (
        F.when(F.col("id").isNull(), "blank_id")
        .when(F.col("class") == "unsupported", "unsupported_operation")
        .when((F.col("class") == "release") & F.col("_list").isNull(), "data_not_list")
    )
    rows = rows.withColumn("_reason", reason)
    messages = rows.where(F.col("_reason").isNotNull()).select(
        "partition", "offset", F.lit(None).cast("int").alias("pos"), F.col("_reason").alias("reject_reason")
    )
    items = rows.where(F.col("_reason").isNull() & (F.col("class") == "release")).select(
        "partition", "offset", F.posexplode("_list").alias("pos", "text")
    )
    an_object = F.coalesce((J.opening(F.col("text")) == "{") & J.is_json(F.col("text")), F.lit(False))
    items = J.once(items, "item", F.when(an_object, F.from_json("text", _ITEM)))
    fault = F.when(F.col("item").isNull(), "item_not_object").when(
        ~(X.is_present(F.col("item.contentId")) & X.is_present(F.col("item.chartId"))), "blank_item_id"
    )
    return messages.unionByName(items.select("partition", "offset", "pos", fault.alias("reject_reason")).where("reject_reason IS NOT NULL"))


def _last_of_key(items: Column) -> Column:
    """Of items with the same row key only the last: after sorting by key and place, those whose successor differs."""
    ordered = F.array_sort(items)
    return F.filter(
        F.transform(ordered, lambda i, n: F.struct(i.alias("i"), F.get(ordered, n + 1)["row_key"].alias("next"))),
        lambda p: p["next"].isNull() | (p["next"] != p["i"]["row_key"]),
    )


def index_writes(messages: DataFrame) -> DataFrame:
    """One row for each chart a released message has items of: the row keys in item order, duplicates kept."""
    charts = F.array_distinct(F.transform("items", lambda i: i["item"]["chartId"]))
    rows = messages.where(F.size("items") > 0).select(
        "target", "arrival", "operation", "items", F.explode(charts).alias("chart_id")
    )
    own = F.filter("items", lambda i: i["item"]["chartId"] == F.col("chart_id"))
    return rows.select("target", "chart_id", "arrival", "operation", F.transform(own, lambda i: i["row_key"]).alias("row_keys"))


def _previous_write(rows: DataFrame, run: Runner) -> DataFrame:
    return run(rows, {"version": ("max", F.when(F.col("is_write"), F.col("place")))})


def old_marks(messages: DataFrame, writes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Which version of a chart's index each message marks: (target, chart_id, place, version, operation).

    A message first marks the rows of the index as it stands, then writes its own; so in the order of events a
    mark comes right before the write of the same message. The version is the place of the last earlier write.
    """
    key = F.concat_ws("\u0001", "target", "chart_id").alias("key")
    marks = messages.select("target", F.col("id").alias("chart_id"), "operation", (F.col("arrival") * 2).alias("place"),
                            F.lit(False).alias("is_write"))
    places = writes.select("target", "chart_id", "operation", (F.col("arrival") * 2 + 1).alias("place"), F.lit(True).alias("is_write"))
    events = marks.unionByName(places).select(key, "*")
    scanned = scan_by_key(events, "key", _previous_write, order="place", hot_rows=hot_rows)
    return scanned.where(~F.col("is_write") & F.col("version").isNotNull()).select(
        "target", "chart_id", "place", "version", "operation"
    )


def mark_old_offline(marks: DataFrame, writes: DataFrame) -> DataFrame:
    """Marked content rows (target, row_key, place, offline_flg).

    Only the last mark of an index version can decide, so each version is expanded once however often it is marked.
    """
    last = marks.groupBy("target", "chart_id", "version").agg(
        F.max("place").alias("place"), F.max_by("operation", "place").alias("offline_flg")
    )
    versions = writes.select("target", "chart_id", (F.col("arrival") * 2 + 1).alias("version"), "row_keys")
    rows = last.join(versions, ["target", "chart_id", "version"])
    return rows.select("target", F.explode(F.array_distinct("row_keys")).alias("row_key"), "place", "offline_flg")


def content_upsert(messages: DataFrame, operate_time: str, hot_rows: int = HOT_ROWS, indexed: bool = True) -> DataFrame:
    """Content table after all messages; with the index on, former rows of a chart are marked first."""
    items = messages.where(F.size("items") > 0).select("*", F.explode(_last_of_key(F.col("items"))).alias("last"))
    entry = F.col("last.i.item")
    columns = {
        "id": F.col("last.i.row_key"),
        "content_id": entry["contentId"],
        "chart_id": entry["chartId"],
        "type": F.lit("chart_content"),
        "offline_flg": F.col("operation"),
        "operate_time": F.lit(operate_time),
        "message_time": F.col("message_time"),
        "time": F.col("time"),
        **{c: X.present(entry[m]) for c, m in CONTENT_COLUMNS.items()},
    }
    rows = items.select(
        "target", F.col("last.i.row_key").alias("row_key"), (F.col("arrival") * 2 + 1).alias("place"),
        *[e.alias(c) for c, e in columns.items()],
    )
    if indexed:
        writes = materialize(index_writes(messages), "index-writes")
        marks = mark_old_offline(old_marks(messages, writes, hot_rows), writes)
        rows = rows.unionByName(marks.withColumn("operate_time", F.lit(operate_time)), allowMissingColumns=True)
    return last_present(rows, ["target", "row_key"], list(columns), "place")


def chart_index(messages: DataFrame, operate_time: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Index rows after all messages: the last written row keys of each chart, and its last mark or write."""
    writes = materialize(index_writes(messages), "index-writes")
    marks = old_marks(messages, writes, hot_rows).select("target", "chart_id", "place", F.col("operation").alias("offline_flg"))
    written = writes.select(
        "target", "chart_id", (F.col("arrival") * 2 + 1).alias("place"), F.col("operation").alias("offline_flg"),
        F.to_json("row_keys").alias("content_row_keys"),
    )
    events = written.unionByName(marks, allowMissingColumns=True)
    rows = last_present(events, ["target", "chart_id"], ["content_row_keys", "offline_flg"], "place")
    return rows.select(
        "target", F.concat(F.lit(INDEX_PREFIX), "chart_id").alias("row_key"), "chart_id", "content_row_keys", "offline_flg",
        F.lit(operate_time).alias("operate_time"),
    )


def index_rows(index: DataFrame) -> DataFrame:
    """The row keys of each index row, in order; a missing or broken list is an empty one."""
    return index.select("target", "row_key", F.posexplode(J.text_list(F.col("content_row_keys"))).alias("pos", "content_row_key"))
