"""On/offline state: the rules for widgets, rooms and on-demand items, the version gate, and the fan-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from assetweave.functions import payload as J, text as X
from assetweave.operators.scan import HOT_ROWS, Runner, arrival, scan_by_key

# The marker of test content, message kinds, and stored kinds of documents.
TEST_MARKER = "测试"
WIDGET_TYPES = (0, 1)
ROOM_TYPE = 4
WIDGET_DOC, ROOM_DOC = "pendant", "newLive"
# On-demand message type, and the package it must belong to unless it goes offline.
ONDEMAND_PACKAGES = {"217": "141", "208": "1"}
OFFLINE_OPERATION = 2
SCORE_LIFETIME_MS = 2 * 60 * 60 * 1000
MARKER_LIFETIME_S = 12 * 60 * 60

_ENVELOPE = ("struct<activityType:int,channel:string,mgdbId:string,mgdbStatus:variant,version:string,time:string,"
             "data:string>")
_BODY = ("struct<body:struct<activityType:int,mgdbId:string,projectId:string,seasonId:string,testMgdb:variant,title:string,"
         "test:variant,roomLabel:variant,shareMaterial:variant,"
         "roomStatus:variant,broadcastStatus:variant>>")
_ONDEMAND = ("struct<type:string,id:string,operation:string,version:string,time:string,"
             "data:struct<productInfoPackageId:string,content:struct<PRODUCT_INFO_PACKAGE_ID:string>>>")


def _strict(topic: DataFrame, shape: str) -> DataFrame:
    """Add the members of the message as columns with a leading underscore, null where the value is no strict JSON, and
    `unreadable`, which says why. Flat columns, as the optimizer loses members of a generated struct it wants to prune."""
    text = F.try_validate_utf8(F.col("value").cast("string"))
    rows = J.once(topic.withColumn("_text", text), "_p", J.parse_strict(F.col("_text"), shape))
    message = F.when(J.accepted(F.col("_p"), F.col("_text")), F.col("_p")["w"])
    names = [f.name for f in DataType.fromDDL(shape).fields]
    flat = F.transform(F.array(message), lambda m: F.struct(m.isNotNull().alias("_read"), *[m[n].alias(f"_{n}") for n in names]))
    rows = rows.select("*", F.inline(flat))
    why = F.when(F.col("value").isNull(), "missing").when(F.col("_text").isNull(), "not_utf8").when(~F.col("_read"), "not_json")
    return rows.withColumn("unreadable", why).drop("_text", "_p", "_read")


def _record(topic: DataFrame) -> list[str]:
    return [c for c in ("partition", "offset", "timestamp") if c in topic.columns]


def classify_envelopes(topic: DataFrame, channels: Sequence[str] | None = None) -> DataFrame:
    """All widget and room messages, the body taken out of its JSON string; `reject_reason` is null for usable ones.

    `number_zero` tells a numeric status of 0, which is offline, from the text "0", which is not. A widget is
    known by the id in its body; a room's id carries a prefix of four characters there.
    """
    rows = _strict(topic, _ENVELOPE)
    rows = J.once(rows, "_d", J.parse_strict(F.col("_data"), _BODY))
    rows = J.once(rows, "b", F.when(J.accepted(F.col("_d"), F.col("_data")), F.col("_d")["w"]["body"]))
    kind = F.when(F.col("_activityType").isin(*WIDGET_TYPES), "widget").when(F.col("_activityType") == ROOM_TYPE, "room")
    state = F.col("_mgdbStatus")
    numeric = F.try_variant_get(state, "$", "double")
    zero = ~F.schema_of_variant(state).isin("STRING", "VOID") & (numeric == 0)
    doc_id = F.when(kind == "room", F.substring(F.col("b.mgdbId"), 5, 1 << 30)).otherwise(F.col("b.mgdbId"))
    version = X.parse_integer(F.col("_version"))
    listened = F.lit(True) if channels is None else F.coalesce(F.col("_channel").isin(*channels), F.lit(False))
    reason = (
        F.when(F.col("unreadable").isNotNull(), F.col("unreadable"))
        .when(~listened, "other_channel")
        .when(F.col("b").isNull(), "no_body")
        .when(kind.isNull(), "other_activity")
        .when(doc_id.isNull(), "missing_id")
        .when((kind == "widget") & state.isNull(), "missing_status")
        .when(version.isNull(), "unreadable_version")
    )
    return rows.select(
        *_record(topic), "value", reason.alias("reject_reason"), kind.alias("kind"), doc_id.alias("doc_id"), version.alias("version"),
        F.col("_time").alias("time"), F.coalesce(zero, F.lit(False)).alias("number_zero"), "b",
    )


def usable(classified: DataFrame) -> DataFrame:
    return classified.where("reject_reason IS NULL").drop("reject_reason", "value")


def rejects(classified: DataFrame, limit: int = 200) -> DataFrame:
    """Where a message that is not used lies, why, and a one-line preview of it. A filter on the topic, so it also
    runs as a stream of its own."""
    shown = X.preview(F.make_valid_utf8(F.col("value").cast("string")), limit)
    return classified.where("reject_reason IS NOT NULL").select("partition", "offset", "reject_reason", shown.alias("preview"))


def status_envelope(topic: DataFrame, channels: Sequence[str] | None = None) -> DataFrame:
    """The usable widget and room messages."""
    return usable(classify_envelopes(topic, channels))


def _side_state(rows: DataFrame, ids: str, table: DataFrame, name: str) -> DataFrame:
    """Left join of a status side table; a missing row has no effect, a missing state means `1`.

    Messages without an id get one of many keys that match nothing, so that they do not all land in one task.
    """
    side = table.select(F.col("id").alias("_id"), F.coalesce("state", F.lit("1")).alias(name))
    spread = F.concat(F.lit("\u0000"), F.pmod(F.hash("doc_id", "version", "offset"), F.lit(4096)))
    key = F.when(F.col(ids) != "", F.col(ids)).otherwise(spread)
    return rows.join(side, key == F.col("_id"), "left").drop("_id")


def widget_room_status(rows: DataFrame, competitions: DataFrame, seasons: DataFrame) -> DataFrame:
    """Add `status` (1, 0, or null where a needed member is missing) and `offline`; null counts as offline."""
    rows = _side_state(rows, "b.projectId", competitions, "_competition")
    rows = _side_state(rows, "b.seasonId", seasons, "_season")
    b = F.col("b")

    def has(col: Column) -> Column:
        return F.coalesce(F.contains(col, F.lit(TEST_MARKER)), F.lit(False))

    def differs(col: Column, value: str) -> Column:
        return F.coalesce(col != value, F.lit(False))

    def equals(col: Column, value: str) -> Column:
        """The member is this very text; the number of the same digits, or null, is not."""
        text = F.try_variant_get(col, "$", "string")
        return F.coalesce((F.schema_of_variant(col) == "STRING") & (text == value), F.lit(False))

    widget_off = (
        differs(F.col("_competition"), "1") | differs(F.col("_season"), "1")
        | equals(b["testMgdb"], "1") | has(b["title"]) | F.col("number_zero")
    )
    def truthy(col: Column) -> Column:
        """The member is there and neither null, false, zero nor empty."""
        zero = (F.schema_of_variant(col) != "STRING") & (F.try_variant_get(col, "$", "double") == 0)
        empty = F.to_json(col).isin("null", "false", '""', "[]", "{}")
        return F.coalesce(~(empty | F.coalesce(zero, F.lit(False))), F.lit(False))

    def no_object(col: Column) -> Column:
        """The member is there, and is null or of another kind."""
        return F.coalesce(~F.startswith(F.schema_of_variant(col), F.lit("OBJECT")), F.lit(False))

    def member(col: Column, name: str) -> Column:
        return F.coalesce(F.try_variant_get(col, f"$.{name}", "string"), F.to_json(F.try_variant_get(col, f"$.{name}", "variant")))

    room_broken = no_object(b["roomLabel"]) | no_object(b["shareMaterial"])
    room_broken = room_broken | b["roomStatus"].isNull() | (equals(b["roomStatus"], "3") & b["broadcastStatus"].isNull())
    room_off = (
        truthy(b["test"])
        | F.coalesce(F.try_variant_get(b["roomLabel"], "$.firstClassName", "string") == TEST_MARKER, F.lit(False))
        | has(member(b["shareMaterial"], "roomTitle"))
        | ~equals(b["roomStatus"], "3") | ~equals(b["broadcastStatus"], "1")
    )
    status = (
        F.when(b["activityType"].isNull(), None)
        .when(b["activityType"].isin(*WIDGET_TYPES), F.when(widget_off, 0).otherwise(1))
        .when(b["activityType"] == ROOM_TYPE, F.when(room_broken, None).when(room_off, 0).otherwise(1))
        .otherwise(1)
    )
    offline = F.coalesce(F.col("status") == 0, F.lit(True))
    return rows.withColumn("status", status).withColumn("offline", offline).drop("b", "_competition", "_season", "number_zero")


def classify_ondemand(topic: DataFrame) -> DataFrame:
    """All on-demand messages; `reject_reason` is null for those of a known type that go offline or belong to the package of
    their type."""
    rows = _strict(topic, _ONDEMAND)
    operation = X.parse_integer(F.col("_operation"))
    packages = {"217": F.col("_data.productInfoPackageId"), "208": F.col("_data.content.PRODUCT_INFO_PACKAGE_ID")}
    owned = F.lit(False)
    for kind, package in ONDEMAND_PACKAGES.items():
        owned = owned | ((F.col("_type") == kind) & F.coalesce(packages[kind] == package, F.lit(False)))
    version = X.parse_integer(F.col("_version"))
    reason = (
        F.when(F.col("unreadable").isNotNull(), F.col("unreadable"))
        .when(~F.coalesce(F.col("_type").isin(*ONDEMAND_PACKAGES), F.lit(False)), "other_type")
        .when(operation.isNull(), "unreadable_operation")
        .when((operation != OFFLINE_OPERATION) & ~owned, "other_product")
        .when(F.col("_id").isNull(), "missing_id")
        .when(version.isNull(), "unreadable_version")
    )
    return rows.select(
        *_record(topic), "value", reason.alias("reject_reason"), F.lit("ondemand").alias("kind"), F.col("_type").alias("type"),
        F.col("_id").alias("doc_id"), version.alias("version"), F.col("_time").alias("time"),
        (operation == OFFLINE_OPERATION).alias("offline"),
    )


def ondemand_filter(topic: DataFrame) -> DataFrame:
    """The usable on-demand messages."""
    return usable(classify_ondemand(topic))


def _highest_before(rows: DataFrame, run: Runner) -> DataFrame:
    return run(rows, {"_highest": ("max", F.col("version"))})


def version_gate(messages: DataFrame, hot_rows: int = HOT_ROWS, stored: DataFrame | None = None) -> DataFrame:
    """Drop a message whose version is below the highest one seen before for its document; an equal one passes.

    `stored` has (doc_id, version) of earlier runs, which come before all messages. Within one bounded run nothing expires;
    the streaming gates add the lifetime of stored versions.
    """
    rows = messages.withColumn("arrival", arrival())
    if stored is not None:
        before = stored.select("doc_id", "version", F.lit(-1).cast("bigint").alias("arrival"))
        rows = rows.withColumn("_old", F.lit(False)).unionByName(before.withColumn("_old", F.lit(True)), allowMissingColumns=True)
    rows = scan_by_key(rows, "doc_id", _highest_before, hot_rows=hot_rows)
    passed = rows.where(F.col("_highest").isNull() | (F.col("version") >= F.col("_highest"))).drop("_highest")
    return passed if stored is None else passed.where(~F.col("_old")).drop("_old")


def matching_kind(kind: Column, doc_type: Column) -> Column:
    """Whether a stored document may be taken offline by a message of this kind; a missing one may not."""
    return F.coalesce(
        F.when(kind == "widget", doc_type == WIDGET_DOC)
        .when(kind == "room", doc_type == ROOM_DOC)
        .otherwise(~doc_type.isin(WIDGET_DOC, ROOM_DOC)),
        F.lit(False),
    )


def offline_events(accepted: DataFrame, programs: DataFrame, update_time: int) -> DataFrame:
    """Change events for stored documents that go offline, one for each accepted message."""
    offline = accepted.where("offline").select("partition", "offset", "kind", "doc_id", "version", "time")
    stored = programs.select(F.col("row_key").alias("doc_id"), "doc_type")
    rows = offline.join(stored, "doc_id").where(matching_kind(F.col("kind"), F.col("doc_type")))
    return rows.drop("doc_type").withColumns({
        "status": F.lit(0), "additional_status": F.lit(0), "update_time": F.lit(update_time).cast("bigint"),
    })


def offline_ids(accepted: DataFrame) -> DataFrame:
    """Documents taken offline, with kind and highest version: reduced before any join."""
    return accepted.where("offline").groupBy("kind", "doc_id").agg(F.max("version").alias("version"))


def status_fanout(offline: DataFrame, programs: DataFrame, update_time: int) -> DataFrame:
    """Updates for every store: (target, doc_id, status, additional_status, update_time, score).

    The profile table takes all documents, the other stores only those of the matching kind. The main table
    stamps the update time; for on-demand items all tables do. Rooms also enter the scored set.
    """
    stored = programs.select(F.col("row_key").alias("doc_id"), "doc_type")
    rows = offline.join(stored, "doc_id", "left").withColumn("_match", matching_kind(F.col("kind"), F.col("doc_type")))
    targets = F.concat(
        F.array(F.lit("profile")),
        F.when(F.col("_match"), F.array(F.lit("main"), F.lit("latest"), F.lit("documents"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("kind") == "room", F.array(F.lit("scored_set"))).otherwise(F.array().cast("array<string>")),
    )
    rows = rows.select("kind", "doc_id", "version", F.explode(targets).alias("target"))
    table = F.col("target") != "scored_set"
    stamped = (F.col("target") == "main") | ((F.col("kind") == "ondemand") & F.col("target").isin("latest", "profile"))
    return rows.select(
        "kind", "target", "doc_id",
        F.when(table, 0).alias("status"),
        F.when(table, 0).alias("additional_status"),
        F.when(stamped, F.lit(update_time).cast("bigint")).alias("update_time"),
        F.when(~table, F.col("version")).alias("score"),
    )


def cache_invalidate(cache: DataFrame, offline: DataFrame, prefix: str, key: str = "cache_key") -> DataFrame:
    """The cache without the entries of documents that went offline."""
    return cache.join(cache_keys(offline, prefix, key), key, "left_anti")


def cache_keys(offline: DataFrame, prefix: str, key: str = "cache_key") -> DataFrame:
    """The cache entries of documents that went offline."""
    return offline.select(F.concat(F.lit(prefix), "doc_id").alias(key)).distinct()


def offline_heartbeat(events: DataFrame, lifetime_s: int = MARKER_LIFETIME_S) -> DataFrame:
    """For each kind the last offline event and when its liveness marker expires."""
    last = events.groupBy("kind").agg(F.max(X.parse_time(F.col("time"))).alias("last_event"), F.count(F.lit(1)).alias("events"))
    return last.withColumn("expires_at", F.col("last_event") + F.expr(f"interval {lifetime_s} seconds"))


def decode_scored(lists: DataFrame, cell: str = "cell", order: str = "seq") -> DataFrame:
    """(member, score) from alternating lists; of a repeated member the last pair counts."""
    pair = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(cell) / 2).cast("int") - 1),
        lambda n: F.struct(F.get(F.col(cell), n * 2).alias("member"), F.get(F.col(cell), n * 2 + 1).cast("bigint").alias("score")),
    )
    pairs = lists.where(F.size(cell) >= 2).select(order, F.posexplode(pair).alias("pos", "pair"))
    return pairs.groupBy(F.col("pair.member").alias("member")).agg(
        F.max_by("pair.score", F.struct(order, "pos")).alias("score")
    )


def expire_scored(scored: DataFrame, now_ms: int, lifetime_ms: int = SCORE_LIFETIME_MS) -> DataFrame:
    """Members whose score is not older than the lifetime."""
    return scored.where(F.col("score") >= now_ms - lifetime_ms)
