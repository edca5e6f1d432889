"""From raw topic records to vector documents: decode, filter by type, map, validate, reject."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from assetweave.functions import payload as J, search, text as X, vectors as V

RECORD = ("partition", "offset", "timestamp")

ITEM = ("struct<type:string,vector:string,vectorDimension:string,modelName:string,source:string,"
        "summary:string,version:string>")
VECTOR_BODY = ("struct<id:string,type:string,operation:string,version:string,time:string,assetId:string,"
               f"asset_id:string,assert_id:string,data:struct<type:string,assetId:string,asset_id:string,vectorList:array<{ITEM}>>>")

# Columns of a stored vector row, by default and in full.
DEFAULT_FIELDS = ("id", "assetId", "version", "time", "modelName", "source", "summary", "type", "vector",
                  "vectorDimension", "vectorVersion")
ALL_FIELDS = ("id", "operation", *DEFAULT_FIELDS[1:], "modelVersion")
REQUIRED_FIELDS = ("assetId", "version")


def decode_messages(topic: DataFrame, body: str = VECTOR_BODY) -> DataFrame:
    """Add `text`, `payload` (the JSON object), `body` (its known fields) and `error` (null when decoded).

    A record must hold strict UTF-8 and strict JSON: an object, or a string that holds an object.
    """
    text = F.try_validate_utf8(F.col("value").cast("string"))
    quoted = J.opening(F.col("text")) == '"'
    outer = F.when(quoted, J.parse_strict(F.col("text"), "string"))
    decoded = topic.withColumn("text", text).withColumn("_outer", outer)
    inner = F.when(J.accepted(F.col("_outer"), F.col("text")), F.col("_outer")["w"])
    decoded = decoded.withColumn("_json", F.when(quoted, inner).otherwise(F.col("text")))
    parsed = F.when(J.opening(F.col("_json")) == "{", J.parse_strict(F.col("_json"), body))
    decoded = J.once(decoded, "_parsed", parsed)
    decoded = decoded.withColumn("_valid", F.col("_parsed").isNotNull() & J.accepted(F.col("_parsed"), F.col("_json")))
    valid = F.col("_valid")
    error = (
        F.when(F.col("value").isNull(), "missing")
        .when(F.col("text").isNull(), "not_utf8")
        .when(~X.is_present(F.col("text")), "blank")
        .when(valid, None)
        .when(J.is_json(F.col("_json")), "not_object")
        .otherwise("not_json")
    )
    return decoded.withColumn("error", error).select(
        *topic.columns,
        "text",
        F.when(F.col("error").isNull(), F.col("_json")).alias("payload"),
        F.when(F.col("error").isNull(), F.col("_parsed")["w"]).alias("body"),
        "error",
    )


def rejects(decoded: DataFrame, limit: int = 200) -> DataFrame:
    """Side output of undecodable records: where they are, why, and a one-line preview."""
    shown = F.make_valid_utf8(F.col("value").cast("string"))
    return decoded.where(F.col("error").isNotNull()).select(
        "partition", "offset", "error", X.preview(shown, limit).alias("preview")
    )


def _known_type(decoded: DataFrame, mentioned: Column) -> Column:
    """(value) of the first nested type where `data` and its list explain every mention of the name, else null."""
    body = decoded.schema["body"].dataType
    data = body["data"].dataType if "data" in body.names else None
    if "type" not in getattr(data, "names", []) or "vectorList" not in data.names:
        return F.lit(None).cast("struct<value:string>")
    own, (count, first) = F.col("body.data.type"), J.in_list(F.col("body.data.vectorList"), "type")
    keys = F.json_object_keys(J.member_text(F.col("payload"), "data"))
    later = (F.array_position(keys, "vectorList") > 0) & (F.array_position(keys, "vectorList") < F.array_position(keys, "type"))
    value = F.when(own.isNull(), first).when(first.isNull(), own).when(first == own, own).when(later, first).otherwise(own)
    explained = (mentioned == count + own.isNotNull().cast("int")) & F.coalesce(J.searches_to_itself(value), F.lit(True))
    return F.when(explained, F.struct(value.alias("value")))


def resolve_type(decoded: DataFrame) -> DataFrame:
    """Add `msg_type`: the top-level type even if null, else the first nested one."""
    top = F.col("body.type")
    nested = F.when(top.isNull() & ~J.has_key(F.col("payload"), "type"), J.mentions(J.without_long_strings(F.col("payload")), "type"))
    rows = decoded.withColumn("_mentioned", nested)
    rows = rows.withColumn("_known", F.when(F.col("_mentioned") > 0, _known_type(decoded, F.col("_mentioned"))))
    search_in = F.when((F.col("_mentioned") > 0) & F.col("_known").isNull(), F.col("payload"))
    found = search.search_fields(search_in, [["type"]])
    rows = rows.withColumn("msg_type", F.coalesce(top, F.col("_known.value"), F.get(found, F.lit(0))["text"]))
    return rows.drop("_mentioned", "_known")


def matches_type(expected: str | None) -> Column:
    """Filter on `msg_type`; a blank expectation lets everything pass."""
    if expected is None or not str(expected).strip():
        return F.lit(True)
    return F.coalesce(F.col("msg_type") == str(expected), F.lit(False))


def open_listing(typed: DataFrame) -> DataFrame:
    """Add `_data` and `_list`: `data` and `data.vectorList` as JSON text, for the rows the schema could not read.

    That is the case when one of them is held in a JSON string, or the list has other things than objects.
    """
    odd = F.col("body.data.vectorList").isNull()
    steps = (
        ("_data", F.when(odd, X.strip(J.member_text(F.col("payload"), "data")))),
        ("_data", F.when(J.opening(F.col("_data")).isin("{", "[") & J.is_json(F.col("_data")), F.col("_data"))),
        ("_list", X.strip(J.member_text(F.col("_data"), "vectorList"))),
        ("_list", F.when(J.opening(F.col("_list")).isin("{", "[") & J.is_json(F.col("_list")), F.col("_list"))),
    )
    for name, expr in steps:
        typed = typed.withColumn(name, expr)
    return typed


def list_items(listing: Column, direct: Column) -> Column:
    """Objects of the vector list as an array of structs; a single object counts as one item."""
    texts = F.when(J.opening(listing) == "{", F.array(listing)).otherwise(F.from_json(listing, "array<string>"))
    objects = F.filter(texts, lambda item: (J.opening(item) == "{") & J.is_json(item))
    return F.coalesce(direct, F.transform(objects, lambda item: F.from_json(item, ITEM)))


def select_item(items: Column, wanted: str | None) -> Column:
    """First item of the wanted type, or the first item at all when no type is wanted."""
    if wanted is None or not str(wanted).strip():
        return F.get(F.filter(items, lambda item: item.isNotNull()), F.lit(0))
    return F.get(F.filter(items, lambda item: item["type"] == str(wanted)), F.lit(0))


def select_vectors(typed: DataFrame, wanted: str | None = "1") -> DataFrame:
    """Add `items` and `item`, the list element of the wanted type."""
    items = list_items(F.col("_list"), F.col("body.data.vectorList"))
    return J.once(open_listing(typed), "items", items).withColumn("item", select_item(F.col("items"), wanted))


def vector_documents(typed: DataFrame, wanted: str | None = "1") -> DataFrame:
    """One document for each message, with `reject_reason` set where it must not be stored."""
    def filled(col: Column) -> Column:
        return F.when(col != "", col)

    rows = select_vectors(typed, wanted)
    item, payload = F.col("item"), F.col("payload")
    rows = rows.withColumn("_asset", F.coalesce(
        filled(F.col("body.data.assetId")), filled(J.member_text(F.col("_data"), "assetId"))
    ))
    # A field left out of the item may stand elsewhere; without another mention there is nothing to search, and where known
    # members explain every mention, the search would come upon one of them.
    rows = rows.withColumn("_names", J.without_long_strings(payload))
    names, listing = F.col("_names"), F.col("body.data.vectorList")
    rows = rows.withColumn("_n_asset", F.when(F.col("_asset").isNull(), J.mentions(names, *search.aliases("assetId"))))
    rows = rows.withColumns({f"_n_{f}": F.when(item.isNotNull() & filled(item[f]).isNull(), J.mentions(names, f)) for f in ("modelName", "summary")})
    members = [F.col(f"body.{name}") for name in ("assetId", "asset_id", "assert_id", "data.assetId", "data.asset_id")]
    sure = {"asset": ((F.col("_n_asset") == 1) & J.searches_to_itself(F.coalesce(*members)), F.coalesce(*members))}
    for f in ("modelName", "summary"):
        count, first = J.in_list(listing, f)
        sure[f] = ((F.col(f"_n_{f}") == count) & F.coalesce(J.searches_to_itself(first), F.lit(True)), first)
    known = {f: F.when(F.coalesce(holds, F.lit(False)), F.struct(value.alias("value"))) for f, (holds, value) in sure.items()}
    rows = rows.withColumns({f"_k_{f}": value for f, value in known.items()})
    elsewhere = [
        (F.col("_n_asset") > 0) & F.col("_k_asset").isNull(),
        *[(F.col(f"_n_{f}") > item[f].isNotNull().cast("int")) & F.col(f"_k_{f}").isNull() for f in ("modelName", "summary")],
    ]
    needed = [F.coalesce(need, F.lit(False)) for need in elsewhere]
    rows = rows.withColumn("_search", F.when(needed[0] | needed[1] | needed[2], payload))
    found = search.search_fields(F.col("_search"), [search.aliases("assetId"), ["modelName"], ["summary"]])
    rows = rows.withColumn("_found", found)
    asset = F.coalesce(F.col("_asset"), F.col("_k_asset.value"), F.get("_found", F.lit(0))["text"])
    reason = (
        F.when(~X.is_present(asset), "missing_asset_id")
        .when(item.isNull(), "missing_vector_item")
        .when(~V.is_valid(item["vector"], item["vectorDimension"]), "invalid_vector")
    )
    values = {
        "id": F.col("body.id"),
        "operation": F.col("body.operation"),
        "assetId": asset,
        "version": F.col("body.version"),
        "time": F.col("body.time"),
        "modelName": F.coalesce(filled(item["modelName"]), F.col("_k_modelName.value"), F.get("_found", F.lit(1))["text"]),
        "source": item["source"],
        "summary": F.coalesce(filled(item["summary"]), F.col("_k_summary.value"), F.get("_found", F.lit(2))["text"]),
        "type": item["type"],
        "vector": item["vector"],
        "vectorDimension": item["vectorDimension"],
        "vectorVersion": item["version"],
        "modelVersion": item["version"],
    }
    record = [c for c in RECORD if c in typed.columns]
    return rows.select(
        *record, reason.alias("reject_reason"), asset.alias("row_key"),
        *[F.when(reason.isNull(), X.present(col)).alias(name) for name, col in values.items()],
    )


def subset_fields(documents: DataFrame, fields: Sequence[str] = DEFAULT_FIELDS) -> list[str]:
    """Columns to store: the wanted ones plus the required ones; no wanted ones means all."""
    wanted = [f for f in fields if f and f.strip()] or list(ALL_FIELDS)
    return [c for c in documents.columns if c in ALL_FIELDS and (c in wanted or c in REQUIRED_FIELDS)]


def ingest(topic: DataFrame, expected_type: str | None = "140", wanted: str | None = "1") -> DataFrame:
    """Decode, filter by type, and map to vector documents with `reject_reason`."""
    decoded = decode_messages(topic).where(F.col("error").isNull()).drop("value", "text", "error")
    return vector_documents(resolve_type(decoded).where(matches_type(expected_type)), wanted)


def generic_documents(
    decoded: DataFrame,
    fields: Sequence[str],
    row_key_field: str = "assetId",
    operate_time: str | None = None,
) -> DataFrame:
    """Copy configured fields found anywhere in the payload; `reject_reason` where key or fields are missing."""
    key_names = search.aliases(row_key_field)
    found = search.search_fields(F.col("payload"), [search.aliases(f) for f in fields] + [key_names])
    rows = decoded.where(F.col("error").isNull()).withColumn("_found", found)
    values = [F.get("_found", F.lit(n))["text"] for n in range(len(fields))]
    key = F.get("_found", F.lit(len(fields)))["text"]
    reason = F.when(key.isNull(), "missing_row_key").when(F.coalesce(*values).isNull(), "no_fields")
    return rows.select(
        "partition", "offset", reason.alias("reject_reason"), key.alias("row_key"),
        *[v.alias(f) for v, f in zip(values, fields)],
        *([F.lit(operate_time).alias("operate_time")] if operate_time else []),
    )
