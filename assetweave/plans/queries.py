"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from assetweave.functions import payload as J, search, text as X, vectors as V
from assetweave.operators import charts, ingest, profile, reconcile, reports, status, upsert
from assetweave.operators.scan import arrival
from assetweave.plans import stages
from assetweave.session import materialize, new_path
from assetweave.sinks import files
from assetweave.sources import tables, topic as topics
from assetweave.sources.derived import land, load
from assetweave.streaming import gates, jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

OPERATE_TIME = "2024-01-01 00:00:00"
UPDATE_TIME = 1704067200
NOW_MS = 1700000000000 + 9_000_000
CHANNELS = ("main",)
CACHE_PREFIX = "video_cp:"
PREVIEW = 60
MERGE_FIELDS = ("program_id", "name", "category")


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# Sources


@query
def snapshot_scan(spark: SparkSession, sf: str) -> DataFrame:
    topic = load(spark, sf, "vector_topic")
    captured = topics.offsets(topic).withColumn("end", F.col("end") - F.col("partition"))
    return topics.snapshot_scan(topic, captured).select("partition", "offset", F.char_length("value").alias("size"))


@query
def retained_messages(spark: SparkSession, sf: str) -> DataFrame:
    return topics.retained_messages(topics.offsets(load(spark, sf, "vector_topic")))


@query
def table_scan(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table_scan(load(spark, sf, "asset_table"), ["assetId", "version"])


@query
def key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    keys = load(spark, sf, "document_index").select(F.replace("assert_id", F.lit("L"), F.lit("R")).alias("row_key"))
    return reconcile.lookup_rows(load(spark, sf, "asset_table"), keys, ["version", "modelName"])


@query
def doc_lookup(spark: SparkSession, sf: str) -> DataFrame:
    ids = reconcile.asset_ids(load(spark, sf, "asset_table"))
    return reconcile.doc_lookup(load(spark, sf, "document_index"), ids, "1, 141", ["program_id", "name"])


@query
def capped_hits(spark: SparkSession, sf: str) -> DataFrame:
    ids = reconcile.asset_ids(load(spark, sf, "asset_table"))
    return reconcile.doc_lookup(load(spark, sf, "document_index"), ids, None, ["program_id"], size=2)


# Decoding and fields


@query
def decode_messages(spark: SparkSession, sf: str) -> DataFrame:
    return stages.decoded(spark, sf).select("partition", "offset", "error", "payload")


@query
def reject_records(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.rejects(ingest.decode_messages(load(spark, sf, "vector_topic")), limit=10)


@query
def normalize_json(spark: SparkSession, sf: str) -> DataFrame:
    rows = stages.decoded(spark, sf).where("error IS NULL").select("partition", "offset", "payload")
    opened = J.once(rows, "opened", J.unnest_json(F.col("payload")))
    data = F.get_json_object("opened", "$.data")
    listing = F.coalesce(F.get_json_object("opened", "$.data.vectorList"), F.get_json_object("opened", "$.data.vector_list"))
    return opened.select("partition", "offset", data.alias("data"), listing.alias("listing"))


@query
def flatten_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "ondemand_topic").select("partition", "offset", F.explode(search.flatten_paths(F.col("value"))).alias("f"))
    return rows.select("partition", "offset", "f.path", "f.type", "f.value")


@query
def field_paths(spark: SparkSession, sf: str) -> DataFrame:
    return profile.field_paths(load(spark, sf, "chart_content_topic").withColumn("payload", F.col("value")))


@query
def resolve_field(spark: SparkSession, sf: str) -> DataFrame:
    rows = stages.decoded(spark, sf).where("error IS NULL")
    found = search.search_fields(F.col("payload"), [search.aliases("assetId")])
    return rows.select("partition", "offset", F.get(found, F.lit(0))["text"].alias("asset_id"))


@query
def find_nested(spark: SparkSession, sf: str) -> DataFrame:
    found = search.find_all_nested(F.col("payload"), [(search.VECTOR_ITEM_NAMES, "object"), (search.VECTOR_LIST_NAMES, "array")])
    rows = stages.decoded(spark, sf).where("error IS NULL").select("partition", "offset", found.alias("found"))
    return rows.select("partition", "offset", F.col("found")[0].alias("item"), F.size(F.from_json(F.col("found")[1], "array<string>")).alias("items"))


@query
def filter_type(spark: SparkSession, sf: str) -> DataFrame:
    rows = stages.decoded(spark, sf).where(F.col("error").isNull() & ingest.matches_type("140"))
    return rows.select("partition", "offset", "msg_type")


@query
def select_vector(spark: SparkSession, sf: str) -> DataFrame:
    rows = stages.decoded(spark, sf).where("error IS NULL")
    return ingest.select_vectors(rows, "2").select("partition", "offset", "item.vector", "item.vectorDimension")


@query
def vector_documents(spark: SparkSession, sf: str) -> DataFrame:
    return stages.documents(spark, sf).drop("timestamp")


@query
def generic_documents(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.generic_documents(stages.decoded(spark, sf), ["id", "assetId", "version", "time"])


@query
def vector_valid(spark: SparkSession, sf: str) -> DataFrame:
    rows = ingest.select_vectors(stages.decoded(spark, sf).where("error IS NULL"), "1").where("item IS NOT NULL")
    return rows.select("partition", "offset", V.is_valid(F.col("item.vector"), F.col("item.vectorDimension")).alias("valid"))


@query
def vector_status(spark: SparkSession, sf: str) -> DataFrame:
    return stages.messages(spark, sf).select("partition", "offset", "vector.status", "vector.bytes", "vector.dimension")


@query
def parse_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = stages.decoded(spark, sf).where("error IS NULL")
    return rows.select("partition", "offset", X.format_time(X.parse_time(F.col("body.time"))).alias("parsed"))


@query
def parse_version(spark: SparkSession, sf: str) -> DataFrame:
    rows = stages.decoded(spark, sf).where("error IS NULL")
    return rows.select("partition", "offset", X.parse_version(F.col("body.version")).alias("version"))


@query
def preview_values(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    return rows.select("doc_id", X.truncate(F.col("text"), 80).alias("short"), X.preview(F.col("text"), 200).alias("preview"))


# Scans with limits


@query
def limited_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = stages.decoded(spark, sf)
    matched = F.col("error").isNull() & ingest.matches_type("140")
    return profile.first_rows(rows, 1000, matched).select("partition", "offset")


@query
def sample_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows = stages.decoded(spark, sf).where(F.col("error").isNull() & ingest.matches_type("140"))
    return rows.orderBy("partition", "offset").limit(10).select("partition", "offset", "payload")


@query
def first_match(spark: SparkSession, sf: str) -> DataFrame:
    rows = stages.valid_documents(spark, sf)
    return profile.first_match(rows.select("row_key", "partition", "offset", "version", "time"))


@query
def latest_by_version(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.latest_by_version(
        stages.valid_documents(spark, sf), ["partition", "offset", "version", "time", "modelName", "summary", "vector"]
    )


# Profile


@query
def scan_totals(spark: SparkSession, sf: str) -> DataFrame:
    return profile.scan_totals(stages.decoded(spark, sf))


@query
def type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.type_counts(stages.decoded(spark, sf))


@query
def duplicate_stats(spark: SparkSession, sf: str) -> DataFrame:
    return profile.duplicate_stats(stages.messages(spark, sf))


@query
def top_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return profile.top_duplicates(stages.messages(spark, sf))


@query
def missing_asset(spark: SparkSession, sf: str) -> DataFrame:
    return profile.missing_asset_examples(stages.messages(spark, sf)).select("partition", "offset")


@query
def vector_item_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.vector_item_counts(stages.messages(spark, sf))


@query
def vector_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.vector_status_counts(stages.messages(spark, sf))


@query
def vector_list_totals(spark: SparkSession, sf: str) -> DataFrame:
    return profile.vector_list_totals(stages.messages(spark, sf))


@query
def vector_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.vector_type_counts(stages.messages(spark, sf))


@query
def vector_dim_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.vector_dim_counts(profile.list_items(stages.messages(spark, sf)))


@query
def vector_type_status(spark: SparkSession, sf: str) -> DataFrame:
    return profile.vector_type_status(profile.list_items(stages.messages(spark, sf)))


@query
def type_subtotal(spark: SparkSession, sf: str) -> DataFrame:
    return profile.type_subtotal(profile.list_items(stages.messages(spark, sf)))


@query
def counter_listing(spark: SparkSession, sf: str) -> DataFrame:
    """All counters of the profile, in their printed order."""
    messages, items = stages.messages(spark, sf), profile.list_items(stages.messages(spark, sf))
    per_type = materialize(profile.vector_type_counts(messages), "type-counts")
    per_status = materialize(profile.vector_type_status(items), "type-status")  # the vectors of the items are looked at once
    types = profile.type_counts(stages.decoded(spark, sf))
    return profile.listing([
        profile.counter(types, "type", "type", n=F.col("messages")),
        profile.counter(messages, "item type", "item_type"),
        *[profile.counter(messages, name, f"vector.{name}") for name in ("status", "bytes", "dimension")],
        *[profile.counter(per_type, f"list {name}", "type", n=F.col(name)) for name in ("items", "messages", "assets")],
        profile.counter(profile.vector_dim_counts(items), "list declared", "dimension", "type", F.col("items")),
        *[profile.counter(per_status, f"list {name}", name, "type", F.col("items")) for name in ("status", "bytes", "dimension")],
    ])


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """The stored rows with a key; keys are unique."""
    return load(spark, sf, "asset_table").where(X.is_present(F.col("row_key")))


@query
def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_profile(load(spark, sf, "asset_table"))


@query
def table_profile_limited(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_profile(_stored(spark, sf), limit=1000)


@query
def table_samples(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_samples(_stored(spark, sf), size=5, limit=8)


@query
def table_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON summary, written and read back."""
    path = new_path(spark, "table-summary")
    files.write_json(profile.table_summary(_stored(spark, sf)), path)
    entry = "struct<row_key:string,columns:map<string,string>>"
    shape = f"row_count bigint, empty_rows bigint, unique_columns array<string>, column_presence map<string,bigint>, samples array<{entry}>, truncated boolean"
    rows = spark.read.schema(shape).json(path)
    counts = F.transform("unique_columns", lambda c: F.concat(c, F.lit("="), F.element_at("column_presence", c).cast("string")))
    return rows.select(
        "row_count", "empty_rows", F.array_join("unique_columns", ",").alias("unique_columns"), F.array_join(counts, ",").alias("presence"),
        F.to_json("samples").alias("samples"), "truncated",
    )


@query
def encoded_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rows as cells, nested values as JSON, and their columns without the family."""
    rows = _stored(spark, sf).select(
        "row_key", "assetId", F.struct("version", "modelName").alias("meta"), F.array_compact(F.array("assert_id", "summary")).alias("labels"),
    )
    return tables.listed_cells(tables.row_cells(rows))


# Upserts


@query
def write_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    statuses = upsert.guard_status(stages.valid_documents(spark, sf)).select("status")
    invalid = stages.documents(spark, sf).where("reject_reason IS NOT NULL").select(F.lit(upsert.INVALID).alias("status"))
    return statuses.unionByName(invalid).groupBy("status").agg(F.count(F.lit(1)).alias("messages"))


@query
def guarded_upsert(spark: SparkSession, sf: str) -> DataFrame:
    documents = stages.valid_documents(spark, sf)
    return upsert.guarded_upsert(documents, ingest.subset_fields(documents), operate_time="2024-01-01 00:00:00")


@query
def guarded_upsert_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """The same table with keys of over 500 rows cut into chunks, as keys of over a million rows are by default."""
    documents = stages.valid_documents(spark, sf)
    return upsert.guarded_upsert(documents, ingest.subset_fields(documents), hot_rows=500)


def _written_limit(spark: SparkSession, sf: str, hot_rows: int, chunk_rows: int) -> DataFrame:
    documents = stages.valid_documents(spark, sf)
    fields = ingest.subset_fields(documents)
    statuses = materialize(upsert.guard_status(documents, hot_rows=hot_rows, presence=fields), "statuses")
    return upsert.current_rows(documents, profile.first_written(statuses, 700, chunk_rows), fields)


@query
def written_limit(spark: SparkSession, sf: str) -> DataFrame:
    """The table after a run that stops with its 700th written row."""
    return _written_limit(spark, sf, upsert.HOT_ROWS, 1_000_000)


@query
def written_limit_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """The same with small chunks, as larger topics and keys have."""
    return _written_limit(spark, sf, 500, 100)


@query
def column_merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    stored = load(spark, sf, "asset_table").where(X.is_present(F.col("row_key")))
    hits = reconcile.package_hits(load(spark, sf, "document_index"))
    incoming, cells = reconcile.enrich_parts(reconcile.asset_ids(stored), hits, ["name", "category"])
    return upsert.column_merge(stored, incoming, cells=cells.withColumn("summary", F.col("category")))


@query
def verify_rows(spark: SparkSession, sf: str) -> DataFrame:
    documents = stages.valid_documents(spark, sf)
    fields = ingest.subset_fields(documents)
    first = profile.first_match(documents)
    return reconcile.verify_rows(first, upsert.guarded_upsert(documents, fields), fields)


@query
def verify_latest(spark: SparkSession, sf: str) -> DataFrame:
    documents = stages.valid_documents(spark, sf)
    fields = ingest.subset_fields(documents)
    return reconcile.verify_rows(upsert.latest_by_version(documents, fields), upsert.guarded_upsert(documents, fields), fields)


@query
def verify_union(spark: SparkSession, sf: str) -> DataFrame:
    """The same over the columns of either side: the stored row also has the time of the run."""
    documents = stages.valid_documents(spark, sf)
    fields = ingest.subset_fields(documents)
    stored = upsert.guarded_upsert(documents, fields, operate_time=OPERATE_TIME)
    mapped = upsert.latest_by_version(documents, fields)
    return reconcile.verify_rows(mapped, stored, list(dict.fromkeys([*fields, *(c for c in stored.columns if c != "row_key")])))


@query
def verify_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.verify_totals(verify_latest(spark, sf))


# Reconciliation


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.asset_ids(load(spark, sf, "asset_table"))


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.package_hits(load(spark, sf, "document_index"))


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.id_summary(_ids(spark, sf), load(spark, sf, "document_index"))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.program_pairs(_ids(spark, sf), _hits(spark, sf))


@query
def asset_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _ids(spark, sf)


@query
def distinct_ids(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.distinct_ids(_ids(spark, sf))


@query
def relation_join(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.relation_join(_ids(spark, sf), _hits(spark, sf).select("asset_id", "doc_id", "program_id"))


@query
def missing_ids(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.missing_ids(_ids(spark, sf), _hits(spark, sf))


@query
def missing_diagnosis(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.missing_diagnosis(_summary(spark, sf))


@query
def multi_program(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.multi_program(_pairs(spark, sf))


@query
def multi_asset(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.multi_asset(_pairs(spark, sf))


@query
def relation_report(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.relation_report(_ids(spark, sf), load(spark, sf, "document_index"))


@query
def relation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.relation_summary(_ids(spark, sf), _summary(spark, sf), _pairs(spark, sf))


@query
def relation_examples(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.relation_examples(_summary(spark, sf))


@query
def relation_example_lists(spark: SparkSession, sf: str) -> DataFrame:
    everything = reconcile.package_hits(load(spark, sf, "document_index"), None)
    return reconcile.example_lists(_summary(spark, sf), everything, _pairs(spark, sf), limit=10)


@query
def limited_ids(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.asset_ids(_stored(spark, sf), limit=500)


@query
def document_report(spark: SparkSession, sf: str) -> DataFrame:
    table = _stored(spark, sf)
    return reports.document_report(table, reconcile.asset_ids(table), load(spark, sf, "document_index"), size=3)


@query
def relation_values(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.field_values(_hits(spark, sf), list(reconcile.REPORT_FIELDS))


@query
def enrich_fields(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.enrich_fields(_ids(spark, sf), _hits(spark, sf), list(MERGE_FIELDS))


@query
def merge_report(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.merge_report(_ids(spark, sf), _hits(spark, sf), list(MERGE_FIELDS))


@query
def merge_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.merge_summary(_ids(spark, sf), _hits(spark, sf), list(MERGE_FIELDS))


# Charts


def _charts(spark: SparkSession, sf: str) -> DataFrame:
    def build() -> DataFrame:
        return charts.chart_messages(ingest.decode_messages(load(spark, sf, "chart_topic"), charts.CHART_BODY))

    return stages.stage(spark, sf, "chart_messages", build)


@query
def content_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return charts.content_rejects(ingest.decode_messages(load(spark, sf, "chart_content_topic"), charts.CHART_BODY))


def _contents(spark: SparkSession, sf: str) -> DataFrame:
    def build() -> DataFrame:
        return charts.content_messages(ingest.decode_messages(load(spark, sf, "chart_content_topic"), charts.CHART_BODY))

    return stages.stage(spark, sf, "content_messages", build)


@query
def classify_operation(spark: SparkSession, sf: str) -> DataFrame:
    return _charts(spark, sf).groupBy("operation", "class").agg(F.count(F.lit(1)).alias("messages"))


@query
def route_table(spark: SparkSession, sf: str) -> DataFrame:
    return _charts(spark, sf).groupBy("target").agg(F.count(F.lit(1)).alias("messages"))


@query
def chart_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rows = _charts(spark, sf).where("reject_reason IS NOT NULL")
    return rows.select("partition", "offset", "reject_reason")


@query
def class_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rows = charts.class_rollup(_charts(spark, sf), F.col("chart.contentClasses"))
    return rows.select("partition", "offset", "content_classes", *charts.CLASS_COLUMNS)


@query
def chart_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return charts.chart_upsert(_charts(spark, sf), OPERATE_TIME)


@query
def chart_content_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return charts.content_upsert(_contents(spark, sf), OPERATE_TIME)


@query
def mark_old_offline(spark: SparkSession, sf: str) -> DataFrame:
    messages = _contents(spark, sf)
    writes = charts.index_writes(messages)
    return charts.mark_old_offline(charts.old_marks(messages, writes), writes)


@query
def chart_index(spark: SparkSession, sf: str) -> DataFrame:
    return charts.chart_index(_contents(spark, sf), OPERATE_TIME)


@query
def index_rows(spark: SparkSession, sf: str) -> DataFrame:
    return charts.index_rows(charts.chart_index(_contents(spark, sf), OPERATE_TIME))


# Status


def _envelopes(spark: SparkSession, sf: str) -> DataFrame:
    def build() -> DataFrame:
        rows = status.status_envelope(load(spark, sf, "status_topic"), CHANNELS)
        return status.widget_room_status(rows, load(spark, sf, "competition_table"), load(spark, sf, "season_table"))

    return stages.stage(spark, sf, "status_messages", build)


def _ondemand(spark: SparkSession, sf: str) -> DataFrame:
    return stages.stage(spark, sf, "ondemand_messages", lambda: status.ondemand_filter(load(spark, sf, "ondemand_topic")))


def _accepted(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of both topics that pass the gate; the topics have separate version keys."""
    def build() -> DataFrame:
        columns = ["kind", "partition", "offset", "doc_id", "version", "time", "offline"]
        shown = status.version_gate(_envelopes(spark, sf)).select(*columns)
        return shown.unionByName(status.version_gate(_ondemand(spark, sf)).select(*columns))

    return stages.stage(spark, sf, "accepted_status", build)


@query
def status_envelope(spark: SparkSession, sf: str) -> DataFrame:
    rows = status.status_envelope(load(spark, sf, "status_topic"), CHANNELS)
    return rows.select("partition", "offset", "kind", "doc_id", "version", "number_zero", "b.title",
                       F.try_variant_get("b.roomStatus", "$", "string").alias("roomStatus"))


@query
def status_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return status.rejects(status.classify_envelopes(load(spark, sf, "status_topic"), CHANNELS), PREVIEW)


@query
def ondemand_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return status.rejects(status.classify_ondemand(load(spark, sf, "ondemand_topic")), PREVIEW)


@query
def widget_status(spark: SparkSession, sf: str) -> DataFrame:
    return _envelopes(spark, sf).where("kind = 'widget'").select("partition", "offset", "doc_id", "status", "offline")


@query
def room_status(spark: SparkSession, sf: str) -> DataFrame:
    return _envelopes(spark, sf).where("kind = 'room'").select("partition", "offset", "doc_id", "status", "offline")


@query
def ondemand_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _ondemand(spark, sf).select("partition", "offset", "type", "doc_id", "version")


@query
def ondemand_status(spark: SparkSession, sf: str) -> DataFrame:
    return _ondemand(spark, sf).where("offline").select("partition", "offset", "doc_id")


@query
def version_gate(spark: SparkSession, sf: str) -> DataFrame:
    return _accepted(spark, sf).select("kind", "partition", "offset", "doc_id", "version")


@query
def offline_events(spark: SparkSession, sf: str) -> DataFrame:
    return status.offline_events(_accepted(spark, sf), load(spark, sf, "program_table"), UPDATE_TIME)


@query
def status_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return status.status_fanout(status.offline_ids(_accepted(spark, sf)), load(spark, sf, "program_table"), UPDATE_TIME)


@query
def cache_invalidate(spark: SparkSession, sf: str) -> DataFrame:
    cache = load(spark, sf, "program_table").select(F.concat(F.lit(CACHE_PREFIX), "row_key").alias("cache_key"))
    return status.cache_invalidate(cache, status.offline_ids(_accepted(spark, sf)), CACHE_PREFIX)


@query
def offline_heartbeat(spark: SparkSession, sf: str) -> DataFrame:
    return status.offline_heartbeat(offline_events(spark, sf))


@query
def expire_offline_set(spark: SparkSession, sf: str) -> DataFrame:
    rooms = _envelopes(spark, sf).where("kind = 'room'")
    cell = F.array("doc_id", F.col("version").cast("string"), F.concat(F.lit("x"), "doc_id"), (F.col("version") - 1).cast("string"))
    lists = rooms.select(arrival().alias("seq"), cell.alias("cell"))
    return status.expire_scored(status.decode_scored(lists), NOW_MS)


# Streams


@query
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    path, schema = land(spark, sf, "vector_topic")
    documents = ingest.ingest(topics.stream_files(spark, path, schema))
    return jobs.run_available(documents.select("partition", "offset", "row_key", "reject_reason"), "stream-ingest")


@query
def stream_guarded_upsert(spark: SparkSession, sf: str) -> DataFrame:
    path, schema = land(spark, sf, "vector_topic")
    documents = ingest.ingest(topics.stream_files(spark, path, schema)).where("reject_reason IS NULL")
    return jobs.guard_in_batches(documents)


@query
def stream_version_gate(spark: SparkSession, sf: str) -> DataFrame:
    path, schema = land(spark, sf, "ondemand_topic")
    messages = status.ondemand_filter(topics.stream_files(spark, path, schema))
    return jobs.gate_in_batches(messages)


@query
def stream_upsert_table(spark: SparkSession, sf: str) -> DataFrame:
    """The table of the guarded upsert out of the change log of a stream that was stopped and started again."""
    log, checkpoint = new_path(spark, "change-log"), new_path(spark, "change-log-checkpoint")

    def run(topic: DataFrame) -> None:
        documents = ingest.ingest(topic).where("reject_reason IS NULL")
        jobs.run_available(gates.upsert_stream(documents, list(ingest.DEFAULT_FIELDS)), "change-log", log, checkpoint)

    stages.in_parts(spark, sf, "vector_topic", run, stages.PART_ROWS)
    table = gates.latest_rows(spark.read.parquet(log))
    return table.withColumn("operate_time", F.lit(OPERATE_TIME))


def _propagated(spark: SparkSession, sf: str) -> list[str]:
    """The roots of the outputs of both status streams, run once in a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _roots:
        programs = load(spark, sf, "program_table")
        sides = load(spark, sf, "competition_table"), load(spark, sf, "season_table")
        shown, demanded = new_path(spark, "status-outputs"), new_path(spark, "ondemand-outputs")

        def run_shown(topic: DataFrame) -> None:
            messages = status.widget_room_status(status.status_envelope(topic, CHANNELS), *sides)
            jobs.propagate_status(messages, programs, shown, UPDATE_TIME, CACHE_PREFIX)

        def run_demanded(topic: DataFrame) -> None:
            jobs.propagate_status(status.ondemand_filter(topic), programs, demanded, UPDATE_TIME, CACHE_PREFIX)

        stages.in_parts(spark, sf, "status_topic", run_shown)
        stages.in_parts(spark, sf, "ondemand_topic", run_demanded)
        _roots[key] = [shown, demanded]
    return _roots[key]


_roots: dict[tuple[str, str], list[str]] = {}


@query
def stream_offline_events(spark: SparkSession, sf: str) -> DataFrame:
    shown, demanded = (jobs.read_output(spark, root, "events") for root in _propagated(spark, sf))
    return shown.unionByName(demanded)


@query
def stream_status_fanout(spark: SparkSession, sf: str) -> DataFrame:
    shown, demanded = (jobs.store_updates(spark, root) for root in _propagated(spark, sf))
    return shown.unionByName(demanded)


@query
def stream_status_rejects(spark: SparkSession, sf: str) -> DataFrame:
    path, schema = land(spark, sf, "status_topic")
    rejected = status.rejects(status.classify_envelopes(topics.stream_files(spark, path, schema), CHANNELS), PREVIEW)
    return jobs.run_available(rejected, "stream-rejects")
