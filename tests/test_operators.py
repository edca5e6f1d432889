"""Keyed operators against step-by-step models on random and on skewed input."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from assetweave.functions import search
from assetweave.operators import charts, ingest, profile, reconcile, reports, scan, status, upsert
from assetweave.operators.scan import places
from assetweave.plans import stages
from assetweave.session import expect_long_values, materialize
from assetweave.sinks import files
from assetweave.sources import tables
from assetweave.streaming import gates, jobs

DOC = "row_key string, partition int, offset long, version string, time string, source string"


def random_documents(seed: int, rows: int = 1500, long: bool = False):
    """Half of the rows belong to one key; versions and times are late, repeated, missing or unreadable."""
    rng = random.Random(seed)
    versions = [None, "n/a", "1", "2", "3", "4", "-7", "02", "123456789012345678901234567890"] if long else [None, "n/a", "1", "2", "3", "4"]
    times = [None, "soon", "2024-01-01 00:00:01", "2024-01-01 00:00:02", "2024-01-01 00:00:03"]
    return [
        ("hot" if rng.random() < 0.5 else f"k{rng.randrange(60)}", n % 3, n // 3, rng.choice(versions), rng.choice(times), rng.choice([None, f"s{n}"]))
        for n in range(rows)
    ]


def model(documents, stored=None):
    state = {k: dict(v) for k, v in (stored or {}).items()}
    out = {}
    version = lambda v: int(v) if v and v.lstrip("-").isdigit() else None
    time = lambda t: t if t and t[0] == "2" else None
    for key, partition, offset, v, t, source in sorted(documents, key=lambda d: (d[1], d[2])):
        row = state.setdefault(key, {})
        ev, et, iv, it = version(row.get("version")), time(row.get("time")), version(v), time(t)
        if ev is not None and iv is None:
            result = upsert.MISSING_VERSION
        elif ev is not None and iv < ev:
            result = upsert.OLD_VERSION
        elif (ev is None or iv == ev) and it and et and it < et:
            result = upsert.OLD_TIME
        else:
            result = upsert.WRITTEN
            row.update({c: x for c, x in (("version", v), ("time", t), ("source", source)) if x is not None})
        out[(key, (partition << 48) + offset)] = result
    return out, state


def statuses(df):
    return {(r["row_key"], r["arrival"]): r["status"] for r in df.collect()}


def test_guard_equals_model_with_and_without_hot_keys(spark):
    for seed in (1, 2):
        documents = random_documents(seed, long=seed == 1)
        df = spark.createDataFrame(documents, DOC)
        expected, state = model(documents)
        assert statuses(upsert.guard_status(df)) == expected
        assert statuses(upsert.guard_status(df, hot_rows=40)) == expected
    rows = upsert.guarded_upsert(df, ["version", "time", "source"], hot_rows=40).collect()
    assert {r["row_key"]: {c: r[c] for c in ("version", "time", "source") if r[c] is not None} for r in rows} == {
        k: v for k, v in state.items()}


def test_guard_on_top_of_stored_rows(spark):
    stored = {"hot": {"version": "3", "time": "2024-01-01 00:00:02"}, "k1": {"version": "n/a", "time": "2024-01-01 00:00:03"}, "other": {"version": "1"}}
    documents = random_documents(3, 400)
    expected, state = model(documents, stored)
    table = spark.createDataFrame([(k, v.get("version"), v.get("time")) for k, v in stored.items()], "row_key string, version string, time string")
    df = spark.createDataFrame(documents, DOC)
    assert statuses(upsert.guard_status(df, table, hot_rows=50)) == expected
    rows = upsert.guarded_upsert(df, ["version", "time", "source"], table).collect()
    assert {r["row_key"]: r["version"] for r in rows} == {k: v.get("version") for k, v in state.items()}


def test_streaming_upsert_equals_batch_in_any_number_of_batches(spark, tmp_path):
    documents = sorted(random_documents(4, 600), key=lambda d: (d[1], d[2]))
    expected, _ = model(documents)
    for parts in (1, 3):
        source, size = str(tmp_path / f"in{parts}"), -(-len(documents) // parts)
        checkpoint, path = str(tmp_path / f"cp{parts}"), str(tmp_path / f"out{parts}")
        for n in range(parts):
            spark.createDataFrame(documents[n * size:(n + 1) * size], DOC).coalesce(1).write.mode("append").parquet(source)
            stream = gates.guard_stream(spark.readStream.schema(DOC).parquet(source))
            out = jobs.run_available(stream, "guard", path, checkpoint)
        assert statuses(out) == expected


def test_streaming_table_equals_batch_in_any_number_of_batches(spark, tmp_path):
    documents = sorted(random_documents(14, 600, long=True), key=lambda d: (d[1], d[2]))
    _, state = model(documents)
    columns = ["version", "time", "source"]
    for parts in (1, 3):
        source, size = str(tmp_path / f"in{parts}"), -(-len(documents) // parts)
        checkpoint, path = str(tmp_path / f"cp{parts}"), str(tmp_path / f"out{parts}")
        for n in range(parts):  # every part is a new run that goes on from the state of the one before
            spark.createDataFrame(documents[n * size:(n + 1) * size], DOC).coalesce(1).write.mode("append").parquet(source)
            log = jobs.run_available(gates.upsert_stream(spark.readStream.schema(DOC).parquet(source), columns), "log", path, checkpoint)
        rows = {r["row_key"]: {c: r[c] for c in columns if r[c] is not None} for r in gates.latest_rows(log).collect()}
        assert rows == state
        assert log.groupBy("row_key").count().where(f"count > {parts}").count() == 0  # one row for a key and batch at most
    written = sum(v == upsert.WRITTEN for v in model(documents)[0].values())
    assert log.agg(F.sum("writes")).first()[0] == written


def test_large_batches_equal_the_model(spark, tmp_path):
    documents = sorted(random_documents(6, 600), key=lambda d: (d[1], d[2]))
    expected, _ = model(documents)
    source, root = str(tmp_path / "in"), str(tmp_path / "guard")
    for part in (documents[:250], documents[250:]):
        spark.createDataFrame(part, DOC).coalesce(1).write.mode("append").parquet(source)
        out = jobs.guard_in_batches(spark.readStream.schema(DOC).parquet(source), root, hot_rows=40)
    assert statuses(out) == expected


def test_streaming_gate_equals_batch(spark, tmp_path):
    rng = random.Random(5)
    rows = [("a" if rng.random() < 0.6 else f"d{rng.randrange(9)}", 0, n, rng.randrange(6)) for n in range(300)]
    schema = "doc_id string, partition int, offset long, version long"
    df = spark.createDataFrame(rows, schema)
    batch = sorted(tuple(r) for r in status.version_gate(df, hot_rows=20).select("doc_id", "offset", "version").collect())
    highest, expected = {}, []
    for doc, _, offset, version in rows:
        if version >= highest.get(doc, version):
            highest[doc] = version
            expected.append((doc, offset, version))
    assert batch == sorted(expected)
    df.write.parquet(str(tmp_path / "in"))
    stream = gates.gate_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    assert sorted((r["doc_id"], r["arrival"], r["version"]) for r in jobs.run_available(stream, "gate").collect()) == sorted(expected)


def test_gate_sees_one_row_for_a_hot_key_and_batch(spark):
    rows = [("hot", n, n * 7919 % 1009) for n in range(5000)] + [(f"d{n}", n, 5) for n in range(50)]
    df = spark.createDataFrame(rows, "doc_id string, arrival long, version long").coalesce(1)
    runs = {r["doc_id"]: [(m["arrival"], m["version"]) for m in r["run"]] for r in gates.highest_so_far(df).collect()}
    assert len(runs) == 51 and len(runs["hot"]) < 20 and runs["d7"] == [(7, 5)]
    assert runs["hot"] == sorted(runs["hot"]) and [v for _, v in runs["hot"]] == sorted(v for _, v in runs["hot"])


MESSAGE = "kind string, doc_id string, partition int, offset long, version long, time string, offline boolean"


def status_messages(seed, rows):
    rng = random.Random(seed)
    return [(rng.choice(["widget", "room", "ondemand"]), "hot" if rng.random() < 0.4 else f"d{rng.randrange(12)}", 0, n, rng.randrange(9) + n // 40,
             f"2024-01-01 00:00:{n % 60:02d}", rng.random() < 0.6) for n in range(rows)]


def everything(spark, root):
    names = ("accepted", "offline", "events", "stores", "cache_deletes", "markers")
    return {n: sorted(map(str, spark.read.parquet(f"{root}/{n}").collect())) for n in names}


def test_status_outputs_equal_the_batch_job_and_repeat_without_change(spark, tmp_path):
    rows, root, source = status_messages(8, 400), str(tmp_path / "out"), str(tmp_path / "in")
    programs = spark.createDataFrame([("hot", "pendant"), *[(f"d{n}", ("pendant", "newLive", "vod")[n % 3]) for n in range(10)]], "row_key string, doc_type string")
    for start in (0, 150, 300):
        spark.createDataFrame(rows[start:start + 150], MESSAGE).coalesce(1).write.mode("append").parquet(source)
        jobs.propagate_status(spark.readStream.schema(MESSAGE).parquet(source), programs, root, 5, "c:")
    accepted = status.version_gate(spark.createDataFrame(rows, MESSAGE))
    order = ["kind", "doc_id", "partition", "offset", "version", "time"]
    events = jobs.read_output(spark, root, "events")
    wanted = status.offline_events(accepted, programs, 5)
    assert sorted(map(tuple, events.select(*order, "update_time").collect())) == sorted(map(tuple, wanted.select(*order, "update_time").collect()))
    fanout = status.status_fanout(status.offline_ids(accepted), programs, 5)
    plain = lambda df: sorted(str(tuple(r)) for r in df.select(*fanout.columns).collect())
    assert plain(jobs.store_updates(spark, root)) == plain(fanout)
    gone = status.cache_keys(status.offline_ids(accepted), "c:")
    assert {r[0] for r in jobs.read_output(spark, root, "cache_deletes").collect()} == {r[0] for r in gone.collect()}

    before = everything(spark, root)
    repeated = spark.read.parquet(f"{root}/accepted").where("batch = 1").drop("batch")
    from assetweave.session import materialize

    jobs.write_status_batch(materialize(repeated), 1, programs, root, 5, "c:")  # as after a failure before the commit
    assert everything(spark, root) == before


def test_parts_of_a_topic_are_bounded_and_keep_its_order(spark, tmp_path, monkeypatch):
    topic = spark.createDataFrame([(n % 2, n // 2 * (1000 if n > 50 else 1)) for n in range(100)], "partition int, offset long")
    monkeypatch.setattr(stages, "load", lambda *_: topic)
    monkeypatch.setattr(stages, "new_path", lambda *_: str(tmp_path / "parts"))
    seen = []

    def run(stream):
        rows = {tuple(r) for r in spark.read.schema(topic.schema).parquet(str(tmp_path / "parts")).collect()}
        seen.append(sorted(rows - {r for part in seen for r in part}))

    stages.in_parts(spark, "sf", "topic", run, part_rows=20)
    assert [r for part in seen for r in part] == sorted(tuple(r) for r in topic.collect())
    assert len([part for part in seen if part]) >= 6 and max(map(len, seen)) <= 25


def test_a_topic_is_dealt_out_to_its_parts_once(spark, tmp_path, monkeypatch):
    """No part reads the whole topic, and rows that belong to no part (another partition) do not arrive."""
    topic = spark.createDataFrame([(n % 5, n // 5, f"v{n}") for n in range(200)], "partition int, offset long, value string")
    monkeypatch.setattr(stages, "load", lambda *_: topic)
    monkeypatch.setattr(stages, "new_path", lambda *_: str(tmp_path / "parts"))
    runs = []
    stages.in_parts(spark, "sf", "topic", runs.append, part_rows=10)
    dealt = sorted(int(f.name.split("=")[1]) for f in (tmp_path / "parts-dealt").glob("_part=*"))
    assert dealt == list(range(len(runs))) and len(runs) == 16
    arrived = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "parts")).collect())
    assert arrived == sorted(tuple(r) for r in topic.where("partition < 4").collect())
    assert not list((tmp_path / "parts-dealt").glob("_part=__HIVE*"))


def test_a_stream_has_state_partitions_by_cores(spark, tmp_path):
    documents = spark.createDataFrame([(f"k{n % 7}", 0, n, str(n), None, f"s{n}") for n in range(50)], DOC)
    documents.write.parquet(str(tmp_path / "documents"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        stream = spark.readStream.schema(documents.schema).parquet(str(tmp_path / "documents"))
        log = jobs.run_available(gates.upsert_stream(stream, ["source"]), "log", str(tmp_path / "log"), str(tmp_path / "checkpoint"))
        assert {tuple(r) for r in gates.latest_rows(log).collect()} == {(f"k{n % 7}", f"s{n}") for n in range(43, 50)}
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    partitions = [f.name for f in (tmp_path / "checkpoint" / "state" / "0").iterdir() if f.name.isdigit()]
    assert len(partitions) == 2 * spark.sparkContext.defaultParallelism


def test_counts_by_dimension_do_not_look_at_vectors(spark):
    item = "named_struct('is_object', true, 'type', '1', 'declared', '8', 'vector', 'AAAA', 'is_string', true)"
    rows = spark.range(3).selectExpr("0 AS partition", "id AS offset", "'a' AS asset_id", f"array({item}) AS items")
    counts = profile.vector_dim_counts(profile.list_items(rows))
    assert [tuple(r) for r in counts.collect()] == [("1", "8", 3)]
    assert "A-Za-z0-9+/" not in counts._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("payload, kind, searched", [
    ({"data": {"vectorList": [{"type": "2"}, {"type": "1"}]}}, "2", False),
    ({"data": {"vectorList": [{"n": 1}, {"type": "1"}]}}, None, False),
    ({"data": {"type": "140", "vectorList": [{"type": "2"}]}}, "140", False),
    ({"data": {"vectorList": [{"type": "2"}], "type": "140"}}, "2", False),
    ({"data": {"vectorList": [{"type": 1.50}]}}, "1.5", True),
    ({"data": {"vectorList": [{"type": " {\"a\": 1}"}]}}, None, True),
    ({"data": {"vectorList": [{"type": "{\"type\": \"3\"}"}]}}, "3", True),
    ({"x": {"type": "7"}, "data": {"vectorList": [{"type": "2"}]}}, "7", True),
    ({"data": {"vectorList": [{"source": "type"}, {"type": "2"}]}}, None, True),
    ({"data": "{\"vectorList\": [{\"type\": \"5\"}]}"}, "5", True),
    ({"vectorItem": {"type": "9", "pad": "x" * 60}}, "9", True),
    ({"type": None, "data": {"type": "140"}}, None, False),
])
def test_a_nested_type_is_searched_for_only_where_known_members_do_not_explain_it(spark, payload, kind, searched):
    topic = spark.createDataFrame([(0, 0, json.dumps(payload))], "partition int, offset long, value string")
    for body in (ingest.VECTOR_BODY, profile.PROFILE_BODY):
        typed = ingest.resolve_type(ingest.decode_messages(topic, body))
        assert typed.first()["msg_type"] == kind
        mentioned = F.when(F.col("payload").isNotNull(), F.lit(str(payload).count("'type'")))
        known = ingest._known_type(typed, mentioned)
        if not searched and "type" not in payload:
            assert typed.select(known.alias("k")).first()["k"] is not None


def test_fields_of_documents_are_found_without_a_search(spark, monkeypatch):
    """The search gives what it gave; where known members explain every mention it gets no payload."""
    vector = "AAAA" * 16
    item = {"type": "1", "vector": "AAAAAA==", "vectorDimension": 1}
    cases = [
        ({"assetId": "a", "data": {"vectorList": [item]}}, "a", None),
        ({"data": {"asset_id": "b", "vectorList": [{**item, "modelName": ""}]}}, "b", None),
        ({"data": {"assetId": "c", "vectorList": [{"type": "2", "modelName": "m"}, item]}}, "c", "m"),
        ({"data": {"assetId": "d", "vectorList": [{"type": "2", "vector": vector}, item]}}, "d", None),
        ({"data": {"assert_id": "e", "vectorList": [item], "x": {"modelName": "n"}}}, "e", "n"),
    ]
    topic = spark.createDataFrame([(0, n, json.dumps({"type": "140", **c[0]})) for n, c in enumerate(cases)], "partition int, offset long, value string")
    searched = []
    monkeypatch.setattr(search, "search_fields", lambda payload, wanted, run=search.search_fields: searched.append(payload) or run(payload, wanted))
    rows = ingest.ingest(topic).orderBy("offset").collect()
    assert [(r["row_key"], r["modelName"]) for r in rows] == [c[1:] for c in cases] and len(searched) == 2


def test_the_gate_in_batches_goes_on_and_forgets_expired_versions(spark, tmp_path):
    rng = random.Random(9)
    rows = [("hot" if rng.random() < 0.6 else f"d{rng.randrange(9)}", 0, n, rng.randrange(6)) for n in range(300)]
    schema = "doc_id string, partition int, offset long, version long"
    for lifetime in (jobs.VERSION_LIFETIME_MS, 0):
        source, root = str(tmp_path / f"in{lifetime}"), str(tmp_path / f"out{lifetime}")
        highest, expected = {}, []
        for start in (0, 100, 200):
            highest = highest if lifetime else {}
            for doc, _, offset, version in rows[start:start + 100]:
                if version >= highest.get(doc, version):
                    highest[doc] = version
                    expected.append((doc, offset, version))
            spark.createDataFrame(rows[start:start + 100], schema).coalesce(1).write.mode("append").parquet(source)
            passed = jobs.gate_in_batches(spark.readStream.schema(schema).parquet(source), root, lifetime, hot_rows=20)
        assert sorted((r["doc_id"], r["arrival"], r["version"]) for r in passed.collect()) == sorted(expected)
        assert passed.columns == ["doc_id", "arrival", "version"]


def test_status_streams_ask_no_state_for_each_key(spark, tmp_path, monkeypatch):
    """The outputs of a batch cost no call for each of its keys."""
    monkeypatch.setattr(gates.VersionGate, "handleInputRows", None)
    rows, root, source = status_messages(3, 200), str(tmp_path / "out"), str(tmp_path / "in")
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.parquet(source)
    programs = spark.createDataFrame([("hot", "pendant")], "row_key string, doc_type string")
    jobs.propagate_status(spark.readStream.schema(MESSAGE).parquet(source), programs, root, 5, "c:", hot_rows=20)
    accepted = status.version_gate(spark.createDataFrame(rows, MESSAGE))
    assert jobs.read_output(spark, root, "accepted").count() == accepted.count()


def test_unusable_status_messages_are_rejected_with_a_reason(spark):
    whole = {"activityType": 0, "channel": "m", "mgdbId": "e", "mgdbStatus": 1, "version": "5", "data": json.dumps({"body": {"activityType": 0, "mgdbId": "w"}})}
    cases = [
        (json.dumps(whole), None), (None, "missing"), ("{", "not_json"), (json.dumps({**whole, "channel": "x"}), "other_channel"),
        (json.dumps({k: v for k, v in whole.items() if k != "channel"}), "other_channel"), (json.dumps({**whole, "data": "{"}), "no_body"),
        (json.dumps({**whole, "data": "{}"}), "no_body"), (json.dumps({**whole, "activityType": 9}), "other_activity"),
        (json.dumps({**whole, "data": json.dumps({"body": {"activityType": 0}})}), "missing_id"),
        (json.dumps({k: v for k, v in whole.items() if k != "mgdbStatus"}), "missing_status"), (json.dumps({**whole, "version": "new"}), "unreadable_version"),
    ]
    topic = spark.createDataFrame([(0, n, v) for n, (v, _) in enumerate(cases)], "partition int, offset long, value string")
    rows = status.classify_envelopes(topic, ["m"]).orderBy("offset").collect()
    assert [r["reject_reason"] for r in rows] == [c[1] for c in cases]
    assert status.rejects(status.classify_envelopes(topic, ["m"])).count() + status.status_envelope(topic, ["m"]).count() == len(cases)

    base = {"type": "217", "id": "i", "operation": "1", "version": "3", "data": {"productInfoPackageId": "141"}}
    cases = [
        (base, None), ({**base, "type": "9"}, "other_type"), ({**base, "operation": "off"}, "unreadable_operation"), ({**base, "data": {}}, "other_product"),
        ({**base, "data": {}, "operation": 2}, None), ({k: v for k, v in base.items() if k != "id"}, "missing_id"), ({**base, "version": "v"}, "unreadable_version"),
    ]
    topic = spark.createDataFrame([(0, n, json.dumps(v)) for n, (v, _) in enumerate(cases)], "partition int, offset long, value string")
    assert [r["reject_reason"] for r in status.classify_ondemand(topic).orderBy("offset").collect()] == [c[1] for c in cases]


def test_column_merge_keeps_unmentioned_columns(spark):
    old = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], "row_key string, p string, q string")
    new = spark.createDataFrame([("b", None, "n"), ("c", "3", None)], "row_key string, p string, r string")
    got = sorted(tuple(r) for r in upsert.column_merge(old, new).collect())
    assert got == [("a", "1", "x", None), ("b", "2", "y", "n"), ("c", "3", None, None)]


def test_table_merge_touches_only_needed_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(400).selectExpr("cast(id as string) row_key", "cast(id as string) v", "cast(null as int) w")
    files.write_table(rows, path, buckets=8)
    written = set((tmp_path / "table").rglob("part-*.parquet"))
    assert len(written) > 8  # more write tasks than partitions
    incoming = spark.createDataFrame([("5", "new", 1), ("x", "add", 2)], "row_key string, v string, w int")
    assert 1 <= files.merge_table(spark, path, incoming, buckets=8) <= 2
    kept = set((tmp_path / "table").rglob("part-*.parquet")) & written
    assert len({f.parent for f in kept}) >= 6
    got = {r["row_key"]: (r["v"], r["w"]) for r in spark.read.parquet(path).collect()}
    assert got == {**{str(n): (str(n), None) for n in range(400)}, "5": ("new", 1), "x": ("add", 2)}
    assert files.merge_table(spark, path, incoming.limit(0), buckets=8) == 0
    broken = incoming.selectExpr("row_key", "if(row_key = 'x', raise_error('no'), v) v", "w")
    with pytest.raises(Exception, match="no"):
        files.merge_table(spark, path, broken, buckets=8)
    assert {r["row_key"]: (r["v"], r["w"]) for r in spark.read.parquet(path).collect()} == got


def test_places_follow_the_order(spark):
    rng = random.Random(2)
    values = [(rng.randrange(40), f"k{n:03d}") for n in range(500)]
    df = spark.createDataFrame(values, "a int, b string").repartition(7)
    got = {(r["a"], r["b"]): r["place"] for r in places(df, [F.desc("a"), "b"]).collect()}
    assert got == {v: n for n, v in enumerate(sorted(values, key=lambda v: (-v[0], v[1])), 1)}
    assert places(df.limit(0), ["a"]).count() == 0


def test_table_profile_keeps_totals_and_says_when_it_was_cut(spark):
    bare = spark.createDataFrame([("a", None), ("b", None)], "row_key string, v string")
    assert [tuple(r) for r in profile.table_profile(bare).collect()] == [(2, 2, False, None, None)]
    assert tuple(profile.table_summary(bare).first())[:3] == (2, 2, [])
    assert [tuple(r) for r in profile.table_profile(bare.limit(0)).collect()] == [(0, 0, False, None, None)]
    rows = spark.range(50).selectExpr("format_string('%02d', id) row_key", "if(id < 20, 'x', null) v").repartition(5)
    for limit, present in ((1, 1), (20, 20), (30, 20), (50, 20)):
        got = {r["column"]: (r["row_count"], r["truncated"], r["present"]) for r in profile.table_profile(rows, limit=limit).collect()}
        assert got == {None: (limit, True, None), "v": (limit, True, present)}
    assert {r["truncated"] for r in profile.table_profile(rows, limit=51).collect()} == {False}


def test_report_of_nested_documents_and_of_all_documents(spark, tmp_path):
    documents = spark.createDataFrame(
        [(f"d{n}", "a", "p", "1", [{"x": 1, "y": None}] if n else [], {"z": "t"} if n == 1 else None) for n in range(4)],
        "doc_id string, assert_id string, program_id string, product_info_package_id string, parts array<struct<x:int,y:int>>, more struct<z:string>")
    table = spark.createDataFrame([("r1", "v"), ("r2", None)], "row_key string, version string")
    ids = spark.createDataFrame([("r1", "a"), ("r2", "none")], "row_key string, asset_id string")
    lines = reports.document_report(table, ids, documents, size=0).orderBy("row_key", "hit", "line_no").collect()
    first = [r["line"] for r in lines if r["row_key"] == "r1"]
    assert first[:6] == ["=== stored row ===", "row_key=r1", "assetId=a", "columns=version", "", "=== documents ==="]
    assert first[6] == "total=4 returned=4" and [x for x in first if x.startswith("---")] == [f"--- document {n} ---" for n in range(1, 5)]
    second = first[first.index("--- document 2 ---"):first.index("--- document 3 ---")]
    at = second.index("=== source field paths ===")
    assert second[at + 1:at + 7] == ["assert_id (string)", "more.z (string)", "parts (list[1])", "parts[0].x (int)", "product_info_package_id (string)", "program_id (string)"]
    assert json.loads(second[-2])["parts"] == [{"x": 1}]
    assert [r["line"] for r in lines if r["row_key"] == "r2"][-2:] == ["total=0 returned=0", "No document found for none."]
    files.write_report(reports.document_report(table, ids, documents, size=0), str(tmp_path / "report"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "report")).collect()) == sorted(r["line"] for r in lines)


def test_first_rows_cuts_at_the_matched_limit(spark):
    df = spark.range(500).selectExpr("cast(id % 2 as int) partition", "id div 2 as offset", "id % 5 = 0 as hit")
    everything = sorted((r["partition"], r["offset"], r["hit"]) for r in df.collect())
    for limit in (1, 7, 60):
        got = sorted((r["partition"], r["offset"]) for r in profile.first_rows(df, limit, F.col("hit"), chunk_rows=16).collect())
        hits = [n for n, r in enumerate(everything) if r[2]]
        assert got == [r[:2] for r in everything[:hits[limit - 1] + 1]]
    assert profile.first_rows(df, 9999, F.col("hit"), chunk_rows=16).count() == 500


def test_cells_are_given_in_full(spark):
    hits = spark.createDataFrame([("hot", f"p{n:03d}", "n") for n in range(500)] * 2 + [("x", "p2", None), ("x", "p1", " "), ("y", " ", None)],
                                 "asset_id string, program_id string, name string")
    every = "|".join(f"p{n:03d}" for n in range(500))
    cells = {r["asset_id"]: (r["program_id"], r["name"]) for r in reconcile.joined_values(hits, ["program_id", "name"]).collect()}
    assert cells == {"hot": (every, "n"), "x": ("p1|p2", None)}
    rows = spark.createDataFrame([("r1", "hot"), ("r2", "x"), ("r3", "none"), ("r4", "y")], "row_key string, asset_id string")
    report = {r["row_key"]: (r["hit_count"], r["write_status"], r["program_id"]) for r in reconcile.merge_report(rows, hits, ["program_id"]).collect()}
    assert report == {"r1": (1000, "written", every), "r2": (2, "written", "p1|p2"), "r3": (0, "not_found", ""), "r4": (1, "not_found", "")}
    assert {r["row_key"]: r["program_id"] for r in reconcile.enrich_fields(rows, hits, ["program_id"]).collect()} == {"r1": every, "r2": "p1|p2"}
    assert tuple(reconcile.merge_summary(rows, hits, ["program_id"]).first()) == (4, 3, 1, 2)
    assert sum(r["field"] == "program_id" for r in reconcile.field_values(hits, ["program_id", "name"]).collect()) == 502


def test_hot_ids_are_split(spark, tmp_path):
    """With half of the rows on one id, the joins of documents with ids are marked skewed and split."""
    hits = spark.range(60_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'hot' ELSE 'a' || id END AS assert_id", "'d' || id AS doc_id", "'p' || id % 40 AS program_id",
        "1 AS product_info_package_id", "repeat('n', 50) AS name",
    )
    hits.write.parquet(str(tmp_path / "docs"))
    spark.range(20_000).selectExpr("'r' || id AS row_key", "CASE WHEN id % 2 = 0 THEN 'hot' ELSE 'a' || id END AS asset_id").write.parquet(str(tmp_path / "rows"))
    documents, rows = spark.read.parquet(str(tmp_path / "docs")), spark.read.parquet(str(tmp_path / "rows"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = reconcile.package_hits(documents, None)
        queries = {
            "doc_lookup": reconcile.doc_lookup(documents, rows, None), "relation_join": reconcile.relation_join(rows, found),
            "relation_report": reconcile.relation_report(rows, documents, None),
            "enrich_fields": reconcile.enrich_fields(rows, found, ["name"]), "merge_report": reconcile.merge_report(rows, found, ["name"]),
            "multi_program": reconcile.multi_program(found.select("asset_id", F.col("doc_id").alias("program_id"))),
        }
        for name, df in queries.items():
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString(), name
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_long_cells_stream_past_their_rows(spark):
    """The rows of an id are never the built side of the join that gives each the id's long cell, however few they are, and an
    id with many rows is dealt out over tasks."""
    ids = spark.range(300).selectExpr("'r' || id AS row_key", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id = 1 THEN null ELSE 'a' || id % 7 END AS asset_id")
    hits = spark.range(500_000).selectExpr("CASE WHEN id < 9 THEN 'hot' ELSE 'a' || id END AS asset_id", "'d' || id AS doc_id", "'n' || id % 50 AS name")
    name = "|".join(sorted(f"n{n}" for n in range(9)))
    queries = {"enrich_fields": reconcile.enrich_fields(ids, hits, ["name"]), "merge_report": reconcile.merge_report(ids, hits, ["name"])}
    for query, df in queries.items():
        assert {r["name"] for r in df.where("row_key = 'r0'").collect()} == {name}, query
        df.write.format("noop").mode("overwrite").save()
        assert "BuildLeft" not in df._jdf.queryExecution().executedPlan().toString(), query
    shared = materialize(spark.createDataFrame([("hot", "x" * 1000), ("a1", "y"), ("b", "z")], "asset_id string, v string"))
    got = scan.fetch_shared(ids.unionAll(ids), shared, "asset_id", "row_key", share_rows=20)
    plain = ids.unionAll(ids).join(shared, "asset_id").select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    parts = got.where("asset_id = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


@pytest.fixture
def long_cells(spark, tmp_path):
    """Rows and documents of one id whose joined cell has 2 MB, and the bytes that some rows take as Parquet."""
    names = ["parquet.dictionary.page.size", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min"]
    hits = spark.range(60_000).selectExpr("'hot' AS asset_id", "'d' || id AS doc_id", "md5(cast(id AS string)) AS name", "'p' AS program_id", "1 AS product_info_package_id")
    rows = spark.range(160).selectExpr("'r' || id AS row_key", "'hot' AS asset_id")

    def written(df):
        df.write.parquet(str(tmp_path / "written"))
        back = spark.read.parquet(str(tmp_path / "written"))
        return back, sum(f.stat().st_size for f in (tmp_path / "written").glob("*.parquet"))

    yield rows, hits, written
    for name in names:
        spark.conf.unset(name)


def test_enriched_rows_share_a_long_cell_when_written(spark, long_cells):
    """A cell beyond the 1 MB of Parquet's default dictionary is kept once a file, not once a row."""
    rows, hits, written = long_cells
    back, size = written(reconcile.enrich_fields(rows, hits, ["name"]))
    assert back.agg(F.count("*"), F.min(F.char_length("name")), F.countDistinct("name")).first() == (160, 60_000 * 33 - 1, 1)
    assert size < 40_000_000
    assert spark.conf.get("parquet.block.size.row.check.min") == "33"


def test_merge_report_rows_share_a_long_cell_when_written(spark, long_cells):
    rows, hits, written = long_cells
    back, size = written(reconcile.merge_report(rows, hits, ["name"]))
    assert back.agg(F.count("*"), F.min(F.char_length("name")), F.countDistinct("name")).first() == (160, 60_000 * 33 - 1, 1)
    assert size < 40_000_000


def test_relation_report_lands_what_it_reports(spark, long_cells, monkeypatch):
    """Of an id with documents in the packages no text of all its documents is landed; written rows share their cell."""
    rows, hits, written = long_cells
    landed = {}
    monkeypatch.setattr(reconcile, "materialize", lambda df, name: landed.setdefault(name, materialize(df, name)))
    outside = hits.withColumns({"product_info_package_id": F.lit(9), "name": F.lit("other")})
    other = outside.limit(1).withColumn("asset_id", F.lit("o"))
    documents = hits.unionAll(outside).unionAll(other).withColumnRenamed("asset_id", "assert_id")
    asked = rows.unionAll(spark.sql("SELECT 'o1', 'o' UNION ALL SELECT 'z1', 'z' UNION ALL SELECT 'n1', null"))
    back, size = written(reconcile.relation_report(asked, documents))
    assert size < 40_000_000
    hot = back.where("asset_id = 'hot'")
    assert hot.agg(F.count("*"), F.min(F.char_length("names")), F.countDistinct("names")).first() == (160, 60_000 * 33 - 1, 1)
    assert tuple(hot.drop("row_key", "names").distinct().first()) == ("hot", "p", 1, 60_000, "1", 0, "", "", "")
    rest = {tuple(r) for r in back.where("row_key IN ('o1', 'z1', 'n1')").collect()}
    assert rest == {("o1", "o", "", 0, 0, "", "", 1, "9", "p", "other"), ("z1", "z", "", 0, 0, "", "", 0, "", "", ""),
                    ("n1", None, "", 0, 0, "", "", 0, "", "", "")}
    row = landed["documents-of-ids"].where("asset_id = 'hot'").first()
    assert sum(len(v) for v in row if isinstance(v, str)) < 60_000 * 33 + 100


def test_column_merge_shares_a_long_cell_when_written(spark, long_cells):
    rows, hits, written = long_cells
    incoming, cells = reconcile.enrich_parts(rows, hits, ["name"])
    back, size = written(upsert.column_merge(rows.select("row_key", F.lit("old").alias("name"), F.lit("s").alias("summary")), incoming, cells=cells))
    assert back.agg(F.count("*"), F.min(F.char_length("name")), F.countDistinct("name"), F.min("summary")).first() == (160, 60_000 * 33 - 1, 1, "s")
    assert size < 40_000_000


def test_long_values_leave_better_settings_alone(spark, long_cells):
    own = {"parquet.dictionary.page.size": "99000000", "parquet.page.size.row.check.min": "2"}
    for name, value in own.items():
        spark.conf.set(name, value)
    expect_long_values(spark, 3_000_000)
    assert {name: spark.conf.get(name) for name in own} == own
    assert spark.conf.get("parquet.block.size.row.check.min") == "22"
    spark.conf.unset("parquet.dictionary.page.size")
    expect_long_values(spark, 1000)
    assert spark.conf.get("parquet.dictionary.page.size", None) is None
    expect_long_values(spark, 9_000_000)  # a first page has several rows, or the dictionary is given up
    assert spark.conf.get("parquet.block.size.row.check.min") == "10"
    assert scan.longest_value(spark.createDataFrame([("é", None, 1), (None, "xyz", 2)], "a string, b string, n int")) == 3
    assert scan.longest_value(spark.range(3)) == 0


def test_report_lines_are_made_last(spark, monkeypatch):
    """What is landed and shuffled of a document are its fields, not the lines made of them."""
    landed = {}
    monkeypatch.setattr(reports, "materialize", lambda df, name: landed.setdefault(name, materialize(df, name)))
    table = spark.createDataFrame([("r1", "a"), ("r2", "a"), ("r3", "z")], "row_key string, assetId string")
    ids = table.withColumnRenamed("assetId", "asset_id")
    documents = spark.createDataFrame([("d1", "a", "p", "1", None), ("d2", "a", None, "9", "n"), ("d3", "b", "q", "1", "m")],
                                      "doc_id string, assert_id string, program_id string, product_info_package_id string, name string")
    lines = reports.document_report(table, ids, documents, size=1).where("row_key = 'r2' AND hit = 1").orderBy("line_no").collect()
    assert [r["line"] for r in lines][1:5] == ["--- document 1 ---", "_id=d1", "program_id=p", "assert_id=a"]
    assert lines[-1]["line"] == '{"assert_id":"a","product_info_package_id":"1","program_id":"p"}'
    assert not [f for f in landed["report-hits"].schema.fields if f.dataType.typeName() == "array"]


def test_column_merge_fetches_shared_cells(spark):
    stored = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y"), ("b", "4", "w"), ("c", "3", "z")], "row_key string, p string, q string")
    ids = spark.createDataFrame([("a", "i"), ("b", "i"), ("c", "none"), ("d", "j")], "row_key string, asset_id string")
    cells = materialize(spark.createDataFrame([("i", "P", None), ("j", None, "R")], "asset_id string, p string, r string"))
    got = upsert.column_merge(stored, ids, cells=cells)
    whole = upsert.column_merge(stored, ids.join(cells, "asset_id").drop("asset_id"))
    assert got.columns == whole.columns
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, whole.collect()), key=key)


def test_chart_contents_mark_former_rows(spark):
    def message(n, chart, operation, items):
        return (0, n, json.dumps({"id": chart, "type": "chart_content", "operation": operation, "data": items}))

    def item(content, rank=None):
        return {"contentId": content, "chartId": "c", **({"rank": rank} if rank else {})}

    rows = spark.createDataFrame([
        message(0, "c", "withdraw", []),
        message(1, "c", "release", [item("i1", 1), item("i2", 2), item("i1")]),
        message(2, "c", "Publish", [item("i2")]),
        message(3, "c", "down", []),
        message(4, "c", "pause", [item("i9")]),
    ], "partition int, offset long, value string")
    messages = charts.content_messages(ingest.decode_messages(rows, charts.CHART_BODY))
    for hot_rows in (1000, 2):
        got = {r["row_key"]: (r["offline_flg"], r["rank"]) for r in charts.content_upsert(messages, "t", hot_rows).collect()}
        assert got == {"c_i1": ("Publish", None), "c_i2": ("down", "2")}
        index = charts.chart_index(messages, "t", hot_rows).first()
        assert (index["content_row_keys"], index["offline_flg"]) == ('["c_i2"]', "down")


def test_scored_set(spark):
    lists = spark.createDataFrame([(0, ["a", "100", "b", "5"]), (1, ["a", "7"])], "seq int, cell array<string>")
    scored = {r["member"]: r["score"] for r in status.decode_scored(lists).collect()}
    assert scored == {"a": 7, "b": 5}
    kept = status.expire_scored(status.decode_scored(lists), 10, lifetime_ms=4)
    assert [r["member"] for r in kept.collect()] == ["a"]


def test_map_tables(spark):
    cells = {"cf:a": bytearray(b"1"), "cf:b": bytearray(b"\xff"), "x:c": bytearray(b"3")}
    table = spark.createDataFrame([("r1", cells), ("r2", {"cf:a": bytearray(b"2")}), ("r3", {})], "row_key string, cells map<string,binary>")
    assert {r["column"]: r["present"] for r in profile.map_profile(table).collect()} == {"a": 2, "b": 1, "x:c": 1}
    assert {r["name"] for r in tables.qualifiers(table).collect()} == {"a", "b", "c"}
    flat = tables.cells_to_columns(table, ["a", "b"])
    assert sorted(tuple(r) for r in flat.collect()) == [("r1", "1", "\ufffd"), ("r2", "2", None), ("r3", None, None)]
    got = {r["column"]: (r["row_count"], r["empty_rows"], r["present"]) for r in profile.table_profile(flat).collect()}
    assert got == {None: (3, 1, None), "a": (3, 1, 2), "b": (3, 1, 1)}
    assert profile.table_samples(flat, 1).first()["a"] == "1"


def test_file_sinks(spark, tmp_path):
    report = spark.createDataFrame([("a", 'x "q", y', ""), ("b", "line\nbreak", "z")], "k string, v string, w string")
    files.write_csv(report, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "csv"))
    assert sorted((r["k"], r["v"]) for r in back.collect()) == [("a", 'x "q", y'), ("b", "line\nbreak")]
    files.write_json(report, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    files.write_samples(report, str(tmp_path / "samples"))
    assert json.loads(spark.read.text(str(tmp_path / "samples")).orderBy("value").first()["value"])["k"] == "a"
    files.write_change_log(report.withColumnRenamed("k", "kind"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).where("kind = 'a'").count() == 1


def test_room_and_widget_rules(spark):
    def message(n, act, body, **envelope):
        return (0, n, json.dumps({"activityType": act, "channel": "m", "mgdbId": "e", "mgdbStatus": 1, "version": "5",
                                  "data": json.dumps({"body": body}), **envelope}))

    widget = {"activityType": 0, "mgdbId": "w"}
    room = {"activityType": 4, "mgdbId": "roomr", "roomStatus": "3", "broadcastStatus": "1"}
    cases = [
        (0, widget, {}, 1), (0, widget, {"mgdbStatus": 0}, 0), (0, widget, {"mgdbStatus": "0"}, 1), (1, widget, {"mgdbStatus": None}, 1),
        (0, {**widget, "projectId": "p0"}, {}, 0), (0, {**widget, "projectId": "p1"}, {}, 1), (0, {**widget, "projectId": "none"}, {}, 1),
        (0, {**widget, "seasonId": "s0"}, {}, 0), (0, {**widget, "testMgdb": "1"}, {}, 0), (0, {**widget, "title": "x测试"}, {}, 0),
        (0, {"mgdbId": "w"}, {}, None), (0, {**widget, "activityType": 9}, {}, 1),
        (4, room, {}, 1), (4, {**room, "roomStatus": "2"}, {}, 0), (4, {**room, "broadcastStatus": "0"}, {}, 0), (4, {**room, "test": "y"}, {}, 0),
        (4, {**room, "roomLabel": {"firstClassName": "测试"}}, {}, 0), (4, {**room, "shareMaterial": {"roomTitle": "a测试"}}, {}, 0),
        (4, {k: v for k, v in room.items() if k != "roomStatus"}, {}, None), (4, {**room, "roomStatus": "3", "broadcastStatus": None}, {}, 0), (4, {**room, "roomStatus": 3}, {}, 0), (0, {**widget, "testMgdb": 1}, {}, 1),
        (4, {k: v for k, v in room.items() if k != "broadcastStatus"}, {}, None),
    ]
    topic = spark.createDataFrame([message(n, act, body, **env) for n, (act, body, env, _) in enumerate(cases)],
                                  "partition int, offset long, value string")
    competitions = spark.createDataFrame([("p0", "0"), ("p1", None)], "id string, state string")
    seasons = spark.createDataFrame([("s0", "0")], "id string, state string")
    rows = status.widget_room_status(status.status_envelope(topic, ["m"]), competitions, seasons).orderBy("offset").collect()
    assert [r["status"] for r in rows] == [c[3] for c in cases]
    assert all(r["offline"] == (r["status"] != 1) for r in rows)
    assert {r["doc_id"] for r in rows} == {"w", "r"}
    assert status.status_envelope(topic, ["other"]).count() == 0
