"""Edge rows of the scalar rules, checked against Python's own parsers where these define the rule."""

from __future__ import annotations

import base64
import random
import json
from datetime import datetime

from pyspark.sql import functions as F

from assetweave.functions import payload as J, search, text as X, vectors as V
from assetweave.operators import ingest


def column(spark, values, expr, kind="string"):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [r["x"] for r in rows.select("n", expr(F.col("v")).alias("x")).orderBy("n").collect()]


def test_blank_and_strip_follow_unicode_white_space(spark):
    values = [None, "", "  ", " 　", "\x1c\x85", "a", " 0 ", "​"]
    assert column(spark, values, X.is_present) == [v is not None and v.strip() != "" for v in values]
    assert column(spark, values[1:], X.strip) == [v.strip() for v in values[1:]]


INTEGERS = ["12", " 12 ", "+7", "-3", "1_000", "1.5", "1e3", "", "n/a", None, "99999999999999999999", "000", "-0", "+0012", "-" + "9" * 30, "1" + "0" * 29,
            "9" * 4300, "1" * 4301, "__1", "1__0", "-00", "00099999999999999999999", "-100", "-99", "9", "10"]


def as_int(text):
    """What the integer parser of the language makes of a text."""
    try:
        return int(text.strip())
    except (AttributeError, ValueError):
        return None


def test_versions_are_integers_of_any_length(spark):
    wanted = [as_int(v) for v in INTEGERS]
    assert column(spark, INTEGERS, X.parse_version) == [None if n is None else str(n) for n in wanted]
    assert column(spark, INTEGERS, X.parse_integer) == [n if n is not None and abs(n) < 2**63 else None for n in wanted]


def test_version_keys_have_the_order_of_the_numbers(spark):
    rng = random.Random(1)
    numbers = [as_int(v) for v in INTEGERS if as_int(v) is not None] + [rng.choice((-1, 1)) * rng.randrange(10 ** rng.randrange(1, 40)) for _ in range(300)]
    keys = column(spark, [str(n) for n in numbers], X.version_key)
    assert [n for _, n in sorted(zip(keys, numbers))] == sorted(numbers)


def test_parse_time_forms(spark):
    values = ["2024-01-05 01:02:03", "2024-01-05T01:02:03", "2024-1-5 1:2:3", "2024-01-05 01:02:03.123", "2024-02-30 00:00:00",
              "2024-01-05 01:02:60", "soon", "", None, "2024-01-05"]
    full = datetime(2024, 1, 5, 1, 2, 3)
    assert column(spark, values, X.parse_time) == [full, full, full, full, None, None, None, None, None, None]


def test_operations(spark):
    values = [" Publish ", "UP", "deleted", "down", "pause", None, ""]
    assert column(spark, values, X.classify_operation) == ["release", "release", "withdraw", "withdraw"] + ["unsupported"] * 3


def test_previews(spark):
    assert column(spark, [None, "abc", "abcdef"], lambda c: X.truncate(c, 3)) == ["<missing>", "abc", "abc...<len=6>"]
    assert column(spark, [None, "", "a\r\nb"], X.preview) == ["<None>", "<empty>", "a\\r\\nb"]
    assert X.package_texts("1, 141,x,") == ["1", "141", "x"]
    assert column(spark, ["cf:a", "cg:b", "c"], X.strip_family) == ["a", "cg:b", "c"]
    assert column(spark, ["cf:a:b", "c"], X.after_colon) == ["a:b", "c"]


def test_base64_length_agrees_with_strict_decoding(spark):
    values = ["", "AAAA", "AAA=", "AA==", "A===", "AAA", "AA AA", "A*AA", "AAAA=", "AA==AA==", "é", "AAAAAA=="]

    def strict(text):
        try:
            return len(base64.b64decode(text, validate=True))
        except ValueError:
            return None

    assert column(spark, values, V.decoded_length) == [strict(v) for v in values]


def test_vector_status(spark):
    rows = spark.createDataFrame(
        [(0, None, False), (1, "5", False), (2, "  ", True), (3, "*", True), (4, "AAAA", True), (5, "AAAAAA==", True), (6, "AAAAAAAAAAA=", True)],
        "n int, v string, s boolean")
    got = rows.orderBy("n").select(V.status(F.col("v"), F.col("s"), F.lit(1).cast("bigint")).alias("x")).collect()
    assert [tuple(r["x"]) for r in got] == [
        ("missing", None, None), ("not_string", None, None), ("blank", 0, 0), ("base64_invalid", None, None),
        ("length_invalid", 3, None), ("valid", 4, 1), ("length_invalid", 8, 2)]


def test_decoding_agrees_with_strict_json(spark):
    inner = '{"type":"140"}'
    values = [inner, " \n" + inner, json.dumps(inner), inner + " x", inner + inner, inner + "}", "{'type':1}", '{"a":1,}', "[1]", "5", "null",
              '"x"', "", "  ", None, '{"type":"a","type":"b"}', '{"a":"\\u00e9"}', json.dumps(json.dumps(inner)), '{"w":1},"z":"1"}', "{", '{"a":\t1}',
              '{"data":{"x":1,}}', '{"data":{"vectorList":[1,]},"type":"1"}', "{\"data\":{'x':1},\"type\":\"1\"}", '{"data":5,"type":"1"}',
              '{"data":{"vectorList":5}}', '[1,]', "{}"]

    def expected(text):
        if text is None:
            return "missing"
        if not text.strip():
            return "blank"
        try:
            value = json.loads(text)
            value = json.loads(value) if isinstance(value, str) else value
        except ValueError:
            return "not_json"
        return None if isinstance(value, dict) else "not_object"

    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "offset int, value string").withColumn("partition", F.lit(0))
    got = ingest.decode_messages(rows).orderBy("offset").select("error", "body.type").collect()
    assert [r["error"] for r in got] == [expected(v) for v in values]
    assert got[15]["type"] == "b" and got[2]["type"] == "140"


def test_invalid_utf8_is_rejected(spark):
    rows = spark.createDataFrame([(0, 0, bytearray(b'{"a":"\xff"}'))], "partition int, offset int, value binary")
    decoded = ingest.decode_messages(rows)
    assert ingest.rejects(decoded).first()["error"] == "not_utf8"


def test_unnest_and_search(spark):
    doc = {"data": json.dumps({"n": {"assetId": "in"}, "list": [{"k": 1}, {"k": 2}]}), "type": None, "bad": "{x"}
    text = json.dumps(doc)
    opened = json.loads(column(spark, [text], J.unnest_json)[0])
    assert opened == {"data": {"n": {"assetId": "in"}, "list": [{"k": 1}, {"k": 2}]}, "type": None, "bad": "{x"}
    found = column(spark, [text], lambda c: search.search_fields(c, [["assetId", "asset_id"], ["type"], ["k"], ["none"]]))[0]
    assert [f["text"] for f in found] == ["in", None, "1", None]
    paths = column(spark, [text], search.flatten_paths)[0]
    assert [(p["path"], p["type"]) for p in paths] == [
        ("data.n.assetId", "string"), ("data.list", "list[2]"), ("data.list[0].k", "number"), ("type", "null"), ("bad", "string")]


def test_find_nested_searches_a_level_before_its_children(spark):
    text = '{"a":{"vectorItem":{"deep":1}},"vectorItem":{"top":1},"l":[{"vector_list":[1]}],"vectorList":5}'
    assert column(spark, [text], lambda c: search.find_nested(c, search.VECTOR_ITEM_NAMES, "object")) == ['{"top":1}']
    assert column(spark, [text], lambda c: search.find_nested(c, search.VECTOR_LIST_NAMES, "array")) == ["[1]"]


def test_text_list(spark):
    values = ['["a",1]', "[", '{"a":1}', None, "[] x"]
    assert column(spark, values, J.text_list) == [["a", "1"], [], [], [], []]


def test_document_falls_back_to_fields_elsewhere(spark):
    vector = base64.b64encode(b"\0" * 8).decode()
    item = {"type": "1", "vector": vector, "vectorDimension": "2"}
    messages = [
        {"type": "140", "data": {"assetId": "a", "vectorList": [dict(item, type="2", modelName="m2"), item]}},
        {"type": "140", "asset_id": "b", "data": {"vectorList": item}},
        {"type": "140", "data": json.dumps({"assetId": "c", "vectorList": json.dumps([7, item])})},
        {"type": "140", "data": {"assetId": "d", "vectorList": []}},
        {"type": "140", "data": {"assetId": "e", "vectorList": [dict(item, vectorDimension="3")]}},
        {"type": "140", "data": {"vectorList": [item]}},
    ]
    rows = spark.createDataFrame([(0, n, json.dumps(m)) for n, m in enumerate(messages)], "partition int, offset int, value string")
    got = ingest.ingest(rows).orderBy("offset").select("row_key", "reject_reason", "modelName").collect()
    assert [tuple(r) for r in got] == [
        ("a", None, "m2"), ("b", None, None), ("c", None, None), ("d", "missing_vector_item", None),
        ("e", "invalid_vector", None), (None, "missing_asset_id", None)]


def test_several_searches_parse_a_payload_once(spark, monkeypatch):
    text = '{"a":{"vectorItem":{"n":1}},"vectorList":[2]}'
    wanted = [(search.VECTOR_ITEM_NAMES, "object"), (search.VECTOR_LIST_NAMES, "array"), (("none",), "array")]
    assert column(spark, [text, None], lambda c: search.find_all_nested(c, wanted)) == [['{"n":1}', "[2]", None], None]
    rows = spark.createDataFrame([(text,)], "v string").select(search.find_all_nested(F.col("v"), wanted).alias("f"))
    assert str(rows._jdf.queryExecution().optimizedPlan()).count("run(") == 1


def test_long_strings_are_left_out_where_mentions_are_counted(spark):
    texts = ['{"type":"%s","x":"\\"type\\" \\u0041%s"}' % ("A" * 60, "b" * 60), '{"%s":{"type":[%s]}}' % ("k" * 50, "1," * 60 + "1")]
    counts = lambda names: column(spark, texts, lambda c: J.mentions(names(c), "type"))
    assert counts(J.without_long_strings) == counts(lambda c: c) == [3, 1]
    assert all(len(t) < 60 for t in column(spark, texts[1:], J.without_long_strings))
