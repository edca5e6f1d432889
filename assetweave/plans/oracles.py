"""DuckDB counterparts of the registered queries, written over the given tables.

Each starts from the raw records of the derived topics and tables and computes the result its own way: the
guarded upsert steps through every key row by row, while the Spark job uses running aggregates.
"""

from __future__ import annotations

from assetweave.sources.derived import duck_ctes

ORACLES: dict[str, str] = {}

Ctes = list[tuple[str, str]]

ARRIVAL = '(CAST("partition" AS BIGINT) << 48) + "offset"'


def _sql(ctes: Ctes, final: str) -> str:
    body = ",\n".join(f"{name} AS ({text})" for name, text in ctes)
    return f"WITH RECURSIVE {body}\n{final}"


def register(name: str, ctes: Ctes, final: str) -> None:
    ORACLES[name] = _sql(ctes, final)


def present(expr: str) -> str:
    return f"CASE WHEN trim({expr}) <> '' THEN {expr} END"


def decoded(topic: str) -> Ctes:
    return [
        (f"{topic}_j", f"SELECT *, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j0 FROM {topic}"),
        (f"{topic}_k", f"""SELECT *, CASE WHEN json_type(j0) = 'VARCHAR' THEN
              CASE WHEN json_valid(j0 ->> '$') THEN CAST(j0 ->> '$' AS JSON) END ELSE j0 END AS j,
              CASE WHEN json_type(j0) = 'VARCHAR' THEN j0 ->> '$' ELSE value END AS inner_text FROM {topic}_j"""),
        (f"{topic}_d", f"""SELECT *, CASE WHEN value IS NULL THEN 'missing' WHEN trim(value) = '' THEN 'blank'
              WHEN j IS NULL THEN 'not_json' WHEN json_type(j) <> 'OBJECT' THEN 'not_object' END AS error FROM {topic}_k"""),
        (f"{topic}_p", f"SELECT *, CASE WHEN error IS NULL THEN j END AS p, CASE WHEN error IS NULL THEN inner_text END AS payload FROM {topic}_d"),
    ]


def opened(json: str) -> str:
    """An object or array, also when a string holds it."""
    text = f"trim({json} ->> '$')"
    return f"""CASE WHEN json_type({json}) IN ('OBJECT', 'ARRAY') THEN {json}
        WHEN json_type({json}) = 'VARCHAR' AND substr({text}, 1, 1) IN ('{{', '[') AND json_valid({text}) THEN CAST({text} AS JSON) END"""


def has(json: str, key: str) -> str:
    return f"coalesce(list_contains(json_keys({json}), '{key}'), false)"


VECTOR: Ctes = duck_ctes("vector_topic") + decoded("vector_topic") + [
    ("vec0", f"SELECT *, {ARRIVAL} AS arrival, {opened('(p -> ' + chr(39) + '$.data' + chr(39) + ')')} AS data0 FROM vector_topic_p"),
    ("vec1", "SELECT *, CASE WHEN json_type(data0) = 'OBJECT' THEN data0 END AS d FROM vec0"),
    ("vec2", f"""SELECT *, {opened("(d -> '$.vectorList')")} AS l, {opened("(d -> '$.vector_list')")} AS l2,
              p -> '$.vectorItem' AS vi FROM vec1"""),
    ("vec3", """SELECT *, CASE WHEN json_type(coalesce(l, l2)) = 'OBJECT' THEN coalesce(l, l2)
              WHEN json_type(coalesce(l, l2)) = 'ARRAY' AND json_type(coalesce(l, l2) -> '$[0]') = 'OBJECT'
              THEN coalesce(l, l2) -> '$[0]' END AS e0 FROM vec2"""),
    ("vec", f"""SELECT *, CASE WHEN {has('p', 'type')} THEN p ->> '$.type' WHEN {has('d', 'type')} THEN d ->> '$.type'
              WHEN {has('e0', 'type')} THEN e0 ->> '$.type' ELSE vi ->> '$.type' END AS msg_type,
              CASE WHEN {has('p', 'assetId')} THEN p ->> '$.assetId' WHEN {has('d', 'assetId')} THEN d ->> '$.assetId'
              ELSE d ->> '$.asset_id' END AS found_asset FROM vec3"""),
]


def items(json: str) -> str:
    """Objects of a list, or the one object that stands for it."""
    return f"""CASE WHEN json_type({json}) = 'OBJECT' THEN [{json}] WHEN json_type({json}) = 'ARRAY'
        THEN list_filter(CAST({json} AS JSON[]), lambda x: json_type(x) = 'OBJECT') ELSE CAST([] AS JSON[]) END"""


def base64_bytes(text: str) -> str:
    return f"""CASE WHEN regexp_full_match({text}, '[A-Za-z0-9+/]*={{0,2}}') AND length({text}) % 4 = 0
        THEN octet_length(TRY(from_base64({text}))) END"""


FIELDS = ("id", "assetId", "version", "time", "modelName", "source", "summary", "type", "vector", "vectorDimension", "vectorVersion")
ALL_FIELDS = ("id", "operation", *FIELDS[1:], "modelVersion")

DIMENSION = "CASE WHEN TRY_CAST(trim({0}) AS BIGINT) > 0 THEN TRY_CAST(trim({0}) AS BIGINT) ELSE 1024 END"

ITEM: Ctes = VECTOR + [
    ("item0", f"SELECT *, {items('l')} AS objects FROM vec WHERE error IS NULL"),
    ("item", "SELECT *, list_filter(objects, lambda x: x ->> '$.type' = '1')[1] AS item, "
             "list_filter(objects, lambda x: x ->> '$.type' = '2')[1] AS item2 FROM item0"),
]

DOCUMENT: Ctes = ITEM + [
    ("doc0", """SELECT *, coalesce(CASE WHEN d ->> '$.assetId' <> '' THEN d ->> '$.assetId' END, found_asset) AS row_key,
              trim(item ->> '$.vector') AS vec_text FROM item WHERE msg_type = '140'"""),
    ("doc1", f"""SELECT "partition", "offset", arrival, row_key,
              CASE WHEN trim(coalesce(row_key, '')) = '' THEN 'missing_asset_id' WHEN item IS NULL THEN 'missing_vector_item'
                   WHEN NOT coalesce(vec_text <> '' AND {base64_bytes('vec_text')} = 4 * ({DIMENSION.format("(item ->> '$.vectorDimension')")}), false)
                   THEN 'invalid_vector' END AS reject_reason,
              {present("(p ->> '$.id')")} AS id, {present("(p ->> '$.operation')")} AS operation, {present('row_key')} AS "assetId",
              {present("(p ->> '$.version')")} AS version, {present("(p ->> '$.time')")} AS time,
              {present("(item ->> '$.modelName')")} AS "modelName", {present("(item ->> '$.source')")} AS source,
              {present("(item ->> '$.summary')")} AS summary, {present("(item ->> '$.type')")} AS type,
              {present("(item ->> '$.vector')")} AS vector, {present("(item ->> '$.vectorDimension')")} AS "vectorDimension",
              {present("(item ->> '$.version')")} AS "vectorVersion", {present("(item ->> '$.version')")} AS "modelVersion"
              FROM doc0"""),
    ("document", 'SELECT "partition", "offset", arrival, row_key, reject_reason, ' + ", ".join(
        f'CASE WHEN reject_reason IS NULL THEN "{c}" END AS "{c}"' for c in ALL_FIELDS) + " FROM doc1"),
    ("valid", "SELECT * FROM document WHERE reject_reason IS NULL"),
]

PARSED_TIME = """CASE WHEN regexp_full_match(substr(trim({0}), 1, 19), '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}[ T][0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}')
    THEN coalesce(try_strptime(substr(trim({0}), 1, 19), '%Y-%m-%d %H:%M:%S'), try_strptime(substr(trim({0}), 1, 19), '%Y-%m-%dT%H:%M:%S')) END"""
PARSED_VERSION = "CASE WHEN regexp_full_match(trim({0}), '[+-]?[0-9]+') THEN TRY_CAST(trim({0}) AS HUGEINT) END"

STEPPED: Ctes = DOCUMENT + [
    ("ordered", f"""SELECT *, {PARSED_VERSION.format('version')} AS iv, {PARSED_TIME.format('time')} AS it,
              row_number() OVER (PARTITION BY row_key ORDER BY arrival) AS rn FROM valid"""),
    ("narrow", "SELECT row_key, arrival, rn, iv, it, version IS NOT NULL AS vp, time IS NOT NULL AS tp FROM ordered"),
    ("step", """SELECT row_key, arrival, rn, CASE WHEN vp THEN iv END AS ev, CASE WHEN tp THEN it END AS et, 'written' AS status
              FROM narrow WHERE rn = 1
              UNION ALL
              SELECT row_key, arrival, rn,
                     CASE WHEN verdict = 'written' AND vp THEN iv ELSE ev END,
                     CASE WHEN verdict = 'written' AND tp THEN it ELSE et END, verdict
              FROM (SELECT n.row_key, n.arrival, n.rn, n.iv, n.it, n.vp, n.tp, s.ev, s.et,
                           CASE WHEN s.ev IS NOT NULL AND n.iv IS NULL THEN 'skipped_missing_incoming_version'
                                WHEN n.iv < s.ev THEN 'skipped_old_version'
                                WHEN n.iv > s.ev THEN 'written'
                                WHEN n.it < s.et THEN 'skipped_old_time' ELSE 'written' END AS verdict
                    FROM step s JOIN narrow n ON n.row_key = s.row_key AND n.rn = s.rn + 1)"""),
]



def _q(names: tuple[str, ...] | list[str]) -> str:
    return ", ".join(f'"{n}"' for n in names)


UPSERTED: Ctes = STEPPED + [
    ("written", "SELECT v.* FROM valid v JOIN step s ON s.row_key = v.row_key AND s.arrival = v.arrival WHERE s.status = 'written'"),
    ("upserted", "SELECT row_key, " + ", ".join(
        f'arg_max("{c}", arrival) FILTER ("{c}" IS NOT NULL) AS "{c}"' for c in FIELDS) + " FROM written GROUP BY row_key"),
]

# Sources

TOPIC = duck_ctes("vector_topic")
register("snapshot_scan", TOPIC + [("bounds", 'SELECT "partition" AS bp, max("offset") + 1 - "partition" AS stop FROM vector_topic GROUP BY "partition"')],
         'SELECT "partition", "offset", CAST(length(value) AS INTEGER) AS size FROM vector_topic JOIN bounds ON "partition" = bp WHERE "offset" < stop')
register("retained_messages", TOPIC + [("bounds", 'SELECT "partition", max("offset") + 1 - min("offset") AS n FROM vector_topic GROUP BY 1')],
         "SELECT CAST(sum(n) AS BIGINT) AS retained, count(*) AS partitions FROM bounds")
ASSETS = duck_ctes("asset_table")
register("table_scan", ASSETS, 'SELECT row_key, "assetId", version FROM asset_table')
INDEX = duck_ctes("document_index")
register("key_lookup", ASSETS + INDEX,
         "SELECT row_key, version, \"modelName\" FROM asset_table WHERE row_key IN (SELECT replace(assert_id, 'L', 'R') FROM document_index)")

IDS: Ctes = ASSETS + INDEX + [
    ("ids0", """SELECT row_key, coalesce(nullif("assetId", ''), nullif(assert_id, ''), row_key) AS asset_id FROM asset_table"""),
    ("ids", "SELECT * FROM ids0 WHERE trim(asset_id) <> ''"),
    ("uids", "SELECT DISTINCT asset_id FROM ids"),
    ("alldocs", "SELECT doc_id, assert_id AS asset_id, program_id, product_info_package_id, name, category FROM document_index WHERE trim(assert_id) <> ''"),
    ("hits", "SELECT * FROM alldocs WHERE product_info_package_id IN ('1', '141')"),
]
register("doc_lookup", IDS, "SELECT asset_id, doc_id, program_id, name FROM hits WHERE asset_id IN (SELECT asset_id FROM uids)")
register("capped_hits", IDS, """SELECT asset_id, doc_id, program_id FROM alldocs WHERE asset_id IN (SELECT asset_id FROM uids)
    QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY doc_id) <= 2""")

# Decoding and fields

register("decode_messages", VECTOR, 'SELECT "partition", "offset", error, payload FROM vec')
register("reject_records", VECTOR, """SELECT "partition", "offset", error, CASE WHEN value IS NULL THEN '<None>' WHEN value = '' THEN '<empty>'
    WHEN length(value) <= 10 THEN value ELSE substr(value, 1, 10) || '...<len=' || length(value) || '>' END AS preview FROM vec WHERE error IS NOT NULL""")
register("normalize_json", VECTOR, """SELECT "partition", "offset",
    CASE WHEN d IS NULL THEN p ->> '$.data' WHEN json_type(d -> '$.vectorList') = 'VARCHAR'
         THEN replace(CAST(d AS VARCHAR), CAST(d -> '$.vectorList' AS VARCHAR), CAST(l AS VARCHAR)) ELSE CAST(d AS VARCHAR) END AS data,
    CAST(coalesce(l, l2) AS VARCHAR) AS listing FROM vec WHERE error IS NULL""")
ONDEMAND = duck_ctes("ondemand_topic")


def _member(path: str, json_path: str) -> str:
    return (f"""SELECT "partition", "offset", '{path}' AS path, CASE json_type(j, '{json_path}') WHEN 'VARCHAR' THEN 'string' ELSE 'number' END AS type,
        j ->> '{json_path}' AS value FROM od WHERE json_type(j, '{json_path}') IS NOT NULL""")


register("flatten_fields", ONDEMAND + [("od", 'SELECT "partition", "offset", CAST(value AS JSON) AS j FROM ondemand_topic')], " UNION ALL ".join(
    [_member(m, f"$.{m}") for m in ("type", "id", "operation", "version", "time")]
    + [_member("data.productInfoPackageId", "$.data.productInfoPackageId"),
       _member("data.content.PRODUCT_INFO_PACKAGE_ID", "$.data.content.PRODUCT_INFO_PACKAGE_ID")]))
CONTENT = duck_ctes("chart_content_topic")
register("field_paths", CONTENT + [
    ("cc", "SELECT CAST(value AS JSON) AS j FROM chart_content_topic"),
    ("cd", f"""SELECT *, {opened("(j -> '$.data')")} AS d FROM cc"""),
], """
    SELECT k AS path, 'string' AS type, count(*) AS messages FROM cd, unnest(['id', 'type', 'operation', 'version', 'time']) t(k) GROUP BY k
    UNION ALL SELECT 'data', 'list[' || json_array_length(d) || ']', count(*) FROM cd WHERE json_type(d) = 'ARRAY' GROUP BY 2
    UNION ALL SELECT 'data', 'string', count(*) FROM cd WHERE json_type(j, '$.data') = 'VARCHAR' AND d IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'data[0].' || k, CASE json_type(d, '$[0].' || k) WHEN 'VARCHAR' THEN 'string' ELSE 'number' END, count(*)
    FROM cd, unnest(['contentId', 'chartId', 'rank', 'chartScore', 'contentType', 'isShield']) t(k)
    WHERE json_type(d, '$[0].' || k) IS NOT NULL GROUP BY 1, 2""")
register("resolve_field", VECTOR, 'SELECT "partition", "offset", found_asset AS asset_id FROM vec WHERE error IS NULL')
register("find_nested", VECTOR, """SELECT "partition", "offset", CASE WHEN json_type(vi) = 'OBJECT' THEN CAST(vi AS VARCHAR) END AS item,
    CASE WHEN json_type(coalesce(l, l2)) = 'ARRAY' THEN CAST(json_array_length(coalesce(l, l2)) AS INTEGER) END AS items FROM vec WHERE error IS NULL""")
register("filter_type", VECTOR, """SELECT "partition", "offset", msg_type FROM vec WHERE error IS NULL AND msg_type = '140'""")
register("select_vector", ITEM, """SELECT "partition", "offset", item2 ->> '$.vector' AS vector, item2 ->> '$.vectorDimension' AS "vectorDimension" FROM item""")
register("vector_documents", DOCUMENT, "SELECT * EXCLUDE (arrival) FROM document")
register("generic_documents", VECTOR, f"""SELECT "partition", "offset", CASE WHEN found_asset IS NULL THEN 'missing_row_key' END AS reject_reason,
    found_asset AS row_key, p ->> '$.id' AS id, found_asset AS "assetId",
    CASE WHEN {has('p', 'version')} THEN p ->> '$.version' WHEN {has('e0', 'version')} THEN e0 ->> '$.version' ELSE vi ->> '$.version' END AS version,
    p ->> '$.time' AS time FROM vec WHERE error IS NULL""")
register("vector_valid", ITEM, f"""SELECT "partition", "offset", coalesce(v <> '' AND {base64_bytes('v')} = 4 * ({DIMENSION.format('dim')}), false) AS valid
    FROM (SELECT "partition", "offset", trim(item ->> '$.vector') AS v, item ->> '$.vectorDimension' AS dim FROM item WHERE item IS NOT NULL)""")
register("parse_time", VECTOR, f"""SELECT "partition", "offset", strftime({PARSED_TIME.format("(p ->> '$.time')")}, '%Y-%m-%d %H:%M:%S') AS parsed FROM vec WHERE error IS NULL""")
register("parse_version", VECTOR, f"""SELECT "partition", "offset", CAST({PARSED_VERSION.format("(p ->> '$.version')")} AS VARCHAR) AS version FROM vec WHERE error IS NULL""")
register("preview_values", [("d", "SELECT doc_id, text, replace(replace(text, chr(13), chr(92) || 'r'), chr(10), chr(92) || 'n') AS line FROM documents")],
         """SELECT doc_id, CASE WHEN length(text) <= 80 THEN text ELSE substr(text, 1, 80) || '...<len=' || length(text) || '>' END AS short,
    CASE WHEN line = '' THEN '<empty>' WHEN length(line) <= 200 THEN line ELSE substr(line, 1, 200) || '...<len=' || length(line) || '>' END AS preview FROM d""")

# Scans with limits

register("limited_scan", VECTOR + [("cut", "SELECT max(arrival) AS a FROM (SELECT arrival FROM vec WHERE error IS NULL AND msg_type = '140' ORDER BY arrival LIMIT 1000)"),
                                   ("n", "SELECT count(*) AS n FROM vec WHERE error IS NULL AND msg_type = '140'")],
         'SELECT "partition", "offset" FROM vec WHERE (SELECT n FROM n) < 1000 OR arrival <= (SELECT a FROM cut)')
register("sample_messages", VECTOR, """SELECT "partition", "offset", payload FROM vec WHERE error IS NULL AND msg_type = '140' ORDER BY arrival LIMIT 10""")
register("first_match", DOCUMENT, """SELECT row_key, "partition", "offset", version, time FROM valid
    QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY arrival) = 1""")
register("latest_by_version", DOCUMENT, f"""SELECT row_key, "partition", "offset", version, time, "modelName", summary, vector FROM valid
    QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY {PARSED_VERSION.format('version')} DESC NULLS LAST,
        {PARSED_TIME.format('time')} DESC NULLS LAST, arrival DESC) = 1""")

# Profile

register("scan_totals", VECTOR, """SELECT count(*) AS scanned, count(*) FILTER (error IS NULL AND msg_type = '140') AS matched,
    count(*) FILTER (error IS NOT NULL) AS parse_errors, count(*) FILTER (error IS NULL AND coalesce(msg_type, '') <> '140') AS skipped FROM vec""")
register("type_counts", VECTOR, """SELECT CASE WHEN error IS NOT NULL THEN '<invalid_json>' WHEN coalesce(msg_type, '') = '' THEN '<missing>' ELSE msg_type END AS type,
    count(*) AS messages FROM vec GROUP BY 1""")

STATUS = """CASE WHEN {v} IS NULL THEN 'missing' WHEN NOT {s} THEN 'not_string' WHEN trim({v}) = '' THEN 'blank' WHEN {b} IS NULL THEN 'base64_invalid'
    WHEN {b} = 4 * {d} THEN 'valid' ELSE 'length_invalid' END"""

PROFILE: Ctes = VECTOR + [
    ("m0", f"""SELECT *, {present('found_asset')} AS asset_id, CASE WHEN json_type(vi) = 'OBJECT' THEN vi END AS it,
              CASE WHEN json_type(coalesce(l, l2)) = 'ARRAY' THEN CAST(coalesce(l, l2) AS JSON[]) END AS els FROM vec WHERE error IS NULL AND msg_type = '140'"""),
    ("m1", f"""SELECT *, CASE WHEN {has('it', 'vector')} THEN it -> '$.vector' ELSE e0 -> '$.vector' END AS vj FROM m0"""),
    ("m2", "SELECT *, vj ->> '$' AS vt, coalesce(json_type(vj) = 'VARCHAR', false) AS vs FROM m1"),
    ("m3", f"SELECT *, CASE WHEN vs AND trim(vt) <> '' THEN {base64_bytes('trim(vt)')} END AS vb FROM m2"),
    ("message", f"""SELECT *, {STATUS.format(v='vt', s='vs', b='vb', d='1024')} AS status FROM m3"""),
    ("el0", """SELECT "partition", "offset", asset_id, unnest(els) AS el FROM message WHERE els IS NOT NULL"""),
    ("el1", """SELECT *, coalesce(el ->> '$.type', '<missing>') AS type, TRY_CAST(trim(el ->> '$.vectorDimension') AS BIGINT) AS declared,
              el ->> '$.vector' AS vt, coalesce(json_type(el, '$.vector') = 'VARCHAR', false) AS vs FROM el0 WHERE json_type(el) = 'OBJECT'"""),
    ("el2", f"SELECT *, CASE WHEN vs AND trim(vt) <> '' THEN {base64_bytes('trim(vt)')} END AS vb, CASE WHEN declared <> 0 THEN declared ELSE 1024 END AS expected FROM el1"),
    ("el", f"SELECT *, {STATUS.format(v='vt', s='vs', b='vb', d='expected')} AS status FROM el2"),
]
BYTES = "CASE WHEN status = 'blank' THEN 0 ELSE vb END"
DIMS = "CASE WHEN status = 'blank' THEN 0 WHEN vb % 4 = 0 THEN vb // 4 END"
register("vector_status", PROFILE, f'SELECT "partition", "offset", status, CAST({BYTES} AS BIGINT) AS bytes, CAST({DIMS} AS BIGINT) AS dimension FROM message')
register("duplicate_stats", PROFILE, """SELECT CAST(sum(n) AS BIGINT) AS matched, count(asset_id) AS unique_assets, count(asset_id) FILTER (n > 1) AS duplicated_assets,
    CAST(coalesce(sum(n) FILTER (asset_id IS NULL), 0) AS BIGINT) AS missing_asset,
    CAST(greatest(0, sum(n) - count(asset_id) - coalesce(sum(n) FILTER (asset_id IS NULL), 0)) AS BIGINT) AS duplicate_messages
    FROM (SELECT asset_id, count(*) AS n FROM message GROUP BY asset_id)""")
register("top_duplicates", PROFILE, """SELECT asset_id, count(*) AS messages FROM message WHERE asset_id IS NOT NULL GROUP BY asset_id HAVING count(*) > 1
    ORDER BY messages DESC, asset_id LIMIT 20""")
register("missing_asset", PROFILE, 'SELECT "partition", "offset" FROM message WHERE asset_id IS NULL ORDER BY arrival LIMIT 20')
register("vector_item_counts", PROFILE, """SELECT it IS NOT NULL AS has_item, CASE WHEN it IS NOT NULL THEN coalesce(it ->> '$.type', '<missing>') END AS item_type,
    count(*) AS messages FROM message GROUP BY 1, 2""")
register("vector_status_counts", PROFILE, f"SELECT status, CAST({BYTES} AS BIGINT) AS bytes, CAST({DIMS} AS BIGINT) AS dimension, count(*) AS messages FROM message GROUP BY 1, 2, 3")
register("vector_list_totals", PROFILE, """SELECT count(els) AS list_present, count(*) - count(els) AS list_missing, CAST(coalesce(sum(len(els)), 0) AS BIGINT) AS items,
    CAST(coalesce(sum(len(list_filter(els, lambda x: json_type(x) <> 'OBJECT'))), 0) AS BIGINT) AS not_objects FROM message""")
register("vector_type_counts", PROFILE, """SELECT type, count(*) AS items, count(DISTINCT ("partition", "offset")) AS messages,
    count(DISTINCT asset_id) AS assets FROM el GROUP BY type""")
register("vector_dim_counts", PROFILE, "SELECT type, coalesce(CAST(declared AS VARCHAR), '<missing>') AS dimension, count(*) AS items FROM el GROUP BY 1, 2")
register("vector_type_status", PROFILE, f"SELECT type, status, CAST({BYTES} AS BIGINT) AS bytes, CAST({DIMS} AS BIGINT) AS dimension, count(*) AS items FROM el GROUP BY 1, 2, 3, 4")
register("type_subtotal", PROFILE, "SELECT count(*) AS items, count(*) FILTER (status = 'valid') AS valid FROM el WHERE type = '1'")
_CELLS = ("assetId", "assert_id", "version", "modelName", "summary")


def _profiled(table: str, truncated: str) -> str:
    head = f"count(*) AS row_count, count(*) FILTER (coalesce({_q(_CELLS)}) IS NULL) AS empty_rows, {truncated} AS truncated"
    return f'SELECT {head}, CAST(NULL AS VARCHAR) AS "column", CAST(NULL AS BIGINT) AS present FROM {table} UNION ALL ' + " UNION ALL ".join(
        f"""SELECT {head}, '{c}', count("{c}") FROM {table} HAVING count("{c}") > 0""" for c in _CELLS)


STORED: Ctes = ASSETS + [("sr", "SELECT * FROM asset_table WHERE trim(row_key) <> ''")]
register("table_profile", ASSETS, _profiled("asset_table", "false"))
register("table_profile_limited", STORED + [("sl", "SELECT * FROM sr ORDER BY row_key LIMIT 1000")], _profiled("sl", "count(*) >= 1000"))
register("table_samples", STORED, "SELECT row_key, " + ", ".join(
    f"""CASE WHEN length("{c}") <= 8 THEN "{c}" ELSE substr("{c}", 1, 8) || '...<len=' || length("{c}") || '>' END AS "{c}\"""" for c in _CELLS)
    + " FROM sr ORDER BY row_key LIMIT 5")
_SAMPLE = "concat_ws(',', " + ", ".join(f"""'"{c}":"' || "{c}" || '"'""" for c in sorted(_CELLS)) + ")"
register("table_summary", STORED + [
    ("pf", _profiled("sr", "false")), ("sm", "SELECT * FROM sr ORDER BY row_key LIMIT 3"),
], f"""SELECT any_value(row_count) AS row_count, any_value(empty_rows) AS empty_rows, string_agg("column", ',' ORDER BY "column") AS unique_columns,
    string_agg("column" || '=' || present, ',' ORDER BY "column") AS presence, any_value(truncated) AS truncated,
    (SELECT '[' || string_agg('{{"row_key":"' || row_key || '","columns":{{' || {_SAMPLE} || '}}}}', ',' ORDER BY row_key) || ']' FROM sm) AS samples FROM pf""")
register("encoded_cells", STORED, """SELECT row_key, 'assetId' AS "column", "assetId" AS value FROM sr WHERE "assetId" IS NOT NULL
    UNION ALL SELECT row_key, 'meta', '{' || concat_ws(',', '"version":"' || version || '"', '"modelName":"' || "modelName" || '"') || '}' FROM sr
    UNION ALL SELECT row_key, 'labels', '[' || concat_ws(',', '"' || assert_id || '"', '"' || summary || '"') || ']' FROM sr""")


def _counted(section: str, table: str, value: str, key: str | None = None, n: str = "count(*)") -> str:
    """One counter of the listing; `n` may be another aggregate."""
    return (f"SELECT '{section}' AS section, {f'CAST({key} AS VARCHAR)' if key else 'CAST(NULL AS VARCHAR)'} AS key, CAST({value} AS VARCHAR) AS value, "
            f"CAST({n} AS BIGINT) AS n FROM {table} WHERE {value} IS NOT NULL GROUP BY 2, 3")


_MESSAGE_VALUES = {"status": "status", "bytes": BYTES, "dimension": DIMS}
_COUNTERS = [
    _counted("type", "ty", "type"), _counted("item type", "(SELECT * FROM message WHERE it IS NOT NULL)", "coalesce(it ->> '$.type', '<missing>')"),
    *[_counted(n, "message", v) for n, v in _MESSAGE_VALUES.items()],
    _counted("list items", "el", "type"), _counted("list messages", "el", "type", n='count(DISTINCT ("partition", "offset"))'),
    _counted("list assets", "el", "type", n="count(DISTINCT asset_id)"),
    _counted("list declared", "el", "coalesce(CAST(declared AS VARCHAR), '<missing>')", "type"),
    *[_counted(f"list {n}", "el", v, "type") for n, v in _MESSAGE_VALUES.items()],
]
register("counter_listing", PROFILE + [
    ("ty", "SELECT CASE WHEN error IS NOT NULL THEN '<invalid_json>' WHEN coalesce(msg_type, '') = '' THEN '<missing>' ELSE msg_type END AS type FROM vec"),
    ("cs", " UNION ALL ".join(f"SELECT {n} AS number, * FROM ({c})" for n, c in enumerate(_COUNTERS))),
], "SELECT row_number() OVER (ORDER BY number, key NULLS FIRST, n DESC, value NULLS FIRST) AS place, section, key, value, n FROM cs")

# Upserts

register("write_status_counts", STEPPED, """SELECT status, count(*) AS messages FROM (SELECT status FROM step
    UNION ALL SELECT 'skipped_invalid_payload' FROM document WHERE reject_reason IS NOT NULL) GROUP BY status""")
register("guarded_upsert_chunked", UPSERTED, f"SELECT row_key, {_q(FIELDS)} FROM upserted")
register("guarded_upsert", UPSERTED, f"SELECT row_key, {_q(FIELDS)}, '2024-01-01 00:00:00' AS operate_time FROM upserted")


for _name in ("written_limit", "written_limit_chunked"):
    register(_name, STEPPED + [
        ("stop", "SELECT arrival FROM step WHERE status = 'written' ORDER BY arrival LIMIT 700"),
        ("written", "SELECT v.* FROM valid v WHERE arrival IN (SELECT arrival FROM stop)"),
    ], "SELECT row_key, " + ", ".join(f'arg_max("{c}", arrival) FILTER ("{c}" IS NOT NULL) AS "{c}"' for c in FIELDS) + " FROM written GROUP BY row_key")


def joined(field: str) -> str:
    return f"string_agg(DISTINCT \"{field}\", '|' ORDER BY \"{field}\") FILTER (trim(\"{field}\") <> '')"


MERGED: Ctes = IDS + [("merged", "SELECT asset_id, count(*) AS n, " + ", ".join(
    f'{joined(f)} AS "{f}"' for f in ("program_id", "name", "category")) + " FROM hits GROUP BY asset_id")]
register("column_merge_upsert", MERGED + [
    ("stored", "SELECT * FROM asset_table WHERE trim(row_key) <> ''"),
    ("incoming", "SELECT i.row_key, name, category FROM ids i JOIN merged m USING (asset_id) WHERE trim(i.row_key) <> '' AND coalesce(name, category) IS NOT NULL"),
], """SELECT s.row_key, "assetId", assert_id, version, "modelName", coalesce(category, summary) AS summary, name, category
    FROM stored s LEFT JOIN incoming i ON s.row_key = i.row_key""")
_VERIFY = """SELECT *, expected IS NOT DISTINCT FROM actual AS match, CAST(length(expected) AS INTEGER) AS expected_length, CAST(length(actual) AS INTEGER) AS actual_length FROM (""" + " UNION ALL ".join(
    f"""SELECT coalesce(f.row_key, u.row_key) AS row_key, '{c}' AS field, f."{c}" AS expected, u."{c}" AS actual
    FROM firsts f FULL JOIN upserted u ON f.row_key = u.row_key""" for c in FIELDS) + ")"
_FIRSTS: Ctes = UPSERTED + [("firsts", "SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY arrival) = 1")]
_LATEST: Ctes = UPSERTED + [("firsts", f"""SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY {PARSED_VERSION.format('version')} DESC NULLS LAST,
    {PARSED_TIME.format('time')} DESC NULLS LAST, arrival DESC) = 1""")]
register("verify_rows", _FIRSTS, _VERIFY)
register("verify_latest", _LATEST, _VERIFY)
register("verify_union", _LATEST, _VERIFY + """ UNION ALL SELECT row_key, 'operate_time', NULL, '2024-01-01 00:00:00', false, NULL, 19 FROM upserted""")
register("verify_totals", _LATEST, f"""SELECT field, count(*) FILTER (match) AS matches, count(*) FILTER (NOT match) AS mismatches,
    count(*) FILTER (expected IS NOT NULL AND actual IS NULL) AS missing FROM ({_VERIFY}) GROUP BY field""")

# Reconciliation

register("asset_ids", IDS, "SELECT row_key, asset_id FROM ids")
register("distinct_ids", IDS, "SELECT asset_id FROM uids")
register("relation_join", IDS, "SELECT u.asset_id, doc_id, program_id FROM uids u LEFT JOIN hits h ON u.asset_id = h.asset_id")
register("missing_ids", IDS, "SELECT asset_id FROM uids WHERE asset_id NOT IN (SELECT asset_id FROM hits)")
_DIAGNOSIS = """SELECT asset_id, CASE WHEN asset_id IN (SELECT asset_id FROM alldocs) THEN 'found_without_filter' ELSE 'still_not_found' END AS reason
    FROM uids WHERE asset_id NOT IN (SELECT asset_id FROM hits)"""
register("missing_diagnosis", IDS, _DIAGNOSIS)
register("relation_examples", IDS, _DIAGNOSIS + " ORDER BY asset_id LIMIT 20")
PAIRS: Ctes = IDS + [("pairs", "SELECT DISTINCT asset_id, program_id FROM hits WHERE trim(program_id) <> '' AND asset_id IN (SELECT asset_id FROM uids)")]
register("multi_program", PAIRS, "SELECT asset_id, program_id, count(*) OVER (PARTITION BY asset_id) AS program_count FROM pairs QUALIFY program_count > 1")
register("multi_asset", PAIRS, "SELECT program_id, asset_id, count(*) OVER (PARTITION BY program_id) AS asset_count FROM pairs QUALIFY asset_count > 1")
_LISTED = """SELECT '{kind}' AS kind, {one} AS key, string_agg({many}, ',' ORDER BY {many}) AS listed FROM pairs GROUP BY {one} HAVING count(*) > 1
    ORDER BY {one} LIMIT 10"""
register("relation_example_lists", PAIRS + [
    ("ms", "SELECT asset_id FROM uids WHERE asset_id NOT IN (SELECT asset_id FROM hits) ORDER BY asset_id LIMIT 10"),
    ("md", f"""SELECT asset_id, coalesce({joined('product_info_package_id')}, '') AS pk, coalesce({joined('program_id')}, '') AS pr FROM alldocs GROUP BY asset_id"""),
    ("mp", _LISTED.format(kind="many_programs", one="asset_id", many="program_id")), ("ma", _LISTED.format(kind="many_assets", one="program_id", many="asset_id")),
], """SELECT 'missing' AS kind, asset_id AS key, CASE WHEN coalesce(pk, '') = '' AND coalesce(pr, '') = '' THEN 'package_ids=<not_found>'
        ELSE 'package_ids=' || pk || ' program_ids=' || pr END AS listed FROM ms LEFT JOIN md USING (asset_id)
    UNION ALL SELECT * FROM mp UNION ALL SELECT * FROM ma""")
register("limited_ids", IDS, "SELECT row_key, asset_id FROM ids WHERE trim(row_key) <> '' ORDER BY row_key LIMIT 500")
_DOC = ("assert_id", "category", "name", "product_info_package_id", "program_id")
_PRESENT = "list_filter([" + ", ".join(f"CASE WHEN {f} IS NOT NULL THEN '{f}' END" for f in _DOC) + "], lambda x: x IS NOT NULL)"
_JSON = "'{' || concat_ws(',', " + ", ".join(f"""'"{f}":"' || {f} || '"'""" for f in _DOC) + ") || '}'"
register("document_report", IDS + [
    ("st", "SELECT a.row_key, i.asset_id, list_filter([" + ", ".join(f"CASE WHEN \"{c}\" IS NOT NULL THEN '{c}' END" for c in sorted(_CELLS))
     + "], lambda x: x IS NOT NULL) AS stored FROM asset_table a JOIN ids i USING (row_key) WHERE trim(row_key) <> ''"),
    ("tot", "SELECT assert_id AS asset_id, count(*) AS total FROM document_index WHERE assert_id IS NOT NULL GROUP BY 1"),
    ("dn", "SELECT *, row_number() OVER (PARTITION BY assert_id ORDER BY doc_id) AS hit FROM document_index WHERE assert_id IS NOT NULL QUALIFY hit <= 3"),
    ("dl", f"""SELECT assert_id AS asset_id, hit, list_concat(['', '--- document ' || hit || ' ---', '_id=' || doc_id, 'program_id=' || coalesce(program_id, 'None'),
        'assert_id=' || assert_id, 'product_info_package_id=' || product_info_package_id, 'top_level_fields=' || array_to_string({_PRESENT}, ','),
        'field_path_count=' || len({_PRESENT}), '=== source field paths ==='], list_concat(list_transform({_PRESENT}, lambda x: x || ' (string)'),
        ['=== source JSON ===', {_JSON}])) AS ls FROM dn"""),
    ("hd", """SELECT row_key, CAST(0 AS BIGINT) AS hit, list_concat(['=== stored row ===', 'row_key=' || row_key, 'assetId=' || asset_id],
        list_concat(CASE WHEN len(stored) > 0 THEN ['columns=' || array_to_string(stored, ',')] ELSE [] END,
        list_concat(['', '=== documents ===', 'total=' || coalesce(total, 0) || ' returned=' || least(coalesce(total, 0), 3)],
        CASE WHEN total IS NULL THEN ['No document found for ' || asset_id || '.'] ELSE [] END))) AS ls FROM st LEFT JOIN tot USING (asset_id)"""),
    ("al", "SELECT row_key, hit, ls FROM hd UNION ALL SELECT row_key, hit, ls FROM st JOIN dl USING (asset_id)"),
], "SELECT row_key, hit, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no, unnest(ls) AS line FROM al")
register("relation_summary", PAIRS, """SELECT (SELECT count(*) FROM ids) AS table_rows, (SELECT count(*) FROM uids) AS unique_ids,
    (SELECT count(*) FROM uids WHERE asset_id IN (SELECT asset_id FROM hits)) AS matched_ids,
    (SELECT count(*) FROM uids WHERE asset_id NOT IN (SELECT asset_id FROM hits)) AS missing_ids,
    (SELECT count(*) FROM uids WHERE asset_id NOT IN (SELECT asset_id FROM hits) AND asset_id IN (SELECT asset_id FROM alldocs)) AS found_without_filter,
    (SELECT count(*) FROM uids WHERE asset_id NOT IN (SELECT asset_id FROM alldocs)) AS still_not_found,
    (SELECT count(*) FROM (SELECT asset_id FROM pairs GROUP BY 1 HAVING count(*) > 1)) AS assets_with_programs,
    (SELECT count(*) FROM (SELECT program_id FROM pairs GROUP BY 1 HAVING count(*) > 1)) AS programs_with_assets""")
_AGG = "count(*) AS n, count(DISTINCT program_id) FILTER (trim(program_id) <> '') AS programs, " + ", ".join(
    f"coalesce({joined(f)}, '') AS {n}" for f, n in (("program_id", "prg"), ("product_info_package_id", "pkg"), ("name", "nam")))
register("relation_report", IDS + [("inside", f"SELECT asset_id, {_AGG} FROM hits GROUP BY asset_id"), ("outside", f"SELECT asset_id, {_AGG} FROM alldocs GROUP BY asset_id")],
         """SELECT r.row_key, r.asset_id, coalesce(i.prg, '') AS program_ids, coalesce(i.programs, 0) AS program_count, coalesce(i.n, 0) AS hit_count,
    coalesce(i.pkg, '') AS product_info_package_ids, coalesce(i.nam, '') AS names,
    CASE WHEN i.n IS NULL THEN coalesce(o.n, 0) ELSE 0 END AS unfiltered_hit_count,
    CASE WHEN i.n IS NULL THEN coalesce(o.pkg, '') ELSE '' END AS unfiltered_product_info_package_ids,
    CASE WHEN i.n IS NULL THEN coalesce(o.prg, '') ELSE '' END AS unfiltered_program_ids,
    CASE WHEN i.n IS NULL THEN coalesce(o.nam, '') ELSE '' END AS unfiltered_names
    FROM ids r LEFT JOIN inside i USING (asset_id) LEFT JOIN outside o USING (asset_id)""")
register("relation_values", IDS, "SELECT DISTINCT asset_id, field, value FROM (" + " UNION ALL ".join(
    f"SELECT asset_id, '{f}' AS field, CAST({f} AS VARCHAR) AS value FROM hits" for f in ("program_id", "product_info_package_id", "name")) + ") WHERE trim(value) <> ''")
register("enrich_fields", MERGED, """SELECT row_key, program_id, name, category FROM ids JOIN merged USING (asset_id)
    WHERE coalesce(program_id, name, category) IS NOT NULL""")
_REPORT = """SELECT row_key, asset_id, coalesce(n, 0) AS hit_count, CASE WHEN coalesce(program_id, name, category) IS NOT NULL THEN 'written' ELSE 'not_found' END AS write_status,
    coalesce(program_id, '') AS program_id, coalesce(name, '') AS name, coalesce(category, '') AS category FROM ids LEFT JOIN merged USING (asset_id)"""
register("merge_report", MERGED, _REPORT)
register("merge_summary", MERGED, f"""SELECT count(*) AS scanned, count(*) FILTER (hit_count > 0) AS matched, count(*) FILTER (hit_count = 0) AS missing,
    count(*) FILTER (write_status = 'written') AS written FROM ({_REPORT})""")

# Charts

_WORD = "lower(trim(coalesce({0}, '')))"
_CLASS = (f"CASE WHEN {_WORD} IN ('release', 'released', 'publish', 'online', 'up') THEN 'release' "
          f"WHEN {_WORD} IN ('withdraw', 'offline', 'down', 'delete', 'deleted') THEN 'withdraw' ELSE 'unsupported' END")


def _chart_head(topic: str, base: str) -> str:
    return f"""SELECT "partition", "offset", {ARRIVAL} AS arrival, j,
        CASE WHEN trim(j ->> '$.tableName') <> '' THEN '{base}_test' ELSE '{base}_prod' END AS target, {present("(j ->> '$.id')")} AS id,
        j ->> '$.operation' AS operation, {_CLASS.format("j ->> '$.operation'")} AS class, {present("(j ->> '$.version')")} AS message_time,
        strftime({PARSED_TIME.format("(j ->> '$.time')")}, '%Y-%m-%d %H:%M:%S') AS time,
        CASE WHEN json_type(j, '$.data') = 'VARCHAR' AND json_valid(j ->> '$.data') THEN CAST(j ->> '$.data' AS JSON) ELSE j -> '$.data' END AS data
        FROM (SELECT *, CAST(value AS JSON) AS j FROM {topic})"""


CHART_MEMBERS = {"chart_name": "chartName", "desc": "desc", "chart_category": "chartCategory", "chart_type": "chartType", "length": "length",
                 "content_time_span": "contentTimeSpan", "metric_time_span": "metricTimeSpan", "execution_cycle": "executionCycle",
                 "execution_time": "executionTime", "is_recommend": "isRecommend", "is_valid": "isValid"}
CLASS_MEMBERS = {"firstclass_name": "firstClassName", "firstclass_code": "firstClassCode", "secondclass_name": "secondClassName",
                 "secondclass_code": "secondClassCode"}


def _rolled(member: str) -> str:
    values = (f"list_sort(list_distinct(list_filter(list_transform(list_filter(CAST(cj AS JSON[]), lambda x: json_type(x) = 'OBJECT'), "
              f"lambda x: x ->> '$.{member}'), lambda y: trim(y) <> '')))")
    return f"CASE WHEN json_type(cj) = 'ARRAY' THEN nullif(array_to_string({values}, ','), '') END"


CHARTS: Ctes = duck_ctes("chart_topic") + [
    ("ch0", _chart_head("chart_topic", "description")),
    ("ch1", f"""SELECT *, CASE WHEN json_type(data) = 'OBJECT' THEN data END AS c,
              CASE WHEN id IS NULL THEN 'blank_id' WHEN class = 'unsupported' THEN 'unsupported_operation'
                   WHEN class = 'release' AND json_type(data) <> 'OBJECT' THEN 'data_not_object'
                   WHEN class = 'release' AND coalesce(trim(data ->> '$.chartId'), '') = '' THEN 'blank_chart_id' END AS reject_reason FROM ch0"""),
    ("ch2", "SELECT *, CASE WHEN trim(c ->> '$.contentClasses') <> '' THEN c ->> '$.contentClasses' END AS ct FROM ch1"),
    ("ch3", "SELECT *, CASE WHEN json_valid(ct) THEN CAST(ct AS JSON) END AS cj FROM ch2"),
    ("ch", "SELECT *, CASE WHEN cj IS NULL THEN ct WHEN json_type(cj) = 'ARRAY' AND json_array_length(cj) > 0 THEN CAST(cj AS VARCHAR) END AS content_classes, "
           + ", ".join(f"{_rolled(m)} AS {c}" for c, m in CLASS_MEMBERS.items()) + " FROM ch3"),
]
register("classify_operation", CHARTS, "SELECT operation, class, count(*) AS messages FROM ch GROUP BY 1, 2")
register("route_table", CHARTS, "SELECT target, count(*) AS messages FROM ch GROUP BY 1")
register("chart_rejects", CHARTS, 'SELECT "partition", "offset", reject_reason FROM ch WHERE reject_reason IS NOT NULL')
register("class_rollup", CHARTS, f'SELECT "partition", "offset", content_classes, {", ".join(CLASS_MEMBERS)} FROM ch')
_CHART_COLS = {"id": "id", "type": "'chart'", "chart_id": "c ->> '$.chartId'", "message_time": "message_time", "time": "time",
               **{n: present(f"(c ->> '$.{m}')") for n, m in CHART_MEMBERS.items()},
               **{n: n for n in ("content_classes", *CLASS_MEMBERS)}}
register("chart_upsert", CHARTS, "SELECT target, id AS row_key, arg_max(operation, arrival) AS offline_flg, '2024-01-01 00:00:00' AS operate_time, " + ", ".join(
    f"arg_max({e}, arrival) FILTER (class = 'release' AND ({e}) IS NOT NULL) AS \"{n}\"" for n, e in _CHART_COLS.items())
    + " FROM ch WHERE reject_reason IS NULL GROUP BY target, id")

CONTENTS: Ctes = CONTENT + [
    ("ct0", _chart_head("chart_content_topic", "content")),
    ("ct1", "SELECT * FROM ct0 WHERE id IS NOT NULL AND class <> 'unsupported'"),
    ("it0", """SELECT target, arrival, operation, message_time, time, unnest(CAST(data AS JSON[])) AS item, generate_subscripts(CAST(data AS JSON[]), 1) AS pos
              FROM ct1 WHERE class = 'release' AND json_type(data) = 'ARRAY'"""),
    ("it", """SELECT *, item ->> '$.chartId' AS chart_id, item ->> '$.contentId' AS content_id, (item ->> '$.chartId') || '_' || (item ->> '$.contentId') AS row_key,
              arrival * 2 + 1 AS place FROM it0 WHERE json_type(item) = 'OBJECT' AND trim(item ->> '$.chartId') <> '' AND trim(item ->> '$.contentId') <> ''"""),
    ("wr", "SELECT target, chart_id, place, any_value(operation) AS operation, list(row_key ORDER BY pos) AS row_keys FROM it GROUP BY 1, 2, 3"),
    ("ev", "SELECT target, id AS chart_id, arrival * 2 AS place, operation, false AS w FROM ct1 UNION ALL SELECT target, chart_id, place, operation, true FROM wr"),
    ("mk", """SELECT * FROM (SELECT *, max(CASE WHEN w THEN place END) OVER (PARTITION BY target, chart_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS version
              FROM ev) WHERE NOT w AND version IS NOT NULL"""),
    ("ml", """SELECT m.target, m.chart_id, m.version, max(m.place) AS place, arg_max(m.operation, m.place) AS offline_flg FROM mk m GROUP BY 1, 2, 3"""),
    ("mr", """SELECT ml.target, unnest(list_distinct(wr.row_keys)) AS row_key, ml.place, offline_flg FROM ml JOIN wr
              ON wr.target = ml.target AND wr.chart_id = ml.chart_id AND wr.place = ml.version"""),
]
register("content_rejects", CONTENTS, """SELECT "partition", "offset", CAST(NULL AS INTEGER) AS pos, CASE WHEN id IS NULL THEN 'blank_id'
        WHEN class = 'unsupported' THEN 'unsupported_operation' ELSE 'data_not_list' END AS reject_reason
    FROM ct0 WHERE id IS NULL OR class = 'unsupported' OR (class = 'release' AND coalesce(json_type(data), '') <> 'ARRAY')
    UNION ALL SELECT "partition", "offset", pos, CASE WHEN json_type(item) <> 'OBJECT' THEN 'item_not_object' ELSE 'blank_item_id' END
    FROM (SELECT "partition", "offset", unnest(CAST(data AS JSON[])) AS item, CAST(generate_subscripts(CAST(data AS JSON[]), 1) - 1 AS INTEGER) AS pos
        FROM ct1 WHERE class = 'release' AND json_type(data) = 'ARRAY')
    WHERE json_type(item) <> 'OBJECT' OR coalesce(trim(item ->> '$.chartId'), '') = '' OR coalesce(trim(item ->> '$.contentId'), '') = ''""")
_CONTENT_COLS = {"id": "row_key", "content_id": "content_id", "chart_id": "chart_id", "type": "'chart_content'", "message_time": "message_time", "time": "time",
                 **{n: present(f"(item ->> '$.{m}')") for n, m in (("content_type", "contentType"), ("rank", "rank"), ("chart_score", "chartScore"), ("is_shield", "isShield"))}}
register("chart_content_upsert", CONTENTS + [
    ("lastitem", "SELECT * FROM it QUALIFY row_number() OVER (PARTITION BY target, row_key, place ORDER BY pos DESC) = 1"),
    ("rows_", "SELECT target, row_key, place, operation AS offline_flg, " + ", ".join(f'{e} AS "c_{n}"' for n, e in _CONTENT_COLS.items())
     + " FROM lastitem UNION ALL BY NAME SELECT target, row_key, place, offline_flg FROM mr"),
], "SELECT target, row_key, arg_max(offline_flg, place) AS offline_flg, '2024-01-01 00:00:00' AS operate_time, " + ", ".join(
    f'arg_max("c_{n}", place) FILTER ("c_{n}" IS NOT NULL) AS "{n}"' for n in _CONTENT_COLS) + " FROM rows_ GROUP BY target, row_key")
register("mark_old_offline", CONTENTS, "SELECT target, row_key, place, offline_flg FROM mr")
_INDEX: Ctes = CONTENTS + [
    ("ix0", "SELECT target, chart_id, place, operation, row_keys FROM wr UNION ALL BY NAME SELECT target, chart_id, place, operation FROM mk"),
    ("ix", "SELECT target, '__chart_index__' || chart_id AS row_key, chart_id, arg_max(row_keys, place) FILTER (row_keys IS NOT NULL) AS keys, arg_max(operation, place) AS offline_flg FROM ix0 GROUP BY target, chart_id"),
]
register("chart_index", _INDEX, "SELECT target, row_key, chart_id, CAST(to_json(keys) AS VARCHAR) AS content_row_keys, offline_flg, '2024-01-01 00:00:00' AS operate_time FROM ix")
register("index_rows", _INDEX, "SELECT target, row_key, CAST(generate_subscripts(keys, 1) - 1 AS INTEGER) AS pos, unnest(keys) AS content_row_key FROM ix")

# Status

STATUS_TOPIC: Ctes = duck_ctes("status_topic") + duck_ctes("competition_table") + duck_ctes("season_table") + [
    ("sa0", f"""SELECT "partition", "offset", {ARRIVAL} AS arrival, value, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM status_topic"""),
    ("sa1", """SELECT *, CASE WHEN json_valid(j ->> '$.data') THEN CAST(j ->> '$.data' AS JSON) -> '$.body' END AS b,
              CAST(j ->> '$.activityType' AS INTEGER) AS act FROM sa0"""),
    ("sa", """SELECT *, CASE WHEN value IS NULL THEN 'missing' WHEN j IS NULL THEN 'not_json' WHEN j ->> '$.channel' <> 'main' THEN 'other_channel'
              WHEN b IS NULL THEN 'no_body' WHEN act NOT IN (0, 1, 4) THEN 'other_activity'
              WHEN TRY_CAST(j ->> '$.version' AS BIGINT) IS NULL THEN 'unreadable_version' END AS reject_reason FROM sa1"""),
    ("st1", "SELECT * FROM sa WHERE reject_reason IS NULL"),
    ("st2", """SELECT *, CASE WHEN act = 4 THEN 'room' ELSE 'widget' END AS kind, CASE WHEN act = 4 THEN substr(b ->> '$.mgdbId', 5) ELSE b ->> '$.mgdbId' END AS doc_id,
              CAST(j ->> '$.version' AS BIGINT) AS version, j ->> '$.time' AS time, CAST(b ->> '$.activityType' AS INTEGER) AS bact,
              coalesce(json_type(j, '$.mgdbStatus') IN ('UBIGINT', 'BIGINT') AND CAST(j ->> '$.mgdbStatus' AS BIGINT) = 0, false) AS number_zero FROM st1"""),
    ("st3", """SELECT st2.*, CASE WHEN k.id IS NOT NULL THEN coalesce(k.state, '1') ELSE '1' END AS competition, CASE WHEN s.id IS NOT NULL THEN coalesce(s.state, '1') ELSE '1' END AS season
              FROM st2 LEFT JOIN competition_table k ON k.id = b ->> '$.projectId' LEFT JOIN season_table s ON s.id = b ->> '$.seasonId'"""),
    ("st", """SELECT *, CASE WHEN bact IN (0, 1) THEN CASE WHEN competition <> '1' OR season <> '1' OR coalesce(b ->> '$.testMgdb', '') = '1'
                     OR coalesce(b ->> '$.title', '') LIKE '%测试%' OR number_zero THEN 0 ELSE 1 END
                   WHEN bact = 4 THEN CASE WHEN coalesce(json_type(b, '$.roomLabel'), 'OBJECT') <> 'OBJECT' OR coalesce(json_type(b, '$.shareMaterial'), 'OBJECT') <> 'OBJECT'
                       OR b ->> '$.roomStatus' IS NULL OR (b ->> '$.roomStatus' = '3' AND b ->> '$.broadcastStatus' IS NULL) THEN NULL
                     WHEN coalesce(CAST(b -> '$.test' AS VARCHAR), 'null') NOT IN ('null', 'false', '0', '""', '[]', '{}') OR coalesce(b ->> '$.roomLabel.firstClassName', '') = '测试' OR coalesce(b ->> '$.shareMaterial.roomTitle', '') LIKE '%测试%'
                       OR b ->> '$.roomStatus' <> '3' OR b ->> '$.broadcastStatus' <> '1' THEN 0 ELSE 1 END END AS status FROM st3"""),
]
register("status_envelope", STATUS_TOPIC, """SELECT "partition", "offset", kind, doc_id, version, number_zero, b ->> '$.title' AS title, b ->> '$.roomStatus' AS "roomStatus" FROM st""")
for _kind, _name in (("widget", "widget_status"), ("room", "room_status")):
    register(_name, STATUS_TOPIC, f"""SELECT "partition", "offset", doc_id, CAST(status AS INTEGER) AS status, coalesce(status = 0, true) AS offline FROM st WHERE kind = '{_kind}'""")
DEMAND: Ctes = ONDEMAND + [
    ("od0", f"""SELECT "partition", "offset", {ARRIVAL} AS arrival, value, CAST(value AS JSON) AS j FROM ondemand_topic"""),
    ("od1", """SELECT *, j ->> '$.type' AS type, j ->> '$.id' AS doc_id, TRY_CAST(j ->> '$.version' AS BIGINT) AS version, j ->> '$.time' AS time,
              TRY_CAST(j ->> '$.operation' AS INTEGER) AS operation FROM od0"""),
    ("od2", """SELECT *, operation = 2 AS offline, CASE WHEN type NOT IN ('208', '217') THEN 'other_type' WHEN operation IS NULL THEN 'unreadable_operation'
              WHEN operation <> 2 AND NOT coalesce(CASE type WHEN '217' THEN j ->> '$.data.productInfoPackageId' = '141'
                  ELSE j ->> '$.data.content.PRODUCT_INFO_PACKAGE_ID' = '1' END, false) THEN 'other_product'
              WHEN version IS NULL THEN 'unreadable_version' END AS reject_reason FROM od1"""),
    ("od", "SELECT * FROM od2 WHERE reject_reason IS NULL"),
]
_PREVIEW = """CASE WHEN value IS NULL THEN '<None>' WHEN length(value) <= 60 THEN value ELSE substr(value, 1, 60) || '...<len=' || length(value) || '>' END AS preview"""
register("status_rejects", STATUS_TOPIC, f'SELECT "partition", "offset", reject_reason, {_PREVIEW} FROM sa WHERE reject_reason IS NOT NULL')
register("ondemand_rejects", DEMAND, f'SELECT "partition", "offset", reject_reason, {_PREVIEW} FROM od2 WHERE reject_reason IS NOT NULL')
register("ondemand_filter", DEMAND, 'SELECT "partition", "offset", type, doc_id, version FROM od')
register("ondemand_status", DEMAND, 'SELECT "partition", "offset", doc_id FROM od WHERE offline')
_BEFORE = "max(version) OVER (PARTITION BY doc_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
GATED: Ctes = STATUS_TOPIC + DEMAND + duck_ctes("program_table") + [
    ("ac", f"""SELECT kind, "partition", "offset", doc_id, version, time, coalesce(status = 0, true) AS offline FROM st QUALIFY coalesce(version >= {_BEFORE}, true)
              UNION ALL SELECT 'ondemand', "partition", "offset", doc_id, version, time, offline FROM od QUALIFY coalesce(version >= {_BEFORE}, true)"""),
    ("of", "SELECT kind, doc_id, max(version) AS version FROM ac WHERE offline GROUP BY 1, 2"),
    ("ok", """SELECT kind, row_key FROM program_table, (VALUES ('widget'), ('room'), ('ondemand')) t(kind)
              WHERE CASE kind WHEN 'widget' THEN doc_type = 'pendant' WHEN 'room' THEN doc_type = 'newLive' ELSE doc_type NOT IN ('pendant', 'newLive') END"""),
    ("oe", """SELECT ac."partition", ac."offset", ac.kind, doc_id, version, time FROM ac JOIN ok ON ok.kind = ac.kind AND ok.row_key = ac.doc_id WHERE offline"""),
    ("fo", "SELECT of.kind, of.doc_id, of.version, ok.row_key IS NOT NULL AS hit FROM of LEFT JOIN ok ON ok.kind = of.kind AND ok.row_key = of.doc_id"),
]
register("version_gate", GATED, 'SELECT kind, "partition", "offset", doc_id, version FROM ac')
register("offline_events", GATED, """SELECT "partition", "offset", kind, doc_id, version, time, CAST(0 AS INTEGER) AS status, CAST(0 AS INTEGER) AS additional_status,
    CAST(1704067200 AS BIGINT) AS update_time FROM oe""")
register("status_fanout", GATED, """SELECT kind, target, doc_id, CASE WHEN target <> 'scored_set' THEN CAST(0 AS INTEGER) END AS status,
    CASE WHEN target <> 'scored_set' THEN CAST(0 AS INTEGER) END AS additional_status,
    CASE WHEN target = 'main' OR (kind = 'ondemand' AND target IN ('latest', 'profile')) THEN CAST(1704067200 AS BIGINT) END AS update_time,
    CASE WHEN target = 'scored_set' THEN version END AS score
    FROM fo, (VALUES ('profile'), ('main'), ('latest'), ('documents'), ('scored_set')) t(target)
    WHERE target = 'profile' OR (target IN ('main', 'latest', 'documents') AND hit) OR (target = 'scored_set' AND kind = 'room')""")
register("cache_invalidate", GATED, "SELECT 'video_cp:' || row_key AS cache_key FROM program_table WHERE row_key NOT IN (SELECT doc_id FROM of)")
register("offline_heartbeat", GATED, """SELECT kind, max(CAST(time AS TIMESTAMP)) AS last_event, count(*) AS events,
    max(CAST(time AS TIMESTAMP)) + INTERVAL 12 HOUR AS expires_at FROM oe GROUP BY kind""")
register("expire_offline_set", STATUS_TOPIC + [
    ("pr", "SELECT doc_id AS member, version AS score, arrival FROM st WHERE kind = 'room' UNION ALL SELECT 'x' || doc_id, version - 1, arrival FROM st WHERE kind = 'room'"),
], """SELECT * FROM (SELECT member, arg_max(score, arrival) AS score FROM pr GROUP BY member) WHERE score >= 1700009000000 - 7200000""")

# Streams: the same results as the batch forms on the same records

register("stream_ingest", DOCUMENT, 'SELECT "partition", "offset", row_key, reject_reason FROM document')
register("stream_guarded_upsert", STEPPED, "SELECT row_key, arrival, status FROM step")
register("stream_version_gate", DEMAND, f"SELECT doc_id, arrival, version FROM od QUALIFY coalesce(version >= {_BEFORE}, true)")
for _name in ("guarded_upsert", "offline_events", "status_fanout", "status_rejects"):
    ORACLES["stream_" + _name.replace("guarded_upsert", "upsert_table")] = ORACLES[_name]
