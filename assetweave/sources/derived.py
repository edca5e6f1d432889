"""Message topics and keyed tables derived from the star-schema tables, as one recipe for two SQL dialects.

Every input row gives output rows: the arithmetic on ids only picks the shape of a message (well formed,
badly formed, late, repeated …). A third of the event messages, and of the offers, belongs to one key, so
the recipes are skewed on purpose. The same text runs in Spark and in DuckDB, which is what lets the
oracle SQL start from the identical bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from assetweave.session import new_path


# Source table, and the column expressions step by step; the last step is the output.
Recipe = tuple[str, list[dict[str, str]]]


@dataclass(frozen=True)
class Dialect:
    name: str

    def base64(self, expr: str) -> str:
        if self.name == "spark":
            return f"replace(base64({expr}), chr(13) || chr(10), '')"  # ends of lines, where the session asks for them
        return f"to_base64({expr})"

    def stamp(self, expr: str, sep: str = " ") -> str:
        if self.name == "spark":
            gap = f"''{sep}''" if sep.isalpha() else sep
            return f"date_format({expr}, 'yyyy-MM-dd{gap}HH:mm:ss')"
        return f"strftime({expr}, '%Y-%m-%d{sep}%H:%M:%S')"


SPARK, DUCK = Dialect("spark"), Dialect("duckdb")


def div(a: str, b: int) -> str:
    return f"cast(floor(({a}) / {b}) as bigint)"


def pick(selector: str, cases: dict[int, str], default: str) -> str:
    arms = " ".join(f"WHEN {n} THEN {expr}" for n, expr in cases.items())
    return f"CASE {selector} {arms} ELSE {default} END"


def quoted(expr: str) -> str:
    return f"""'"' || {expr} || '"'"""


def escaped(expr: str) -> str:
    """JSON text as a JSON string."""
    inner = f"replace(replace({expr}, chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34))"
    return quoted(inner)


def member(key: str, value: str) -> str:
    return f"""'"{key}":' || {value}"""


def vector_topic(d: Dialect) -> Recipe:
    """Vector messages from `events`; partition and offset follow the event id."""
    md5 = "md5(cast(event_id as string))"
    small = d.base64(f"unhex({md5} || {md5})")
    large = d.base64(f"unhex(repeat({md5}, 256))")

    def vector(shift: int) -> str:
        return pick(
            f"(r + {shift}) % 29",
            {1: quoted("' '"), 2: quoted("'*bad*'"), 3: "'12345'", 4: quoted("'AAAA'"), 5: quoted("'AAAAA'")},
            f"CASE WHEN r % 17 = 0 THEN {quoted(large)} ELSE {quoted(small)} END",
        )

    dimension = pick(
        "r % 17",
        {0: "''", 1: "',\"vectorDimension\":\"x\"'", 2: "',\"vectorDimension\":0'", 3: "',\"vectorDimension\":\"-4\"'",
         4: "',\"vectorDimension\":8'", 5: "',\"vectorDimension\":\" 8 \"'"},
        "',\"vectorDimension\":\"8\"'",
    )

    def item(kind: str, shift: int) -> str:
        head = f"""'{{"type":{kind}' """ if kind else """'{"rank":0'"""
        vec = f"CASE WHEN (r + {shift}) % 29 = 0 THEN '' ELSE ',\"vector\":' || {vector(shift)} END"
        model = pick("r % 7", {0: "''", 1: "',\"modelName\":\"\"'"},
                     f"',\"modelName\":\"m' || cast(r % 5 as string) || '\"'")
        rest = "',\"source\":\"s' || cast(user_id % 3 as string) || '\",\"version\":\"v1\"'"
        summary = pick("r % 5", {0: "''"}, "',\"summary\":\"about ' || event_type || '\"'")
        return f"{head} || {vec} || {dimension} || {model} || {rest} || {summary} || '}}'"

    steps = [
        {
            "r": "(event_id * 7919 + user_id * 104729) % 30011",
            "asset": "'A' || cast(CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END as string)",
        },
        {
            "ver": f"cast(1700000000000 + 1000 * {div('event_id + 4000 - (r % 7) * 60', 32)} as string)",
            "one": item('"1"', 0),
            "two": item('"2"', 7),
            "none": item("", 3),
        },
        {
            "listing": pick(
                "r % 31",
                {1: "'[]'", 2: "'[5,' || one || ']'", 3: "one", 4: escaped("'[' || one || ',' || two || ']'"),
                 5: "'[' || two || ',' || two || ']'", 6: "'[' || none || ']'", 7: "'[\"x\",' || two || ',' || one || ']'",
                 8: "'[' || one || ',' || one || ']'"},
                "'[' || two || ',' || one || ']'",
            ),
            "asset_part": pick(
                "r % 13",
                {0: "''", 1: "'\"assetId\":\"  \",'", 2: "'\"asset_id\":\"' || asset || '\",'", 3: "''", 4: "'\"assetId\":\"\",'"},
                "'\"assetId\":\"' || asset || '\",'",
            ),
            "type_part": pick("r % 11", {0: "'\"type\":\"208\",'", 1: "'\"type\":null,'", 2: "''", 3: "''",
                                         4: "'\"type\":140,'", 5: "'\"type\":\"\",'"}, "'\"type\":\"140\",'"),
            "version_part": pick("r % 23", {0: "''", 1: "'\"version\":\"n/a\",'", 2: "'\"version\":\"\",'",
                                            3: "'\"version\":' || ver || ','", 4: "'\"version\":null,'",
                                            # thirty digits, a negative one, leading zeros
                                            5: "'\"version\":\"' || ver || CASE WHEN r % 29 < 4 THEN repeat('0', 17) ELSE '' END || '\",'",
                                            6: "'\"version\":\"-' || ver || '\",'", 7: "'\"version\":\"000' || ver || '\",'"},
                                 "'\"version\":\"' || ver || '\",'"),
            "time_part": pick("r % 19", {0: "''", 1: "'\"time\":\"soon\",'",
                                         2: f"'\"time\":\"' || {d.stamp('ts', 'T')} || '\",'",
                                         3: f"'\"time\":\"' || {d.stamp('ts')} || '.123\",'",
                                         4: "'\"time\":\"2024-1-5 1:2:3\",'", 5: "'\"time\":\"\",'"},
                              f"'\"time\":\"' || {d.stamp('ts')} || '\",'"),
        },
        {
            "data": "'{' || CASE WHEN r % 11 = 3 THEN '\"type\":\"140\",' ELSE '' END || asset_part || "
                    + pick("r % 31", {0: "'\"n\":1'", 9: "'\"vector_list\":' || listing"},
                           "'\"vectorList\":' || listing")
                    + " || '}'",
        },
        {
            "body": "'{\"id\":\"' || cast(event_id as string) || '\",' || type_part || '\"operation\":\"' || event_type"
                    " || '\",' || version_part || time_part"
                    " || CASE WHEN r % 13 = 3 THEN '\"assetId\":\"' || asset || '\",' ELSE '' END"
                    " || '\"data\":' || CASE WHEN r % 41 = 8 THEN '7' WHEN r % 37 = 0 THEN " + escaped("data")
                    + " ELSE data END || CASE WHEN r % 43 = 0 THEN ',\"vectorItem\":' || one WHEN r % 43 = 1"
                    " THEN ',\"vectorItem\":{\"n\":1}' ELSE '' END || '}'",
        },
        {
            "partition": "cast(event_id % 4 as int)",
            "offset": div("event_id - event_id % 4", 4),
            "timestamp": "ts",
            "value": pick(
                "r % 41",
                {0: "cast(null as string)", 1: "''", 2: "'  '", 3: "substr(body, 1, 20)", 4: "'[1,2]'",
                 5: escaped("body"), 6: "body || ' x'", 7: "replace(body, '\"', chr(39))"},
                "body",
            ),
        },
    ]
    return "events", steps


def chart_topic(d: Dialect) -> Recipe:
    """Chart descriptions from `orders`: many messages for each chart, a third of them for one."""
    operation = pick("r % 11", {0: "'withdraw'", 1: "' Offline '", 2: "'pause'", 3: "'PUBLISH'", 4: "''"}, "'release'")
    classes = (
        "'[{\"firstClassName\":\"F' || cast(o_custkey % 4 as string) || '\",\"firstClassCode\":\"' || cast(o_custkey % 4 as string)"
        " || '\",\"secondClassName\":\"S' || cast(r % 3 as string) || '\"},{\"firstClassName\":\"F' || cast(r % 3 as string)"
        " || '\",\"secondClassCode\":' || cast(r % 5 as string) || '},7]'"
    )
    steps = [
        {
            "r": "(o_orderkey * 7919 + o_custkey * 104729) % 30011",
            "chart": "cast(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END as string)",
        },
        {"operation": operation, "classes": classes},
        {
            "data": "'{' || " + pick("r % 13", {0: "'\"chartId\":\"\"'", 1: "'\"chartId\":5'"},
                                     "'\"chartId\":\"C' || chart || '\"'")
            + " || " + pick("r % 5", {0: "''"}, "',\"chartName\":\"chart ' || o_orderpriority || '\"'")
            + " || " + pick("r % 7", {0: "',\"desc\":\" \"'", 1: "',\"desc\":\"d' || cast(r % 9 as string) || '\"'"}, "''")
            + " || ',\"chartCategory\":\"' || o_orderstatus || '\",\"length\":' || cast(r % 50 as string)"
            + " || CASE WHEN r % 3 = 0 THEN ',\"isValid\":true' ELSE '' END"
            + " || " + pick("r % 17", {0: "''", 1: f"',\"contentClasses\":' || {escaped('classes')}",
                                       2: "',\"contentClasses\":\"plain\"'", 3: "',\"contentClasses\":[]'"},
                            "',\"contentClasses\":' || classes")
            + " || '}'",
        },
        {"tail": "data || ' x'"},
        {
            "partition": "cast(o_orderkey % 4 as int)",
            "offset": div("o_orderkey - o_orderkey % 4", 4),
            "value": "'{\"id\":\"' || CASE WHEN r % 29 = 0 THEN ' ' ELSE 'D' || chart END || '\",\"type\":\"chart\",\"operation\":\"'"
                     " || operation || '\",\"version\":\"' || cast(1700000000000 + o_orderkey as string) || '\",\"time\":\"'"
                     f" || {d.stamp('o_orderdate')} || '\"' || CASE WHEN r % 19 = 0 THEN ',\"tableName\":\"t\"' ELSE '' END"
                     f" || ',\"data\":' || CASE WHEN r % 31 = 0 THEN '[1]' WHEN r % 31 = 1 THEN {escaped('tail')} WHEN r % 31 = 2 THEN {escaped('data')}"
                     " ELSE data END || '}'",
        },
    ]
    return "orders", steps


def chart_content_topic(d: Dialect) -> Recipe:
    """Chart content messages from `orders`: up to three items each; a third belongs to one chart."""
    def item(content: str, chart: str, rank: str) -> str:
        return (f"'{{\"contentId\":\"' || {content} || '\",\"chartId\":\"' || {chart} || '\",\"rank\":' || {rank}"
                " || CASE WHEN r % 3 = 0 THEN '' ELSE ',\"chartScore\":\"' || cast(r % 100 as string) || '\"' END"
                " || ',\"contentType\":\"' || o_orderstatus || '\",\"isShield\":\"0\"}'")

    first, second = "'I' || cast(r % 50 as string)", "'I' || cast((r + o_custkey) % 50 as string)"
    steps = [
        {
            "r": "(o_orderkey * 7919 + o_custkey * 104729) % 30011",
            "chart": "'C' || cast(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END as string)",
        },
        {
            "operation": pick("r % 7", {0: "'withdraw'", 1: "'Deleted'", 2: "'hold'"}, "'release'"),
            "other": "CASE WHEN r % 23 = 0 THEN 'C1' ELSE chart END",
        },
        {
            "data": "'[' || " + item(first, "chart", "'1'") + " || ',' || " + item(second, "other", "'2'")
                    + " || " + pick("r % 9", {0: "',5'", 1: "',' || " + item("' '", "chart", "'3'"),
                                              2: "',' || " + item(first, "chart", "'4'")}, "''") + " || ']'",
        },
        {"tail": "data || ' junk'"},
        {
            "partition": "cast(o_orderkey % 4 as int)",
            "offset": div("o_orderkey - o_orderkey % 4", 4),
            "value": "'{\"id\":\"' || CASE WHEN r % 29 = 0 THEN '' ELSE chart END || '\",\"type\":\"chart_content\",\"operation\":\"'"
                     " || operation || '\",\"version\":\"' || cast(1700000000000 + o_orderkey as string) || '\",\"time\":\"'"
                     f" || {d.stamp('o_orderdate', 'T')} || '\",\"data\":' || CASE WHEN r % 37 = 0 THEN '{{}}' WHEN r % 37 = 1 THEN {escaped('tail')}"
                     f" WHEN r % 37 = 2 THEN {escaped('data')} ELSE data END || '}}'",
        },
    ]
    return "orders", steps


def status_topic(d: Dialect) -> Recipe:
    """Widget and room status messages from `events`: the body sits in a JSON string."""
    widget = (
        "'{\"activityType\":' || " + pick("r % 17", {0: "'1'", 1: "'4'"}, "'0'") + " || ',\"mgdbId\":\"' || key || '\"'"
        " || " + pick("r % 5", {0: "',\"projectId\":\"P' || cast(user_id % 25 as string) || '\"'"}, "''")
        + " || " + pick("r % 7", {0: "',\"seasonId\":\"S' || cast(user_id % 5 as string) || '\"'", 1: "',\"seasonId\":\"\"'"}, "''")
        + " || " + pick("r % 11", {0: "',\"testMgdb\":\"1\"'", 1: "',\"testMgdb\":\"0\"'"}, "''")
        + " || " + pick("r % 13", {0: "',\"title\":\"a 测试 b\"'"}, "',\"title\":\"' || event_type || '\"'") + " || '}'"
    )
    room = (
        "'{\"activityType\":4,\"mgdbId\":\"room' || key || '\"'"
        " || " + pick("r % 7", {0: "',\"test\":\"y\"'", 1: "',\"test\":\"\"'", 2: "',\"test\":0'", 3: "',\"test\":false'",
                              4: "',\"test\":[]'"}, "''")
        + " || " + pick("r % 11", {0: "',\"roomLabel\":{\"firstClassName\":\"测试\"}'", 1: "',\"roomLabel\":null'"}, "''")
        + " || " + pick("r % 13", {0: "',\"shareMaterial\":{\"roomTitle\":\"测试间\"}'", 1: "',\"shareMaterial\":null'"}, "''")
        + " || " + pick("r % 5", {0: "',\"roomStatus\":\"2\"'", 1: "''"}, "',\"roomStatus\":\"3\"'")
        + " || " + pick("r % 3", {0: "',\"broadcastStatus\":\"0\"'"}, "',\"broadcastStatus\":\"1\"'") + " || '}'"
    )
    steps = [
        {
            "r": "(event_id * 7919 + user_id * 104729) % 30011",
            "key": "cast(CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END as string)",
            "kind": "CASE WHEN event_type IN ('error', 'view') THEN 4 ELSE cast(event_id % 2 as int) END",
        },
        {"body": f"CASE WHEN kind = 4 THEN {room} ELSE {widget} END"},
        {"data": "'{\"body\":' || body || CASE WHEN r % 53 = 3 THEN '' ELSE '}' END"},
        {
            "whole": "'{\"activityType\":' || CASE WHEN r % 53 = 4 THEN '7' ELSE cast(kind as string) END || ',\"channel\":\"' || "
                     + pick("r % 8", {0: "'other'"}, "'main'")
                     + " || '\",\"mgdbId\":\"' || key || '\"' || "
                     + pick("r % 9", {0: "',\"mgdbStatus\":0'", 1: "',\"mgdbStatus\":\"0\"'", 2: "',\"mgdbStatus\":null'"},
                            "',\"mgdbStatus\":1'")
                     + " || ',\"version\":\"' || CASE WHEN r % 53 = 5 THEN 'soon' ELSE"
                       " cast(1700000000000 + 1000 * (event_id + 500 - (r % 6) * 70) as string) END"
                     + f" || '\",\"time\":\"' || {d.stamp('ts')} || '\",\"data\":' || " + escaped("data") + " || '}'",
        },
        {
            "partition": "cast(event_id % 4 as int)",
            "offset": div("event_id - event_id % 4", 4),
            "timestamp": "ts",
            "value": pick("r % 53", {0: "cast(null as string)", 1: "substr(whole, 1, 40)", 2: "whole || '}'"}, "whole"),
        },
    ]
    return "events", steps


def ondemand_topic(d: Dialect) -> Recipe:
    """On-demand status messages from `orders`."""
    package = pick("r % 7", {0: "'9'", 1: "''"}, "CASE WHEN r % 2 = 0 THEN '141' ELSE '1' END")
    steps = [
        {
            "r": "(o_orderkey * 7919 + o_custkey * 104729) % 30011",
            "key": "cast(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END as string)",
        },
        {
            "partition": "cast(o_orderkey % 4 as int)",
            "offset": div("o_orderkey - o_orderkey % 4", 4),
            "timestamp": "o_orderdate",
            "value": "'{\"type\":\"' || " + pick("r % 5", {0: "'208'", 1: "'999'", 2: "'217'"},
                                                "CASE WHEN r % 2 = 0 THEN '217' ELSE '208' END")
                     + " || '\",\"id\":\"' || key || '\",\"operation\":' || " + pick("r % 3", {0: "'2'", 1: "CASE WHEN r % 61 = 0 THEN '\"off\"' ELSE '\"1\"' END"}, "'\"2\"'")
                     + " || ',\"version\":\"' || CASE WHEN r % 59 = 0 THEN 'v1' ELSE"
                       " cast(1700000000000 + 1000 * (o_orderkey + 500 - (r % 6) * 70) as string) END"
                     + f" || '\",\"time\":\"' || {d.stamp('o_orderdate')} || '\",\"data\":{{\"productInfoPackageId\":\"' || "
                     + package + " || '\"' || CASE WHEN r % 4 = 0 THEN '' ELSE ',\"content\":{\"PRODUCT_INFO_PACKAGE_ID\":\"' || "
                     + package + " || '\"}' END || '}}'",
        },
    ]
    return "orders", steps


def asset_table(d: Dialect) -> Recipe:
    """Stored asset rows, one for each order."""
    steps = [{"r": "(o_orderkey * 7919 + o_custkey * 104729) % 30011"}, {
        "row_key": pick("r % 101", {0: "' '"}, "'R' || cast(o_orderkey as string)"),
        "assetId": pick("r % 13", {0: "cast(null as string)", 1: "''", 2: "'L0'", 3: "'  '"}, "'L' || cast(o_orderkey as string)"),
        "assert_id": pick("r % 7", {0: "'L' || cast(o_orderkey as string)", 1: "''"}, "cast(null as string)"),
        "version": "cast(1700000000000 + o_custkey as string)",
        "modelName": "CASE WHEN r % 5 = 0 THEN cast(null as string) ELSE 'm' || cast(r % 3 as string) END",
        "summary": "CASE WHEN r % 4 = 0 THEN cast(null as string) ELSE o_orderpriority END",
    }]
    return "orders", steps


def document_index(d: Dialect) -> Recipe:
    """Searchable documents, one for each order line."""
    steps = [{"r": "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber) % 30011"}, {
        "doc_id": "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || cast(l_partkey as string)"
                  " || '-' || cast(l_suppkey as string)",
        "assert_id": pick("r % 17", {0: "cast(null as string)", 1: "' '", 2: "'L0'"}, "'L' || cast(l_orderkey * 2 as string)"),
        "program_id": pick("r % 19", {0: "''"}, "'G' || cast(l_partkey as string)"),
        "product_info_package_id": "CASE WHEN l_returnflag = 'A' THEN '1' WHEN l_returnflag = 'N' THEN '141' ELSE '9' END",
        "name": "CASE WHEN r % 6 = 0 THEN cast(null as string) ELSE 'name ' || cast(l_suppkey as string) END",
        "category": "CASE WHEN r % 3 = 0 THEN ' ' ELSE l_linestatus END",
    }]
    return "lineitem", steps


def program_table(d: Dialect) -> Recipe:
    """Stored programmes with their kind; the offline rules only touch matching kinds."""
    steps = [{
        "row_key": "cast(c_custkey as string)",
        "doc_type": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'pendant' WHEN c_mktsegment = 'MACHINERY' THEN 'newLive'"
                    " WHEN c_mktsegment = 'HOUSEHOLD' THEN cast(null as string) ELSE 'vod' END",
        "status": "cast(1 as int)",
    }]
    return "customer", steps


def competition_table(d: Dialect) -> Recipe:
    return "nation", [{
        "id": "'P' || cast(n_nationkey as string)",
        "state": "CASE WHEN n_regionkey = 0 THEN cast(null as string) WHEN n_regionkey = 1 THEN '0' ELSE '1' END",
    }]


def season_table(d: Dialect) -> Recipe:
    return "region", [{
        "id": "'S' || cast(r_regionkey as string)",
        "state": "CASE WHEN r_regionkey % 2 = 0 THEN '1' ELSE '0' END",
    }]


RECIPES = {
    "vector_topic": vector_topic,
    "chart_topic": chart_topic,
    "chart_content_topic": chart_content_topic,
    "status_topic": status_topic,
    "ondemand_topic": ondemand_topic,
    "asset_table": asset_table,
    "document_index": document_index,
    "program_table": program_table,
    "competition_table": competition_table,
    "season_table": season_table,
}


def _ident(name: str) -> str:
    return f'"{name}"'


def derive(source: DataFrame, name: str) -> DataFrame:
    """Apply a recipe to a batch or streaming DataFrame of its source table."""
    _, steps = RECIPES[name](SPARK)
    for step in steps[:-1]:
        source = source.selectExpr("*", *[f"{expr} AS `{col}`" for col, expr in step.items()])
    return source.selectExpr(*[f"{expr} AS `{col}`" for col, expr in steps[-1].items()])


_landed: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def land(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, StructType]:
    """Path and schema of a derived table, written once in a session, as a topic or table would be stored."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        table, _ = RECIPES[name](SPARK)
        source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        cores = spark.sparkContext.defaultParallelism
        if source.rdd.getNumPartitions() < cores:  # a small file would otherwise be one task
            source = source.repartition(cores)
        rows, path = derive(source, name), new_path(spark, name)
        rows.write.parquet(path)
        _landed[key] = (path, rows.schema)
    return _landed[key]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path, schema = land(spark, sf_dir, name)
    return spark.read.schema(schema).parquet(path)


def duck_ctes(name: str) -> list[tuple[str, str]]:
    """The recipe as DuckDB common table expressions; the last one bears the recipe's name."""
    table, steps = RECIPES[name](DUCK)
    ctes, current = [], table
    for n, step in enumerate(steps):
        last = n == len(steps) - 1
        cols = ", ".join(f"{expr} AS {_ident(col)}" for col, expr in step.items())
        following = name if last else f"{name}_{n}"
        ctes.append((following, f"SELECT {'' if last else '*, '}{cols} FROM {current}"))
        current = following
    return ctes
