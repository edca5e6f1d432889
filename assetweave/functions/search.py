"""Field search in JSON of unknown depth.

Known paths are read by `from_json` (see `assetweave.functions.payload`). What is left here needs document
order and recursion, which no built-in expression offers; each function works on Arrow batches of JSON
text, and callers pass null for rows that need no search, so those rows cost nothing.

Values come back as text: strings as they are, everything else in JSON form.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Names under which one field may appear, first choice first.
INGEST_ALIASES = {
    "assetId": ("assetId", "asset_id", "assert_id"),
    "asset_id": ("asset_id", "assert_id", "assetId"),
    "assert_id": ("assert_id", "asset_id", "assetId"),
    "embedding": ("embedding", "vector", "emb", "embed"),
}
PROFILE_ALIASES = {
    "assetId": ("assetId", "asset_id", "assert_id"),
    "asset_id": ("asset_id", "assetId", "assert_id"),
    "assert_id": ("assert_id", "assetId", "asset_id"),
    "vector": ("vector", "embedding", "emb", "embed"),
}
VECTOR_ITEM_NAMES = ("vectorItem", "vector_item", "vectoritem")
VECTOR_LIST_NAMES = ("vectorList", "vector_list", "vectorlist")

_CONTAINERS = (dict, list)


def aliases(field: str, table: dict[str, tuple[str, ...]] = INGEST_ALIASES) -> list[str]:
    return list(table.get(field, (field,)))


def _text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _load(text: str | None) -> object:
    """Parsed JSON in which strings that hold an object or array are opened, at any depth."""
    def opened(node: object) -> object:
        while isinstance(node, str) and node.lstrip()[:1] in ("{", "["):
            try:
                node = json.loads(node.strip())
            except ValueError:
                return node
        if isinstance(node, dict):
            return {name: opened(child) for name, child in node.items()}
        return [opened(child) for child in node] if isinstance(node, list) else node

    return None if text is None else opened(json.loads(text))


def _paths(root: object) -> dict[str, object]:
    """Dotted path to value, in document order; of a list only a leading object is entered."""
    found: dict[str, object] = {}
    stack: list[tuple[str, object]] = [("", root)]
    while stack:
        path, node = stack.pop()
        if isinstance(node, dict):
            below = [(f"{path}.{name}" if path else name, child) for name, child in node.items()]
            stack.extend(reversed(below))
            continue
        found[path] = node
        if isinstance(node, list) and node and isinstance(node[0], dict):
            stack.append((f"{path}[0]", node[0]))
    return found


def _lookup(doc: object, names: list[str], paths: dict[str, object]) -> object:
    if not isinstance(doc, dict):
        return None
    top = next((name for name in names if name in doc), None)
    if top is not None:
        return doc[top]
    for name in names:
        hit = name if name in paths else next((p for p in paths if p.endswith("." + name)), None)
        if hit is not None:
            return paths[hit]
    return None


def _kind(value: object) -> str:
    if isinstance(value, list):
        return f"list[{len(value)}]"
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    return "string" if isinstance(value, str) else "number"


def _nested(root: object, names: frozenset[str], shape: type) -> object:
    """First member called one of `names` with the wanted shape; a level is searched before its children."""
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, dict):
            for name, child in node.items():
                if name in names and isinstance(child, shape):
                    return child
        children = list(node.values()) if isinstance(node, dict) else node if isinstance(node, list) else []
        stack.extend(child for child in reversed(children) if isinstance(child, _CONTAINERS))
    return None


def _once(run: Callable[..., Column]) -> Callable[..., Column]:
    """Keep the optimizer from copying the call into a filter, which would search every payload twice."""
    return run.asNondeterministic()


def unnest_json(payload: Column) -> Column:
    """The payload with every JSON object or array held in a string opened."""
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda text: None if text is None else _text(_load(text)))

    return _once(run)(payload)


def search_fields(payload: Column, wanted: list[list[str]]) -> Column:
    """For each list of names (text, type) of the top-level field, or of the first nested one in document order."""
    schema = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("type", T.StringType())]))

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text: str | None) -> list[dict[str, str | None]] | None:
            if text is None:
                return None
            doc = _load(text)
            paths = _paths(doc)
            hits = [_lookup(doc, names, paths) for names in wanted]
            return [{"text": _text(hit), "type": _kind(hit)} for hit in hits]

        for batch in batches:
            yield batch.map(one)

    return _once(run)(payload)


def flatten_paths(payload: Column) -> Column:
    """array<struct<path, type, value>> of all flattened fields, in document order."""
    schema = T.ArrayType(T.StructType([
        T.StructField("path", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text: str | None) -> list[dict[str, str | None]] | None:
            if text is None:
                return None
            return [{"path": p, "type": _kind(v), "value": _text(v)} for p, v in _paths(_load(text)).items()]

        for batch in batches:
            yield batch.map(one)

    return _once(run)(payload)


_SHAPES = {"object": dict, "array": list}


def find_nested(payload: Column, names: tuple[str, ...], shape: str) -> Column:
    """JSON text of the first nested `object` or `array` with one of the names, or null."""
    return F.get(find_all_nested(payload, [(names, shape)]), F.lit(0))


def find_all_nested(payload: Column, wanted: list[tuple[tuple[str, ...], str]]) -> Column:
    """For each (names, shape) what `find_nested` gives, from one parsing of the payload; null for a payload that is null."""
    searches = [(frozenset(names), _SHAPES[shape]) for names, shape in wanted]

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text: str | None) -> list[str | None] | None:
            if text is None:
                return None
            doc = _load(text)
            return [_text(_nested(doc, names, kind)) for names, kind in searches]

        for batch in batches:
            yield batch.map(one)

    return _once(run)(payload)
