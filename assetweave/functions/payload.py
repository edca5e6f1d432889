"""Strict JSON decoding of message payloads and native access to known paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetweave.functions import search, text as X

JSON_BLANKS = " \t\n\r"
JSON_OPTIONS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "bad"}

# A string that opens with a bracket after optional (possibly escaped) white space.
EMBEDDED_JSON = r'"(?:\s|\\[nrtbf/]|\\u[0-9a-fA-F]{4})*(?:[\[{]|\\u00[57][bB])'


def once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add a column that is computed exactly once for each row.

    A filter on a plain column is pushed below it with a copy of its expression, so the JSON would be parsed
    twice. A generated column stops that; a list of one element keeps the rows as they are.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def seal(text: Column) -> Column:
    return F.xxhash64(text).cast("string")


def parse_strict(text: Column, shape: str) -> Column:
    """Struct (w, z, bad): `w` is the text parsed with the DDL type `shape`; see `accepted` for its validity.

    `from_json` stops after the first value and ignores what follows. Set as a member of an outer object and
    followed by a hash of itself, the text cannot close the object early and still be followed by that hash.
    `bad` is set where the text is broken, and where a member has another type than the shape says.
    """
    wrapped = F.concat(F.lit('{"w":'), text, F.lit(',"z":"'), seal(text), F.lit('"}'))
    return F.from_json(wrapped, f"w {shape}, z string, bad string", JSON_OPTIONS)


def is_json(text: Column) -> Column:
    parsed = F.array(parse_strict(text, "string"))
    return F.coalesce(F.exists(parsed, lambda p: p["bad"].isNull() & (p["z"] == seal(text))), F.lit(False))


def accepted(parsed: Column, text: Column) -> Column:
    """Whether the parsed text is strict JSON. A member of another type is no fault, so only such rows are parsed
    once more without a shape."""
    return F.coalesce(F.when(parsed["bad"].isNull(), parsed["z"] == seal(text)).otherwise(is_json(text)), F.lit(False))


def opening(text: Column) -> Column:
    return F.substring(F.ltrim(text, F.lit(JSON_BLANKS)), 1, 1)


def has_key(payload: Column, key: str) -> Column:
    """True iff the object has the key at the top level, even with a null value."""
    return F.coalesce(F.array_contains(F.json_object_keys(payload), key), F.lit(False))


def unnest_json(payload: Column) -> Column:
    """Open JSON held in strings; payloads without such strings never leave the JVM."""
    return F.coalesce(search.unnest_json(F.when(payload.rlike(EMBEDDED_JSON), payload)), payload)


def member_text(payload: Column, key: str) -> Column:
    """A member as text: JSON of an object or array, and the content of a string."""
    return F.get_json_object(payload, f"$['{key}']")


def mentions(payload: Column, *names: str) -> Column:
    """How often the names may appear as members, also inside JSON strings; zero means there is no such member.

    A name can also be spelled with escaped ASCII letters, so each such escape counts as a mention.
    """
    choice = "|".join(names)
    return F.regexp_count(payload, F.lit(rf'"({choice})"|\\"({choice})\\|\\u00[2-7]'))


def without_long_strings(payload: Column) -> Column:
    """The payload for `mentions`, without what follows a quote for 40 characters or more up to the next quote or backslash: no name of
    a member is that long, and quotes and backslashes all stay."""
    return F.regexp_replace(payload, r'"[^"\\]{40,}+', '"')


def searches_to_itself(text: Column) -> Column:
    """Whether a search that comes upon the member of this text gives the text: it holds no JSON to be opened, and is no number
    that is written differently there."""
    return ~X.strip(text).rlike(r"^[\[{]|^-?[0-9]+[.eE]|^-0")


def in_list(listing: Column, field: str) -> tuple[Column, Column]:
    """How many objects of a list have the field, and its value in the first element, the only one a search enters."""
    count = F.coalesce(F.size(F.filter(listing, lambda x: x[field].isNotNull())), F.lit(0))
    return F.greatest(count, F.lit(0)), F.get(listing, F.lit(0))[field]


def text_list(cell: Column) -> Column:
    """Cell holding a JSON list to an array of texts; a missing, broken or other cell is an empty list."""
    parsed = F.when((opening(cell) == "[") & is_json(cell), F.from_json(cell, "array<string>"))
    return F.coalesce(parsed, F.array().cast("array<string>"))
