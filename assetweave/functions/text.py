"""Scalar text rules shared by all operators: blank test, numbers, times, previews."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# Every character that counts as white space at the ends of a value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
    "        　"
)

# Operation words after trimming and lower-casing.
RELEASE_WORDS = ("release", "released", "publish", "online", "up")
WITHDRAW_WORDS = ("withdraw", "offline", "down", "delete", "deleted")

TIME_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}$"
INTEGER_PATTERN = r"^[+-]?\d+(_\d+)*$"
MOST_DIGITS = 4300  # longer integer text is no number


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def is_present(col: Column) -> Column:
    """True iff the value is neither null nor only white space."""
    return F.coalesce(strip(col) != "", F.lit(False))


def present(col: Column) -> Column:
    """The value itself, or null where it is blank."""
    return F.when(is_present(col), col)


def parse_integer(col: Column) -> Column:
    """Integer text to BIGINT, else null. Underscores between digits are allowed, decimals are not."""
    text = strip(col)
    return F.when(text.rlike(INTEGER_PATTERN), F.replace(text, F.lit("_")).try_cast("bigint"))


def parse_version(col: Column) -> Column:
    """Integer text of any length in its shortest form (no plus, no leading zeros, no underscores), else null."""
    def shortest(bare: Column) -> Column:
        digits = F.regexp_replace(bare, r"^[+-]?0*(?=\d)", "")
        sign = F.when(F.startswith(bare, F.lit("-")) & (digits != "0"), "-").otherwise("")
        given = F.char_length(F.regexp_replace(bare, r"^[+-]", ""))
        return F.when(given <= MOST_DIGITS, F.concat(sign, digits))

    text = strip(col)
    return F.when(text.rlike(INTEGER_PATTERN), let(F.replace(text, F.lit("_")), shortest))


def version_key(version: Column) -> Column:
    """A text whose order is the numeric order of the integers `parse_version` gives: sign, number of digits, digits; a
    negative one has every digit complemented."""
    def key(v: Column) -> Column:
        digits = F.ltrim(v, F.lit("-"))
        size = F.concat(F.lpad(F.char_length(digits).cast("string"), 4, "0"), digits)
        return F.when(F.startswith(v, F.lit("-")), F.concat(F.lit("0"), F.translate(size, "0123456789", "9876543210"))).otherwise(
            F.concat(F.lit("1"), size))

    return let(version, key)


def parse_time(col: Column) -> Column:
    """The first 19 characters as a zone-less timestamp, with a blank or T between date and time."""
    text = F.substring(strip(col), 1, 19)
    return F.when(text.rlike(TIME_PATTERN), text.try_cast("timestamp_ntz"))


def format_time(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def normalize_operation(col: Column) -> Column:
    return F.lower(strip(F.coalesce(col, F.lit(""))))


def classify_operation(
    col: Column,
    release: Sequence[str] = RELEASE_WORDS,
    withdraw: Sequence[str] = WITHDRAW_WORDS,
) -> Column:
    word = normalize_operation(col)
    return (
        F.when(word.isin(*release), "release")
        .when(word.isin(*withdraw), "withdraw")
        .otherwise("unsupported")
    )


def truncate(col: Column, limit: int = 80) -> Column:
    """Long text becomes its first `limit` characters and its full length; null is spelled out."""
    return (
        F.when(col.isNull(), "<missing>")
        .when(F.char_length(col) <= limit, col)
        .otherwise(F.concat(F.substring(col, 1, limit), F.lit("...<len="), F.char_length(col), F.lit(">")))
    )


def preview(col: Column, limit: int = 200) -> Column:
    """One-line preview of a raw value for the reject output."""
    line = F.replace(F.replace(col, F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n"))
    return (
        F.when(col.isNull(), "<None>")
        .when(line == "", "<empty>")
        .otherwise(truncate(line, limit))
    )


def strip_family(col: Column, family: str = "cf") -> Column:
    """`family:name` to `name`; a name of another family is kept whole."""
    return F.when(F.startswith(col, F.lit(f"{family}:")), F.substring(col, len(family) + 2, 1 << 30)).otherwise(col)


def after_colon(col: Column) -> Column:
    """Whatever follows the first colon, or the text itself."""
    return F.when(F.contains(col, F.lit(":")), F.regexp_replace(col, r"(?s)^[^:]*:", "")).otherwise(col)


def route(base: str, table_name: Column, split_test: bool = True) -> Column:
    """Target of a message: the test table when the message names a table and the switch is on."""
    if not split_test:
        return F.lit(f"{base}_prod")
    return F.when(is_present(table_name), f"{base}_test").otherwise(f"{base}_prod")


def package_texts(package_ids: Sequence[object] | str | None) -> list[str]:
    """Package ids as text; a number and its text form name the same package."""
    if package_ids is None:
        return []
    items = package_ids.split(",") if isinstance(package_ids, str) else package_ids
    texts = [str(item).strip() for item in items]
    return [str(int(t)) if t.lstrip("+-").isdigit() else t for t in texts if t]
