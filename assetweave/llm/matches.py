"""Places of regular-expression matches, with built-in expressions only.

Spark gives matches but not their places. The gaps between matches come from a split with the same pattern; the places
are running sums of the lengths of gaps and matches. The sums are taken in blocks, so that a text with very many matches
costs n * (256 + n / 256) steps and no join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

_BLOCK = 256


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, x: total + x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once. Inside a lambda an expression would be computed for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _carried(values: Column, of_block: Callable[[Column], Column]) -> Column:
    """For each block of an array the aggregate of all blocks before it."""
    blocks = F.transform(
        F.when(F.size(values) > 0, F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int"))).otherwise(F.array().cast("array<int>")),
        lambda b: of_block(F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK))),
    )
    return let(blocks, lambda all_: F.transform(all_, lambda _, b: of_block(F.slice(all_, F.lit(1), b))))


def _in_blocks(values: Column, of_block: Callable[[Column], Column], put: Callable[[Column, Column], Column], own: int) -> Column:
    """For each number `put` of the aggregate of the blocks before and of the numbers before it in its block, with its `own`."""
    def run(it: Column) -> Column:
        return F.transform(it["v"], lambda _, i: put(
            F.get(it["c"], F.floor(i / _BLOCK).cast("int")),
            of_block(F.slice(it["v"], (i - i % _BLOCK + 1).cast("int"), (i % _BLOCK + own).cast("int"))),
        ))

    return let(values, lambda v: let(F.struct(v.alias("v"), _carried(v, of_block).alias("c")), run))


def before(lengths: Column) -> Column:
    """For each number of an array, the sum of those before it."""
    return _in_blocks(lengths, _sum, lambda blocks, inside: blocks + inside, 0)


def highest(values: Column) -> Column:
    """For each number of an array, the largest of those up to it."""
    return _in_blocks(values, F.array_max, F.greatest, 1)


def touches(span: Column, others: Column) -> Column:
    """Whether a span overlaps one of `others`, a plain column or variable, sorted and apart from each other: the first one
    that ends behind the span's start is found by halving."""
    size = F.size(others)

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        before_ = F.get(others, middle)["end"] <= span["start"]
        open_ = at["low"] < at["high"]
        return F.struct(
            F.when(open_ & before_, middle + 1).otherwise(at["low"]).alias("low"), F.when(open_ & ~before_, middle).otherwise(at["high"]).alias("high")
        )

    turns = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    first = F.aggregate(turns, F.struct(F.lit(0).alias("low"), size.alias("high")), halve, lambda at: at["low"])
    return (size > 0) & F.coalesce(F.get(others, first)["start"] < span["end"], F.lit(False))


def replaced(text: Column, spans_: Column, mark: str) -> Column:
    """The text with a mark in place of each of the sorted spans; overlapping ones become one mark.

    Merged spans come from running maxima of the ends. What lies between them is cut out of chunks of the text, so a cut
    costs a chunk and its own length, wherever in a very long text it lies.
    """
    chunk = 8192

    def between(it: Column, low: Column, high: Column) -> Column:
        blocks = F.sequence(F.floor(low / chunk).cast("int"), F.floor((high - 1) / chunk).cast("int"))
        cut = F.transform(blocks, lambda b: F.substring(
            F.get(it["chunks"], b), (F.greatest(low - b * chunk, F.lit(0)) + 1).cast("int"),
            (F.least(high - b * chunk, F.lit(chunk)) - F.greatest(low - b * chunk, F.lit(0))).cast("int"),
        ))
        return F.when(low < high, F.array_join(cut, "")).otherwise(F.lit(""))

    def build(it: Column) -> Column:
        count, last = F.size(it["apart"]), F.size(it["ends"]) - 1

        def gap(k: Column) -> Column:
            """From the end of the merged span before the k-th to its start."""
            following = F.get(it["apart"], k)  # null behind the last one
            low = F.when(k == 0, F.lit(0)).otherwise(F.get(it["ends"], F.coalesce(following - 1, last)))
            return let(F.struct(low.alias("low"), F.coalesce(F.get(it["starts"], following), it["size"]).alias("high")),
                       lambda g: between(it, g["low"], g["high"]))

        return F.array_join(F.transform(F.sequence(F.lit(0), count), gap), mark)

    def merged(it: Column) -> Column:
        """With the places of the spans that begin at or behind the end of all before."""
        apart = F.filter(F.transform(it["starts"], lambda at, i: F.when((i == 0) | (at >= F.get(it["ends"], i - 1)), i)), lambda i: i.isNotNull())
        chunks = F.transform(F.sequence(F.lit(0), F.floor(it["size"] / chunk).cast("int")), lambda b: F.substring(text, b * chunk + 1, F.lit(chunk)))
        return let(it.withField("apart", apart).withField("chunks", chunks), build)

    starts, ends = F.transform(spans_, lambda s: s["start"]), highest(F.transform(spans_, lambda s: s["end"]))
    return let(F.struct(starts.alias("starts"), ends.alias("ends"), F.length(text).alias("size")), merged)


def spans(text: Column, pattern: str, kind: str, order: int, value_group: int = 0) -> Column:
    """array<struct<start, order, end, kind, value>> of all leftmost non-overlapping matches, in code points.

    `value_group` names the group that is kept as the value. A text without a match costs one search.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    sizes = F.transform(found, F.length)
    ends = before(F.zip_with(F.slice(gaps, F.lit(1), F.size(sizes)), sizes, lambda g, m: g + m))
    starts = F.zip_with(ends, F.slice(gaps, F.lit(1), F.size(sizes)), lambda at, gap: at + gap)
    rows = F.transform(F.arrays_zip(starts.alias("s"), sizes.alias("n"), values.alias("v")), lambda r: F.struct(
        r["s"].alias("start"), F.lit(order).alias("order"), (r["s"] + r["n"]).alias("end"), F.lit(kind).alias("kind"), r["v"].alias("value"),
    ))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,value:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def joined(spans_: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
