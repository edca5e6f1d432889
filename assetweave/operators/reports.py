"""Text reports over all keys: what a stored row holds and what the document index has for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from assetweave.operators.scan import places
from assetweave.session import materialize

_PATH = "array<struct<path:string,type:string>>"


def _paths(value: Column, kind: DataType, path: str) -> Column:
    """The paths of one value with their types: an array is listed with its length, and its first element is entered."""
    if isinstance(kind, StructType):
        inner = [_paths(value[f.name], f.dataType, f"{path}.{f.name}" if path else f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.concat(*inner)).otherwise(F.array().cast(_PATH)) if path else F.concat(*inner)
    name: Column = F.lit("string" if isinstance(kind, StringType) else kind.simpleString())
    if isinstance(kind, ArrayType):
        name = F.concat(F.lit("list["), F.size(value).cast("string"), F.lit("]"))
    own = F.array(F.struct(F.lit(path).alias("path"), name.alias("type"))).cast(_PATH)
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        own = F.concat(own, _paths(F.get(value, F.lit(0)), kind.elementType, f"{path}[0]"))
    return F.when(value.isNotNull(), own).otherwise(F.array().cast(_PATH))


def document_paths(documents: DataFrame) -> Column:
    """array<struct<path, type>> of the present fields of a document, by path, from the schema of the index."""
    return F.array_sort(_paths(F.struct(*[F.col(c) for c in documents.columns]), documents.schema, ""))


def _lines(*lines: Column) -> Column:
    return F.array(*[F.coalesce(c, F.lit("None")) for c in lines])


def _numbered(documents: DataFrame, size: int) -> DataFrame:
    """(asset_id, doc_id, hit): the documents of each asset counted by document id, the first `size` of them or all. All of them
    are counted in one total order of assets and documents, so an asset with very many is no single task's work."""
    rows = documents.select("asset_id", "doc_id")
    if size > 0:
        numbered = rows.withColumn("hit", F.row_number().over(Window.partitionBy("asset_id").orderBy("doc_id")).cast("bigint"))
        return numbered.where(F.col("hit") <= size)
    placed = places(rows, ["asset_id", "doc_id"])
    first = materialize(placed.groupBy("asset_id").agg(F.min("place").alias("first")), "report-first")
    return placed.join(first, "asset_id").select("asset_id", "doc_id", (F.col("place") - F.col("first") + 1).alias("hit"))


def document_report(
    table: DataFrame, ids: DataFrame, documents: DataFrame, size: int = 10, key: str = "row_key", asset: str = "assert_id"
) -> DataFrame:
    """(row_key, hit, line_no, line): for every stored row its report, lines in the order of (hit, line_no).

    Hit 0 is the head: the row, its columns and the number of its documents. Then come the first `size` documents by
    document id, or all with 0, each with its fields, paths and JSON. `ids` has (row_key, asset_id) as `reconcile.asset_ids`
    gives it; row keys and document ids are unique. Documents are landed before they meet the rows, so an asset with very many rows is split like any hot key of a join.
    """
    fields = [c for c in documents.columns if c != "doc_id"]
    present = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), c) for c in sorted(fields)]))
    given = F.struct(*[F.col(c) for c in fields if c != asset]).alias("_given")
    shown = documents.where(F.col(asset).isNotNull()).select(F.col(asset).alias("asset_id"), "doc_id", given)
    hits = _numbered(shown, size).join(shown, ["asset_id", "doc_id"])
    first = shown.groupBy("asset_id").agg(F.count(F.lit(1)).alias("total"))
    first = materialize(first, "report-totals")
    wanted = materialize(ids.select(key, "asset_id"), "report-ids")
    columns = [c for c in table.columns if c != key]
    stored = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), c) for c in sorted(columns)]))
    heads = table.select(key, stored.alias("stored")).join(wanted, key)
    some = first.select("asset_id", "total")
    alone = heads.join(some, "asset_id", "left_anti")
    heads = heads.join(some, "asset_id").unionByName(alone, allowMissingColumns=True)
    total = F.coalesce("total", F.lit(0))
    returned = F.least(total, F.lit(size)) if size > 0 else total
    head = F.concat(
        _lines(F.lit("=== stored row ==="), F.concat(F.lit("row_key="), key), F.concat(F.lit("assetId="), "asset_id")),
        F.when(F.size("stored") > 0, F.array(F.concat(F.lit("columns="), F.array_join("stored", ",")))).otherwise(F.array().cast("array<string>")),
        _lines(F.lit(""), F.lit("=== documents ==="), F.concat(F.lit("total="), total.cast("string"), F.lit(" returned="), returned.cast("string"))),
        F.when(F.col("total").isNull(), F.array(F.concat(F.lit("No document found for "), "asset_id", F.lit(".")))).otherwise(F.array().cast("array<string>")),
    )
    top = heads.select(key, F.lit(0).cast("bigint").alias("hit"), F.posexplode(head).alias("line_no", "line"))
    # Up to here documents travel as they are; their lines, several times as long, are made where they are written.
    below = materialize(hits, "report-hits").join(wanted, "asset_id").select(key, "hit", "doc_id", F.col("asset_id").alias(asset), "_given.*")
    below = below.withColumn("_paths", document_paths(documents.select(*fields)))
    lines = F.concat(
        _lines(
            F.lit(""), F.concat(F.lit("--- document "), F.col("hit").cast("string"), F.lit(" ---")), F.concat(F.lit("_id="), "doc_id"),
            *[F.concat(F.lit(f"{f}="), F.coalesce(F.col(f).cast("string"), F.lit("None"))) for f in ("program_id", asset, "product_info_package_id")],
            F.concat(F.lit("top_level_fields="), F.array_join(present, ",")), F.concat(F.lit("field_path_count="), F.size("_paths").cast("string")),
            F.lit("=== source field paths ==="),
        ),
        F.transform("_paths", lambda p: F.concat(p["path"], F.lit(" ("), p["type"], F.lit(")"))),
        _lines(F.lit("=== source JSON ==="), F.to_json(F.struct(*[F.col(c) for c in sorted(fields)]))),
    )
    return top.unionByName(below.select(key, "hit", F.posexplode(lines).alias("line_no", "line")))
