"""Reconciliation of stored asset rows with the document index, and enrichment from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from assetweave.functions import text as X
from assetweave.operators.profile import first_by_key
from assetweave.operators.scan import fetch_shared
from assetweave.session import materialize

# Package ids searched by default.
DEFAULT_PACKAGES = ("1", "141")
# Fields of a document listed in the relation report, with the column of the report.
REPORT_FIELDS = {"program_id": "program_ids", "product_info_package_id": "product_info_package_ids", "name": "names"}


def asset_ids(table: DataFrame, limit: int = 0) -> DataFrame:
    """(row_key, asset_id): the asset id, else its alternative spelling, else the row key; blank ones are dropped. With a limit
    the first ones by row key, counted after the blank ones are gone."""
    texts = [F.when(F.col(c) != "", F.col(c)) for c in ("assetId", "assert_id") if c in table.columns]
    rows = table.select("row_key", F.coalesce(*texts, F.col("row_key")).alias("asset_id"))
    rows = rows.where(X.is_present(F.col("asset_id")))
    return first_by_key(rows, limit)


def distinct_ids(rows: DataFrame) -> DataFrame:
    return rows.select("asset_id").distinct()


def landed_ids(rows: DataFrame) -> DataFrame:
    """Distinct ids, landed: a join with them then has a bare shuffle on both sides, which adaptive execution can split
    where an id is hot. With the aggregate between shuffle and join it could not."""
    return materialize(distinct_ids(rows), "ids")


def package_hits(documents: DataFrame, packages: Sequence[object] | str | None = DEFAULT_PACKAGES) -> DataFrame:
    """Documents with an asset id, of the given packages; no packages means all."""
    wanted = X.package_texts(packages)
    rows = documents.where(X.is_present(F.col("assert_id")))
    if wanted:
        rows = rows.where(F.col("product_info_package_id").cast("string").isin(*wanted))
    return rows.withColumnRenamed("assert_id", "asset_id")


def doc_lookup(
    documents: DataFrame, ids: DataFrame, packages: Sequence[object] | str | None = DEFAULT_PACKAGES,
    fields: Sequence[str] = (), size: int = 0,
) -> DataFrame:
    """Documents of the given ids; `size` keeps the first documents of each id by document id."""
    hits = package_hits(documents, packages)
    hits = hits.select("asset_id", "doc_id", *[f for f in fields if f not in ("asset_id", "doc_id")])
    if size > 0:
        # Spark keeps at most `size` rows of an id on each task before the shuffle (window group limit), so no id is
        # hot in the join behind it.
        place = F.row_number().over(Window.partitionBy("asset_id").orderBy("doc_id"))
        hits = hits.withColumn("_place", place).where(F.col("_place") <= size).drop("_place")
    return hits.join(landed_ids(ids), "asset_id", "left_semi")


def relation_join(ids: DataFrame, hits: DataFrame) -> DataFrame:
    """Every distinct id with each of its documents, or alone when there is none.

    An inner join plus the ids without a document, because adaptive execution can split a hot id on either side
    of an inner join, but not on the right side of an outer one.
    """
    wanted = landed_ids(ids)
    found = hits.join(wanted, "asset_id")
    rest = [c for c in hits.columns if c != "asset_id"]
    alone = wanted.join(distinct_ids(hits), "asset_id", "left_anti")
    return found.select("asset_id", *rest).unionByName(alone, allowMissingColumns=True)


def id_summary(ids: DataFrame, documents: DataFrame, packages: Sequence[object] | str | None = DEFAULT_PACKAGES) -> DataFrame:
    """For each distinct id its hits in the packages and in all documents, from one pass over the index."""
    wanted = X.package_texts(packages)
    rows = package_hits(documents, None)
    inside = F.col("product_info_package_id").cast("string").isin(*wanted) if wanted else F.lit(True)
    counts = rows.groupBy("asset_id").agg(F.count_if(inside).alias("hits"), F.count(F.lit(1)).alias("all_hits"))
    return distinct_ids(ids).join(counts, "asset_id", "left").na.fill(0, ["hits", "all_hits"])


def missing_ids(ids: DataFrame, hits: DataFrame) -> DataFrame:
    return distinct_ids(ids).join(distinct_ids(hits), "asset_id", "left_anti")


def missing_diagnosis(summary: DataFrame) -> DataFrame:
    reason = F.when(F.col("all_hits") > 0, "found_without_filter").otherwise("still_not_found")
    return summary.where(F.col("hits") == 0).select("asset_id", reason.alias("reason"))


def program_pairs(ids: DataFrame, hits: DataFrame) -> DataFrame:
    pairs = hits.where(X.is_present(F.col("program_id"))).select("asset_id", "program_id").distinct()
    return materialize(pairs, "pairs").join(landed_ids(ids), "asset_id", "left_semi")


def _many(pairs: DataFrame, one: str, many: str, count: str) -> DataFrame:
    pairs = materialize(pairs, "pairs")
    counts = materialize(pairs.groupBy(one).agg(F.count(many).alias(count)).where(F.col(count) > 1), "counts")
    return pairs.join(counts, one).select(one, many, count)


def multi_program(pairs: DataFrame) -> DataFrame:
    """Assets with several programmes, one row for each programme."""
    return _many(pairs, "asset_id", "program_id", "program_count")


def multi_asset(pairs: DataFrame) -> DataFrame:
    """Programmes with several assets, one row for each asset."""
    return _many(pairs, "program_id", "asset_id", "asset_count")


def field_values(hits: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Distinct present values as (asset_id, field, value)."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    rows = hits.select("asset_id", cells.alias("cell")).select("asset_id", "cell.*")
    return rows.where(X.is_present(F.col("value"))).distinct()


def _joined(values: Column) -> Column:
    return F.nullif(F.array_join(F.array_sort(values), "|"), F.lit(""))


def joined_values(hits: DataFrame, fields: Sequence[str]) -> DataFrame:
    """For each id and field the sorted distinct values joined by `|`, as columns, each cell in full.

    Values are made distinct before they are collected, with a partial step on each task. A cell is one value, so it
    has to fit into a row; `field_values` gives the same values row by row, for ids of any size.
    """
    return field_values(hits, fields).groupBy("asset_id").agg(
        *[_joined(F.collect_list(F.when(F.col("field") == f, F.col("value")))).alias(f) for f in fields],
    )


def presence(hits: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(asset_id, hit_count, has_values) of each id, without any text."""
    some = F.coalesce(F.greatest(*[X.is_present(F.col(f).cast("string")) for f in fields], F.lit(False)), F.lit(False))
    return hits.groupBy("asset_id").agg(F.count(F.lit(1)).alias("hit_count"), F.max(some).alias("has_values"))


def relation_report(
    rows: DataFrame, documents: DataFrame, packages: Sequence[object] | str | None = DEFAULT_PACKAGES
) -> DataFrame:
    """One line for each stored row: its documents in the packages or, if there are none, in all packages.

    The documents are reduced to one row an id, with the values inside the packages and all values, and landed; only
    then do they meet the stored rows.
    """
    everything = package_hits(documents, None)
    wanted = X.package_texts(packages)
    inside = F.col("product_info_package_id").cast("string").isin(*wanted) if wanted else F.lit(True)
    inside = F.coalesce(inside, F.lit(False))
    counts = everything.groupBy("asset_id").agg(F.count_if(inside).alias("hits"), F.count(F.lit(1)).alias("all_hits"))
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in REPORT_FIELDS]))
    values = everything.select("asset_id", inside.alias("inside"), cells.alias("cell")).select("asset_id", "inside", "cell.*")
    values = values.where(X.is_present(F.col("value"))).groupBy("asset_id", "field", "value").agg(F.max("inside").alias("inside"))

    def of(field: str, filtered: bool) -> Column:
        chosen = F.col("field") == field
        return F.coalesce(_joined(F.collect_list(F.when(chosen & F.col("inside") if filtered else chosen, F.col("value")))), F.lit(""))

    texts = values.groupBy("asset_id").agg(
        F.count_if((F.col("field") == "program_id") & F.col("inside")).alias("programs"),
        *[of(f, filtered).alias(f"{f}_{filtered}") for f in REPORT_FIELDS for filtered in (True, False)],
    )
    found = F.coalesce(F.col("hits") > 0, F.lit(False))

    def cell(name: str, filtered: bool) -> Column:
        return F.when(found if filtered else ~found, F.coalesce(F.col(f"{name}_{filtered}"), F.lit(""))).otherwise(F.lit(""))

    # Of an id either the values inside the packages or all are reported, so only these are landed and fetched.
    per_id = materialize(counts.join(texts, "asset_id", "left").select(
        "asset_id",
        cell("program_id", True).alias("program_ids"),
        F.when(found, F.coalesce("programs", F.lit(0))).otherwise(F.lit(0)).alias("program_count"),
        F.coalesce("hits", F.lit(0)).alias("hit_count"),
        cell("product_info_package_id", True).alias("product_info_package_ids"),
        cell("name", True).alias("names"),
        F.when(found, F.lit(0)).otherwise(F.coalesce("all_hits", F.lit(0))).alias("unfiltered_hit_count"),
        cell("product_info_package_id", False).alias("unfiltered_product_info_package_ids"),
        cell("program_id", False).alias("unfiltered_program_ids"),
        cell("name", False).alias("unfiltered_names"),
    ), "documents-of-ids")

    # As in `relation_join`: an inner join, which can be split on both sides, and the rows without a document.
    asked = rows.select("row_key", "asset_id")
    alone = asked.join(per_id.select("asset_id"), "asset_id", "left_anti")
    both = fetch_shared(asked, per_id, "asset_id", "row_key").unionByName(alone, allowMissingColumns=True)
    return both.select("row_key", "asset_id", *[
        F.coalesce(f.name, F.lit("" if f.dataType.typeName() == "string" else 0)).alias(f.name)
        for f in per_id.schema.fields if f.name != "asset_id"
    ])


def relation_summary(rows: DataFrame, summary: DataFrame, pairs: DataFrame) -> DataFrame:
    """Counts of the whole reconciliation in one row; its parts are one-row aggregates."""
    rows_part = rows.agg(F.count(F.lit(1)).alias("table_rows"))
    ids_part = summary.agg(
        F.count(F.lit(1)).alias("unique_ids"),
        F.count_if(F.col("hits") > 0).alias("matched_ids"),
        F.count_if(F.col("hits") == 0).alias("missing_ids"),
        F.count_if((F.col("hits") == 0) & (F.col("all_hits") > 0)).alias("found_without_filter"),
        F.count_if(F.col("all_hits") == 0).alias("still_not_found"),
    )

    def several(key: str, name: str) -> DataFrame:
        return pairs.groupBy(key).count().agg(F.count_if(F.col("count") > 1).alias(name))

    parts = [rows_part, ids_part, several("asset_id", "assets_with_programs"), several("program_id", "programs_with_assets")]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def relation_examples(summary: DataFrame, limit: int = 20) -> DataFrame:
    """First missing ids by name, with what they have outside the packages."""
    return missing_diagnosis(summary).orderBy("asset_id").limit(limit)


def example_lists(summary: DataFrame, hits: DataFrame, pairs: DataFrame, limit: int = 20) -> DataFrame:
    """(kind, key, listed): the first missing ids, ids with several programmes and programmes with several ids, by name, each
    with all it has: a missing id its packages and programmes outside the filter, the others what they are tied to.

    The `limit` keys of a kind are chosen before anything is listed for them.
    """
    missing = summary.where(F.col("hits") == 0).select("asset_id").orderBy("asset_id").limit(limit)
    outside = joined_values(hits.join(F.broadcast(missing), "asset_id", "left_semi"), ["product_info_package_id", "program_id"])
    packages, programs = (F.coalesce(c, F.lit("")) for c in ("product_info_package_id", "program_id"))
    known = F.concat(F.lit("package_ids="), packages, F.lit(" program_ids="), programs)
    listed = F.when((packages == "") & (programs == ""), "package_ids=<not_found>").otherwise(known)
    rows = missing.join(outside, "asset_id", "left").select(F.lit("missing").alias("kind"), F.col("asset_id").alias("key"), listed.alias("listed"))
    for kind, one, many in (("many_programs", "asset_id", "program_id"), ("many_assets", "program_id", "asset_id")):
        several = pairs.groupBy(one).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(one).limit(limit).select(one)
        chosen = pairs.join(F.broadcast(several), one, "left_semi").groupBy(F.col(one).alias("key")).agg(
            F.array_join(F.array_sort(F.collect_list(many)), ",").alias("listed"))
        rows = rows.unionByName(chosen.select(F.lit(kind).alias("kind"), "key", "listed"))
    return rows


def enrich_fields(rows: DataFrame, hits: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(row_key, fields): the cells to merge into the table, in full; rows without any value are left out."""
    return fetch_shared(*enrich_parts(rows, hits, fields), "asset_id", "row_key").select("row_key", *fields)


def enrich_parts(rows: DataFrame, hits: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The same in two parts, for a merge that fetches the cells last: (row_key, asset_id), and the cells of each id, landed."""
    cells = materialize(joined_values(hits, fields), "cells")
    return rows.select("row_key", "asset_id").join(cells.select("asset_id"), "asset_id", "left_semi"), cells


def _write_status(dry_run: bool) -> Column:
    return F.when(F.col("has_values"), "dry_run" if dry_run else "written").otherwise("not_found")


def merge_report(rows: DataFrame, hits: DataFrame, fields: Sequence[str], dry_run: bool = False) -> DataFrame:
    per_id = materialize(presence(hits, fields).join(joined_values(hits, fields), "asset_id", "left"), "cells-of-ids")
    asked = rows.select("row_key", "asset_id")
    alone = asked.join(per_id.select("asset_id"), "asset_id", "left_anti")
    return fetch_shared(asked, per_id, "asset_id", "row_key").unionByName(alone, allowMissingColumns=True).select(
        "row_key", "asset_id", F.coalesce("hit_count", F.lit(0)).alias("hit_count"), _write_status(dry_run).alias("write_status"),
        *[F.coalesce(F.col(f), F.lit("")).alias(f) for f in fields],
    )


def merge_summary(rows: DataFrame, hits: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Counts of the enrichment, from presence flags; no cell is built for them."""
    asked = rows.groupBy("asset_id").agg(F.count(F.lit(1)).alias("rows"))
    both = asked.join(presence(hits, fields), "asset_id", "left")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0))

    return both.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("scanned"),
        rows_where(F.col("hit_count") > 0).alias("matched"),
        rows_where(F.col("hit_count").isNull()).alias("missing"),
        rows_where(F.col("has_values")).alias("written"),
    )


def verify_rows(mapped: DataFrame, stored: DataFrame, fields: Sequence[str], key: str = "row_key") -> DataFrame:
    """Compare mapped documents with stored rows field by field, for all keys of either side."""
    def cells(df: DataFrame, name: str) -> DataFrame:
        packed = F.struct(*[(F.col(f).cast("string") if f in df.columns else F.lit(None).cast("string")).alias(f) for f in fields])
        return df.select(key, packed.alias(name))

    both = cells(mapped, "expected").join(cells(stored, "actual"), key, "full_outer")
    rows = both.select(key, F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"expected.{f}").alias("expected"), F.col(f"actual.{f}").alias("actual"))
        for f in fields
    ])).alias("cell")).select(key, "cell.*")
    return rows.withColumns({
        "match": F.col("expected").eqNullSafe(F.col("actual")),
        "expected_length": F.char_length("expected"),
        "actual_length": F.char_length("actual"),
    })


def verify_totals(verified: DataFrame) -> DataFrame:
    """For each field the keys whose cells match and those whose cells do not."""
    return verified.groupBy("field").agg(
        F.count_if("match").alias("matches"), F.count_if(~F.col("match")).alias("mismatches"),
        F.count_if(F.col("expected").isNotNull() & F.col("actual").isNull()).alias("missing"),
    )


def lookup_rows(table: DataFrame, keys: DataFrame, columns: Sequence[str], key: str = "row_key") -> DataFrame:
    """Chosen columns of the rows with the given keys; a key without a row gives nothing."""
    return table.select(key, *columns).join(keys.select(key).distinct(), key, "left_semi")
