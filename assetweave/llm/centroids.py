"""Centroid clustering of integer vectors (Lloyd's rounds), with built-in expressions only.

Each component x becomes floor(scale * x). The centroids are literal arrays of a round's plan: `zip_with` and `aggregate` give the
exact squared distance to each, `array_min` of (distance, number) structs the nearest one, the smaller number of equal ones.
A round's new centroids come from one aggregate with a sum per component, which tasks pre-aggregate to one row a cluster;
only these rows, `clusters` times the components, reach the driver, where the quotients are floored exactly. The integer
vectors are landed once and read by all rounds, so a lost executor costs a read of its part.

Defined results: a null vector, one of another length, and one with a null or non-finite component are left out; repeated rows
count each; a null vec_id hashes as the text `null` and comes last among equal hashes; equal hashes are ordered by their
vectors; with fewer vectors than clusters there are as many clusters as vectors; an empty table gives no rows. Other
columns, whatever their names, stay away. Numbers are 64-bit integers: components of more than about 2^27 in size raise an
arithmetic error instead of a wrong distance.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from assetweave.llm.scratch import land
from assetweave.llm.vectors import integer_vectors

Centroids = list[list[int]]


@dataclass
class Clustering:
    """`rows` has vec_id, v, cluster, distance; `inertia` is the summed distance of each cluster."""

    rows: DataFrame
    centroids: Centroids
    inertia: dict[int, int]


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> Centroids:
    """The vectors with the smallest SHA-256 of `seed:vec_id`."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    rows = vectors.orderBy(F.sha2(name, 256), F.asc_nulls_last("vec_id"), "v").limit(clusters).select("v").collect()
    return [list(r["v"]) for r in rows]


def literal(centroid: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{c}L' if c > -2**63 else '-9223372036854775807L - 1L' for c in centroid)})")


def nearest(vector: Column, centroids: Centroids) -> Column:
    """struct(distance, cluster) of the nearest centroid."""

    def squared(centroid: list[int]) -> Column:
        parts = F.zip_with(vector, literal(centroid), lambda a, b: (a - b) * (a - b))
        return F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, p: total + p)

    return F.array_min(F.array(*[
        F.struct(squared(c).alias("distance"), F.lit(number).alias("cluster")) for number, c in enumerate(centroids)
    ]))


def moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """The centroids after one round: floor(sum / count) of each component; those without vectors stay."""
    size = len(centroids[0])
    assigned = vectors.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), *[F.get("v", F.lit(i)).alias(f"v{i}") for i in range(size)])
    sums = assigned.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(size)])
    out = list(centroids)
    for row in sums.collect():
        out[row["cluster"]] = [row[f"v{i}"] // row["n"] for i in range(size)]
    return out


def cluster(
    rows: DataFrame, clusters: int, rounds: int, size: int, scale: int = 1024, seed: int = 3, vector: str = "embedding"
) -> Clustering | None:
    """Run all rounds and assign once more; None if no vector is left."""
    vectors = land(integer_vectors(rows.where(F.size(rows[vector]) == size), scale, vector=vector), "vectors")
    centroids = first_centroids(vectors, clusters, seed)
    if not centroids:
        return None
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    done = land(vectors.select("vec_id", "v", nearest(F.col("v"), centroids).alias("to")).select("vec_id", "v", "to.*"), "assigned")
    totals = done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    return Clustering(done, centroids, {r["cluster"]: int(r["inertia"]) for r in totals})


def digest(centroid: list[int]) -> str:
    """SHA-256 of the components in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def report(found: Clustering | None, rows: DataFrame) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector."""
    if found is None:
        return rows.sparkSession.createDataFrame([], _report_schema(rows))
    of = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    numbers = range(len(found.centroids))
    return found.rows.select(
        "vec_id", "cluster", "distance",
        of([F.lit(found.inertia.get(n, 0)).cast("bigint") for n in numbers]).alias("cluster_inertia"),
        F.lit(sum(found.inertia.values())).cast("bigint").alias("inertia"),
        of([F.lit(digest(found.centroids[n])) for n in numbers]).alias("centroid_sha256"),
    )


def _report_schema(rows: DataFrame) -> str:
    vec_id = rows.schema["vec_id"].dataType.simpleString()
    return f"vec_id {vec_id}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
