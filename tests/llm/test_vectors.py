from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from assetweave.llm import centroids, codes

NAN, INF = float("nan"), float("inf")


def brute_nearest(point, entries):
    return min((sum((a - b) ** 2 for a, b in zip(point, e)), n) for n, e in enumerate(entries))


@pytest.mark.parametrize("kind", ["spread", "dense", "equal", "few", "line"])
def test_gnat_finds_the_nearest_entry_with_the_smallest_number(kind):
    rng = np.random.default_rng(7)
    entries = {
        "spread": rng.integers(-1000, 1000, (300, 4)), "dense": rng.integers(-2, 3, (200, 3)),  # dense ones tie and repeat
        "equal": np.full((70, 4), 5), "few": rng.integers(-9, 9, (3, 2)), "line": np.arange(256)[:, None] * 3,
    }[kind].astype(np.int64)
    queries = np.concatenate([rng.integers(entries.min() - 5, entries.max() + 6, (400, entries.shape[1])), entries]).astype(np.int64)
    for arity, leaf in ((8, 8), (2, 1), (5, 3)):
        number, squared = codes.Gnat(entries, arity=arity, leaf=leaf).nearest(queries)
        assert [(int(d), int(n)) for d, n in zip(squared, number)] == [brute_nearest(q, entries.tolist()) for q in queries.tolist()]


def test_gnat_leaves_subtrees_out(monkeypatch):
    rng = np.random.default_rng(3)
    centers = rng.integers(-10**6, 10**6, (8, 4))
    entries = np.concatenate([c + rng.integers(-50, 50, (32, 4)) for c in centers])
    tree, looked = codes.Gnat(entries), []
    before = codes._squared
    monkeypatch.setattr(codes, "_squared", lambda points, e: looked.append(len(points)) or before(points, e))
    tree.nearest(entries)
    assert sum(looked) < 0.35 * len(entries) ** 2


def test_components_too_large_for_exact_distances_are_refused():
    import pyarrow as pa

    with pytest.raises(OverflowError):
        codes._cut(pa.array([[2**40] * 16]), 4)


ROWS = [(i, [random.Random(i).uniform(-1, 1) for _ in range(16)], i % 3 if i % 5 else None) for i in range(120)]
ODD = [(1000, None, 1), (1001, [NAN] + [0.0] * 15, 1), (1002, [None] + [0.0] * 15, 1), (1003, [-INF] + [0.5] * 15, None), (1004, [0.5] * 15, 1), (1005, [], 2)]


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumns({c: F.lit("x") for c in ("v", "code", "of_label", "distance", "cluster", "n")})


def floors(rows, scale):
    return [(i, [math.floor(scale * float(np.float32(c))) for c in v], label) for i, v, label in rows]


def brute_codes(rows, parts, entries, rounds):
    """rows of integer vectors, all of one length"""
    size = len(rows[0][1]) // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in rows]
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0], rows[r][1]))[:entries]
    books = [[list(cut[r][p]) for r in order] for p in range(parts)]
    for turn in range(rounds + 1):
        to = [[brute_nearest(c[p], books[p]) for p in range(parts)] for c in cut]
        if turn < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    mine = [cut[r][p] for r in range(len(rows)) if to[r][p][1] == e]
                    if mine:
                        books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    flat = ",".join(str(c) for b in books for e in b for c in e)
    out = [(rows[r][0], "".join(f"{n:02x}" for _, n in to[r]), sum(d for d, _ in to[r]), rows[r][2]) for r in range(len(rows))]
    return out, hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("entries", [1, 7, 30, 256])
def test_codes_equal_brute_force(spark, entries):
    rows = ROWS + ROWS[:40] + ODD  # repeated rows, equal ids among the first entries
    coded, books = codes.compress(vectors(spark, rows).repartition(5), parts=4, entries=entries, rounds=2, scale=16)
    wanted, digest = brute_codes(floors(ROWS + ROWS[:40], 16), 4, entries, 2)
    assert sorted(map(tuple, coded.select("vec_id", "code", "error").collect())) == sorted(w[:3] for w in wanted)
    assert codes.digest(books) == digest
    totals = {}
    for _, _, error, label in wanted:
        totals[label] = totals.get(label, 0) + error
    got = codes.with_label_error(coded).select("label", "label_error").distinct().collect()
    assert {r[0]: r[1] for r in got} == totals


def test_codes_of_nothing_and_of_other_lengths(spark):
    for rows in ([], ODD[:4], [(1, [1.0] * 15, 1), (2, [1.0] * 16, 1)]):
        coded, books = codes.compress(vectors(spark, rows), parts=4, entries=4)
        assert coded.count() == 0 and codes.digest(books) == hashlib.sha256(b"").hexdigest()
        assert codes.with_label_error(coded).count() == 0
    coded, _ = codes.compress(vectors(spark, [(None, [1.0] * 4, 1), (2, [1.0] * 4, 1)]), parts=4, entries=4)
    assert coded.count() == 2


def test_a_label_with_most_rows_is_split(spark):
    coded = spark.range(60000).select(
        F.col("id").alias("vec_id"), F.when(F.col("id") % 2 == 0, 7).otherwise(-F.col("id").cast("int")).alias("label"),
        F.sha2(F.col("id").cast("string"), 256).alias("code"), F.lit(1).cast("bigint").alias("error"),
    )
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        from assetweave.llm.scratch import land

        done = codes.with_label_error(land(coded.repartition(8), "coded"))
        assert done.agg(F.sum("label_error")).first()[0] == 30000 * 30000 + 30000
        done.collect()
        assert "skew" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def brute_clusters(rows, clusters, rounds, seed):
    name = lambda i: hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()
    order = sorted(rows, key=lambda r: (name(r[0]), r[1]))
    at = [list(v) for _, v, _ in order[:clusters]]
    for turn in range(rounds + 1):
        to = [brute_nearest(v, at) for _, v, _ in rows]
        if turn < rounds:
            for k in range(len(at)):
                mine = [r[1] for r, (_, n) in zip(rows, to) if n == k]
                if mine:
                    at[k] = [sum(x) // len(mine) for x in zip(*mine)]
    inertia = {}
    for d, k in to:
        inertia[k] = inertia.get(k, 0) + d
    return [(r[0], k, d, inertia[k], sum(inertia.values()), centroids.digest(at[k])) for r, (d, k) in zip(rows, to)]


@pytest.mark.parametrize("clusters", [1, 8, 200])
def test_clusters_equal_brute_force(spark, clusters):
    rows = ROWS[:60] + ROWS[:20] + [(None, ROWS[3][1], 1)]  # repeated vectors leave empty clusters behind
    df = vectors(spark, rows + ODD)
    found = centroids.cluster(df, clusters, rounds=3, size=16, scale=32, seed=3)
    key = lambda r: tuple("~" if v is None else str(v) for v in r)
    got = sorted(map(tuple, centroids.report(found, df).collect()), key=key)
    assert got == sorted(brute_clusters(floors(rows, 32), clusters, 3, 3), key=key)


def test_clusters_of_nothing(spark):
    for rows in ([], ODD):
        df = vectors(spark, rows)
        done = centroids.report(centroids.cluster(df, 8, 2, 64), df)
        assert done.count() == 0 and done.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_cluster_rounds_stay_in_the_jvm_and_sum_on_the_tasks(spark):
    df = spark.createDataFrame([(i, [i, -i]) for i in range(50)], "vec_id long, v array<bigint>")
    plan = df.select(centroids.nearest(F.col("v"), [[0, 0], [9, -9]]).alias("m"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_centroids"])
def test_vector_queries_on_the_tables(spark, sf_dir, oracle, same_rows, name):
    same_rows(entry.queries()[name](spark, sf_dir), oracle.execute(entry.oracle_sql()[name]))
