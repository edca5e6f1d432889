from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetweave.llm import exactdup, minhash, queries, secretscan, shingles
from assetweave.llm.components import components

from .brute import brute_copies, brute_groups, set_of


def test_sets_are_those_of_the_words():
    rng = random.Random(1)
    texts = ["", " \t\n", "One", "a b c", "\x00 b\x00c d", "É é A a", "x" * 5000, None]
    texts += ["".join(rng.choice("aB \n\x0b\x85é") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    import pyarrow as pa

    one = [len(s) for s in shingles.shingle_sets(pa.array(texts, pa.string()))]
    assert one == [len(set_of(t)) for t in texts]
    # A slice of a batch, and small blocks, give the same hashes.
    whole = shingles.shingle_sets(pa.array(texts, pa.string()))
    part = shingles.shingle_sets(pa.array(texts, pa.string()).slice(5, 50))
    assert all(np.array_equal(a, b) for a, b in zip(whole[5:55], part))
    before, shingles.BLOCK = shingles.BLOCK, 7
    try:
        assert all(np.array_equal(a, b) for a, b in zip(whole, shingles.shingle_sets(pa.array(texts, pa.string()))))
    finally:
        shingles.BLOCK = before


def near_corpus():
    """Groups of near copies with a spread of similarities, one long chain, texts that share a passage, exact copies."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows, passage = [], [word() for _ in range(60)]
    base = [word() for _ in range(90)]
    for _ in range(120):
        text = list(base)
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = word()
        rows.append(" ".join(text))
    chain = [word() for _ in range(100)]
    for _ in range(25):
        rows.append(" ".join(chain))
        chain = chain[2:] + [word(), word()]
    rows += [" ".join(passage + [word() for _ in range(rng.randint(20, 60))]) for _ in range(40)]
    rows += ["same text here", "Same  text\there", "", "  ", None, "one two three four five", "one two three four five six"]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i * 3, rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_groups_equal_brute_force(spark, docs, percent, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)  # several blocks a bucket
    rows = near_corpus()
    expected = brute_groups(rows, percent)
    found = minhash.near_groups(docs(rows), percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_groups_of_nulls_repeats_and_nothing(spark, docs):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A b c d e f"), (5, None)]
    found = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_groups(docs(rows)).collect()}
    assert found == {(None, None, None), (4, 4, True), (9, 4, False), (5, 5, True)}
    assert minhash.near_groups(docs([])).count() == 0
    kept = minhash.drop_near_copies(docs(rows))
    assert kept.columns == docs(rows).columns and sorted(r["doc_id"] for r in kept.collect()) == [4, 5]


CLASHING = ("quality", "_at_file", "_at_row", "row", "found", "id", "file", "digest", "_metadata_")


def test_near_copies_are_decided_by_row(spark, docs):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    rows = [(1, long), (2, long + "end"), (2, "quite another text that is linked with nothing at all"), (2, "quite a third text of the same number here"),
            (7, "same same same same same same"), (7, "same same same same same same"), (None, long), (None, "nameless and alone in the whole table")]
    df = docs(rows).withColumns({c: F.lit(c) for c in CLASHING})
    for drop in (minhash.drop_near_copies, exactdup.drop_copies):
        kept = drop(df)
        assert kept.columns == df.columns and all(r[c] == c for r in kept.collect() for c in CLASHING)
    kept = sorted(map(str, ((r["doc_id"], r["text"]) for r in minhash.drop_near_copies(df).collect())))
    assert kept == sorted(map(str, [rows[0], rows[2], rows[3], rows[4], rows[7]]))
    assert minhash.drop_near_copies(df.limit(0)).count() == 0


def test_a_digest_and_a_band_key_of_most_rows_are_split(spark):
    """Two thirds of the documents are copies, and the others near copies, of one text."""
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23 24"
    df = spark.range(0, 9000, 1, 8).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 != 0, text).otherwise(F.concat(F.lit(text + " "), F.col("id"))).alias("text"))
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        found = minhash.near_groups(df)
        assert {r["component_id"] for r in found.collect()} == {0}
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def test_estimates_are_close_to_the_similarity():
    rng = np.random.default_rng(2)
    for share in (0.0, 0.5, 0.85, 1.0):
        both = rng.integers(1, 2**63, 2000, dtype=np.uint64)
        cut = int(2000 * share)
        other = np.concatenate([both[:cut], rng.integers(1, 2**63, 2000 - cut, dtype=np.uint64)])
        a, b = (np.frombuffer(minhash.packed(minhash.minima(np.unique(x))), np.uint8) for x in (both, other))
        assert abs(float(minhash.estimates(a, b[None, :])[0]) - cut / (4000 - cut)) < 0.12


def test_op2_on_the_tables(spark, sf_dir, oracle, same_rows):
    same_rows(queries.op2_minhash(spark, sf_dir), oracle.execute(queries.ORACLES["op2_minhash"]))


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + k) for k in range(1, 200)] + [(500, 501), (501, 502), (502, 500), (7, 7)]
    rng.shuffle(links)
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(61)}, **{100 + k: 100 for k in range(200)}, 500: 500, 501: 500, 502: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


COPIES = [(i, "hot text " + " " * (i % 7)) for i in range(0, 300)] + [
    (1000, "a b"), (1001, "ab"), (1002, "a b"), (1003, None), (1004, ""), (1005, "\t\n"), (1006, "AB"), (1007, "a b "), (1008, "x" * 200_000),
]


@pytest.mark.parametrize("weak, files", [(False, None), (True, None), (False, 1)])
def test_exact_groups_equal_brute_force(spark, docs, weak, files):
    digest = (lambda text: F.concat(F.lit("w"), F.length(text) % 3)) if weak else exactdup.sha256
    found = exactdup.exact_groups(docs(COPIES).repartition(4), digest, files_per_batch=files, salt=50).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in found} == brute_copies(COPIES)
    assert sum(r["keep_row"] for r in found) == len({k for k, _ in brute_copies(COPIES).values()})


def test_exact_groups_of_nulls_repeats_and_nothing(spark, docs):
    rows = [(None, "a"), (None, "a"), (3, "a"), (3, "a"), (2, "a "), (None, "b")]
    found = exactdup.exact_groups(docs(rows)).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found} == {
        (None, 2, 5, False), (3, 2, 5, False), (2, 2, 5, True), (None, None, 1, True)
    }
    assert exactdup.exact_groups(docs([])).count() == 0
    kept = exactdup.drop_copies(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, "b"), (2, "a ")]


def test_op8_on_the_tables(spark, sf_dir, oracle, same_rows):
    same_rows(queries.op8_exact_dedup(spark, sf_dir), oracle.execute(queries.ORACLES["op8_exact_dedup"]))


def test_narrow_tables_have_few_files(spark):
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for name, value in zip(before, ("64", "false")):
        spark.conf.set(name, value)
    try:
        links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1000 * (F.col("id") % 7 + 1)).alias("b"))
        found = components(links)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found.count() == 600
    assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism


def test_a_step_writes_no_file_for_each_partition(spark, docs):
    wide = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in wide}
    texts = docs([(n, " ".join(f"w{n // 3}x{k}" for k in range(30)) + f" token=abcdefgh{n}") for n in range(600)]).repartition(4)
    texts = exactdup.land(texts, "texts")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    old = set(shared.iterdir())
    for name, value in wide.items():
        spark.conf.set(name, value)
    try:
        assert exactdup.drop_copies(texts).count() == 600
        assert minhash.drop_near_copies(texts).count() == 200
        secretscan.redact_documents(texts)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    new = set(shared.iterdir()) - old
    folders = Counter(p.name.rpartition("-")[0] for p in new)
    files = Counter(p.name.rpartition("-")[0] for p in new for _ in p.rglob("*.parquet"))
    assert {"kept", "dropped", "classes", "sets", "links", "more-links", "owners"} <= set(files)
    assert {n: f / folders[n] for n, f in files.items() if f / folders[n] > spark.sparkContext.defaultParallelism} == {}
    # Of a store of the one batch there is a log, no snapshot and no checksum file; a file's own check sum is the system's.
    state = [p.name for state_ in new for p in state_.glob("state/0/*/*") if p.is_file() and p.parent.name.isdigit() and not p.name.startswith(".")]
    assert set(state) == {"1.changelog"} and len(state) == 64
