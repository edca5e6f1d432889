from __future__ import annotations

import gc
import hashlib
import random
import weakref
import zlib
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from assetweave.llm import bpe, packing, queries, tokenstore
from assetweave.llm.scratch import new_folder

ODD = [
    "", "   ", None, "<|endoftext|>Hi<|startoftext|> x", "don't we'll I'VE 'sound ''s", "日本語 テスト", "ΑΣ ΣΟΦΟΣ İstanbul ﬁ é é",
    "a" * 800, "a\x85b\xa0c d", "½ ²³ ª 1234567", "😀😀 hi", "\x1c\x1f a\x00b", "_a_b__", "<|end", "the " * 3000, "x" * 300 + " y",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.TOKENIZER)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    noise = ["".join(rng.choice("abcdeéüß'., 1!\n-_<|>") for _ in range(rng.randint(1, 80))) for _ in range(400)]
    return ODD + noise


def test_encode_and_decode_equal_the_library(spark, docs, library, texts):
    df = bpe.decode(bpe.encode(docs([(i, t) for i, t in enumerate(texts)]), queries.TOKENIZER), queries.TOKENIZER)
    rows = df.select("doc_id", "ids", "decoded").collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids"] == ids
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_small_blocks_and_a_small_table_change_nothing(library, texts, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 40)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    encoder = bpe.Encoder(bpe.compile_automaton(queries.TOKENIZER))
    for part in (texts[:10], texts[10:200], texts[200:]):
        ids, bounds = encoder.encode(part)
        for text, i, j in zip(part, bounds, bounds[1:]):
            assert ids[i:j].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_unknown_ids_and_null_lists_are_left_out(spark):
    df = spark.createDataFrame([([10**6, -5, 320],), (None,), ([],)], "ids array<int>")
    decoded = [r["decoded"] for r in bpe.decode(df, queries.TOKENIZER).collect()]
    assert decoded[1:] == ["", ""] and decoded[0] == bpe.compile_automaton(queries.TOKENIZER).labels[320]


def test_op1_on_the_tables(spark, sf_dir, library):
    rows = {r["doc_id"]: r for r in queries.op1_bpe(spark, sf_dir).collect()}
    found = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    assert len(rows) == len(found)
    for doc_id, text in found:
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = rows[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op3_on_the_tables(spark, sf_dir, library):
    rows = {r["doc_id"]: r for r in queries.op3_token_store(spark, sf_dir).collect()}
    start = 0
    for doc_id, text in duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall():
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        row = rows.pop(doc_id)
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert not rows


def test_store_keeps_nulls_repeats_and_order(spark, docs, library):
    path = new_folder(spark, "store")
    tokenstore.write_tokens(docs([(5, "b c"), (None, "a"), (5, "b c"), (1, None), (5, "a"), (2, "")]), path, queries.TOKENIZER, end=2)
    rows = tokenstore.with_starts(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 5, 5, 5]
    assert [r["n_tokens"] for r in rows] == [2, 1, 1, 2, 3, 3]
    assert [r["start"] for r in rows] == [0, 2, 3, 4, 6, 9]


def test_store_files_have_pages_and_small_row_groups(spark, docs, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    path = new_folder(spark, "store")
    monkeypatch.setattr(tokenstore, "partitions_for", lambda df: 1)
    rows = docs([(i, " ".join(f"w{i * j % 977}" for j in range(60))) for i in range(2000)])
    tokenstore.write_tokens(rows, path, queries.TOKENIZER, row_group_bytes=1 << 16, page_bytes=1 << 12)
    files = sorted(glob.glob(f"{path.removeprefix('file:')}/*.parquet"))
    meta = [pq.ParquetFile(f).metadata for f in files]
    assert any(m.num_row_groups > 1 for m in meta)
    column = meta[0].row_group(0).column(2)
    assert column.has_offset_index and any("DICTIONARY" in e for e in column.encodings)
    assert any("DELTA" in e for e in meta[0].row_group(0).column(0).encodings)
    some = tokenstore.read_tokens(spark, path).where("doc_id BETWEEN 10 AND 12").select("n_tokens")
    plan = some._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan and "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan
    assert some.count() == 3


def test_empty_tables(spark, docs):
    none = docs([])
    path = new_folder(spark, "store")
    tokenstore.write_tokens(none, path, queries.TOKENIZER, end=2)
    assert tokenstore.with_starts(spark, path).count() == 0
    assert bpe.encode(none, queries.TOKENIZER).count() == 0
    assert packing.pack_documents(none, queries.TOKENIZER, 0, 64).count() == 0


def check_bins(length, bins, capacity):
    assert sorted(p for b in bins for p in b) == list(range(len(length)))
    assert all(0 < sum(length[p] for p in b) <= capacity for b in bins)


def test_local_search_empties_bins_that_best_fit_leaves():
    rng = np.random.default_rng(4)
    saved = 0
    for _ in range(8):
        length = rng.integers(200, 900, 400)
        first = packing.best_fit(length.tolist(), list(range(400)), 2048)
        bins = packing.pack_lengths(length, 2048)
        check_bins(length, bins, 2048)
        assert len(bins) <= len(first)
        saved += len(first) - len(bins)
    assert saved > 0


def test_packing_of_ties_and_single_pieces():
    for length in ([2048], [1], [1024] * 7, [5] * 1000, [2000, 48, 2000, 49]):
        bins = packing.pack_lengths(np.array(length), 2048)
        check_bins(length, bins, 2048)
    assert len(packing.pack_lengths(np.array([1024] * 7), 2048)) == 4


def test_op5_on_the_tables(spark, sf_dir, library):
    rows = queries.op5_packing(spark, sf_dir).collect()
    pieces = {(r["doc_id"], r["piece"]): r for r in rows}
    assert len(pieces) == len(rows)
    count = total = 0
    for doc_id, text in duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall():
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part, row = ids[at:at + 2048], pieces[doc_id, k]
            assert (row["start"], row["length"], row["ids_crc32"]) == (at, len(part), crc(part))
            count, total = count + 1, total + len(part)
    assert count == len(rows)
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) * 1.01 + 1


def test_packing_in_many_shards_keeps_repeated_rows(spark, docs):
    df = docs([(7, "one two three")] * 50 + [(i, "word " * i) for i in range(1, 60)] + [(None, None)])
    rows = packing.pack_documents(df, queries.TOKENIZER, 0, 32, shard=10).collect()
    assert sum(r["doc_id"] == 7 for r in rows) == 51
    assert sum(r["length"] for r in rows) == 50 * 4 + sum(i + 1 for i in range(1, 60)) + 1
    fill: dict[int, int] = {}
    for r in rows:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 32


def test_bins_with_many_lengths_exchange_any_pair():
    length = np.array([*range(1, 14), 150, 28])  # with a room of 3, 28 takes the place of 12 and 13 only
    pool, bin_ = packing.Pool(400), list(range(14))
    pool.put(28, 14)
    assert packing.improve(pool, bin_, length, 3) == 0 and 14 in bin_


def test_underfull_bins_of_all_shards_are_searched_again(spark):
    df = spark.createDataFrame([(i, 40 + 20 * (i % 2)) for i in range(400)], "id long, length long")
    rows = packing.pack(df, 100, shard=100).collect()
    fill = {}
    for r in rows:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert len({r["id"] for r in rows}) == len(rows) == 400 and set(fill.values()) == {100}


def test_an_encoder_goes_with_its_automaton():
    path = queries.TOKENIZER
    shared = SimpleNamespace(value=bpe.Automaton(path))
    encoder = weakref.ref(bpe.worker_encoder(shared))
    assert bpe.worker_encoder(shared) is encoder()
    shared.value = None
    gc.collect()
    assert encoder() is None


def test_ids_are_cut_in_the_worker_that_makes_them(spark, docs, monkeypatch):
    taken = []
    monkeypatch.setattr(packing, "pack", lambda pieces, capacity, **more: taken.append(pieces))
    packing.pack_documents(docs([(1, "one two three"), (2, None)]), queries.TOKENIZER, 0, 2)
    assert taken[0]._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    rows = sorted(tuple(r) for r in taken[0].select("doc_id", "piece", "start", "length").collect())
    assert rows[-1] == (2, 0, 0, 1) and [r[3] for r in rows[:-1]].count(1) <= 1
