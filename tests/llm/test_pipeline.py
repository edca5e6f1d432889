from __future__ import annotations

import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from assetweave.llm import quality, queries, secretscan

from .brute import brute_copies, brute_groups


def test_classifier_on_held_out_ratings():
    found = duckdb.sql(
        "SELECT d.text, CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END FROM '/root/testdata/sf0.1/documents.parquet' d "
        "JOIN '/root/testdata/sf0.1/labels.parquet' l USING (doc_id) ORDER BY hash(doc_id)"
    ).fetchall()
    texts, grades = [quality.features(t) for t, _ in found], np.array([g for _, g in found])
    cut = 2600
    model = quality.fit(texts[:cut], grades[:cut], 2)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(np.array([model.weights[t].sum() for t in texts[cut:]]))
    assert (tails[:, 0] >= tails[:, 1]).all()
    kept = tails[:, 1] >= quality.KEEP_TAIL
    assert kept[grades[cut:] == 2].mean() > 0.98
    assert kept[grades[cut:] == 0].mean() < 0.05
    assert kept[grades[cut:] == 1].mean() < 0.4  # a quarter of the toxic ones has no toxic word
    shown = tails.sum(axis=1)
    assert shown[grades[cut:] == 0].mean() < shown[grades[cut:] == 1].mean() < shown[grades[cut:] == 2].mean()


def test_classifier_finds_toxic_texts_of_all_languages():
    found = duckdb.sql(
        "SELECT d.text, CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END, lang FROM '/root/testdata/sf0.1/documents.parquet' d "
        "JOIN '/root/testdata/sf0.1/labels.parquet' l USING (doc_id) ORDER BY hash(doc_id)"
    ).fetchall()
    texts, grades, lang = [quality.features(t) for t, _, _ in found], np.array([g for _, g, _ in found]), np.array([l for *_, l in found])
    cut = 2600
    model = quality.fit(texts[:cut], grades[:cut], 2)
    kept = model.tails(np.array([model.weights[t].sum() for t in texts[cut:]]))[:, 1] >= quality.KEEP_TAIL
    toxic, lang = grades[cut:] == 1, lang[cut:]
    assert kept[toxic].mean() < 0.2
    for one in ("en", "de", "fr", "es"):
        assert kept[toxic & (lang == one)].mean() < 0.3
        assert kept[(grades[cut:] == 2) & (lang == one)].mean() > 0.98


def test_beginnings_count_words_of_one_family():
    def beginnings(text):
        return {int(f) for f in quality.features(text) if f >= 1 << quality.FEATURE_BITS}

    assert beginnings("réêabc x réêabd y") == beginnings("réêabe u réêabf v") != set()
    assert beginnings("réêabc x y") == set() == beginnings("réêa réêa")
    assert len(beginnings("abcdea abcdeb " + "x " * 300)) == 1


def test_gradient_follows_the_likelihood(monkeypatch):
    monkeypatch.setattr(quality, "RIDGE", 0.0)
    monkeypatch.setattr(quality, "SCREEN", 0.0)
    rng = np.random.default_rng(0)
    texts = [np.unique(rng.integers(0, 40, 8)).astype(np.int32) for _ in range(400)]
    score = np.array([(t < 10).sum() for t in texts])
    grades = np.digitize(score, [1, 3])
    model = quality.fit(texts, grades, 2)
    tails = model.tails(np.array([model.weights[t].sum() for t in texts]))
    assert ((tails >= 0.5).sum(axis=1) == grades).mean() > 0.95


def test_long_texts_have_the_features_of_all_their_parts(monkeypatch):
    rng = random.Random(4)
    text = " ".join(rng.choice(["alpha", "Beta", "gamma&&&", "é", "x|"]) for _ in range(4000))
    whole = quality.features(text)
    monkeypatch.setattr(quality, "PART", 1000)
    assert set(quality.features(text)) == set(whole)


def test_rated_texts_are_fitted_with_all_their_features(docs):
    text = " ".join(f"w{i}" for i in range(30_000))
    row = docs([(1, text)]).select(quality.feature_column("text").alias("features")).first()
    assert row["features"] == quality.features(text).tolist() and len(row["features"]) > 20_000


def test_classifier_without_ratings_nulls_and_nothing(spark, docs):
    rows = docs([(1, "a b c"), (2, None), (2, None), (None, "")])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    graded = quality.classify(rows, labels)
    assert graded.count() == 4 and graded.where("quality.tail = 1").count() == 4
    mixed = spark.createDataFrame([(1, 1, None), (2, 0, 1), (2, None, None), (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    assert quality.classify(rows, mixed).count() == 4
    assert quality.classify(docs([]), mixed).count() == 0


def test_op9_on_the_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op9_quality(spark, sf_dir)
    assert rows.count() == 1000 and rows.select("doc_id").distinct().count() == 1000
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = rows.join(labels, "doc_id").where("quality = 1 AND toxic = 0")
    assert clean.where("NOT kept").count() <= 0.03 * clean.count()


def test_stages_take_effect_and_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, names = docs.columns, [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.land(stage(spark, docs, sf_dir), "test")
        assert after.columns == columns and after.dtypes == docs.dtypes
        before_rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        kept[name] = {r["doc_id"]: r["text"] for r in after.select("doc_id", "text").collect()}
        if name == "exact dedup":
            assert set(kept[name]) == {keep for keep, _ in brute_copies(before_rows).values()}
        if name == "minhash near-dedup":
            assert set(kept[name]) == {root for _, root in brute_groups(before_rows, 80).values()}
        if name == "secret scans":
            assert set(kept[name]) == {i for i, _ in before_rows}
            live = secretscan.scan(docs).where(F.exists("spans", lambda s: s["label"] == "live"))
            changed = {i for i, text in before_rows if text != kept[name][i]}
            assert changed == {r["doc_id"] for r in live.collect()}
            assert all("[SECRET]" in kept[name][i] for i in changed)
            assert after.where(F.col("n_chars") != F.length("text")).count() == 0
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(kept["secret scans"])


def brute_score(text, model, top):
    """Expected grade and probability of the best grade, one sigmoid after another."""
    total = sum(float(model.weights[f]) for f in quality.features(text))
    tails = [1 / (1 + math.exp(float(t) - total)) for t in model.thresholds]
    return sum(tails), tails[top - 1]


def test_op9_equals_brute_force_scores(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, quality.graded(labels), quality.TOP)
    rows = {r["doc_id"]: r for r in queries.op9_quality(spark, sf_dir).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        expected, tail = brute_score(text, model, quality.TOP)
        assert abs(rows[doc_id]["expected_grade"] - expected) < 1e-4 and abs(rows[doc_id]["tail_probability"] - tail) < 1e-4
        assert rows[doc_id]["kept"] == (tail >= quality.KEEP_TAIL) or abs(tail - quality.KEEP_TAIL) < 1e-6


def loss(params, x, grades, rarity, ridge):
    """Mean negative log-likelihood of the ordinal model with three grades, and the ridge, written out text by text."""
    n = x.shape[1]
    weights, first, step = params[:n], params[n], params[n + 1]
    cuts, total = [first, first + math.exp(step)], 0.0
    sigmoid = lambda v: 1 / (1 + math.exp(-max(min(v, 50), -50)))
    for row, grade in zip(x, grades):
        score = sum(w * r for w, r, has in zip(weights, rarity, row) if has)
        at_most = [sigmoid(c - score) for c in cuts]
        total -= math.log([at_most[0], at_most[1] - at_most[0], 1 - at_most[1]][grade])
    return total / len(grades) + ridge / 2 * float(weights @ weights)


def test_fit_equals_a_plain_optimiser_on_a_few_features(monkeypatch):
    monkeypatch.setattr(quality, "SCREEN", 0.0)
    monkeypatch.setattr(quality, "STEPS", 3000)
    rng = np.random.default_rng(5)
    x = rng.random((150, 4)) < 0.5
    grades = np.digitize(x @ np.array([2.0, -1.0, 1.0, 0.2]) + rng.normal(0, 1, 150), [0.0, 1.5])
    assert set(grades) == {0, 1, 2}
    model = quality.fit([np.flatnonzero(row).astype(np.int32) for row in x], grades, 2)
    rarity = np.log(len(x) / x.sum(axis=0)) + 0.1
    fitted = np.concatenate([model.weights[:4] / rarity, [model.thresholds[0], math.log(model.thresholds[1] - model.thresholds[0])]])

    def slope(params, step=1e-5):
        return np.array([(loss(params + step * e, x, grades, rarity, quality.RIDGE) - loss(params - step * e, x, grades, rarity, quality.RIDGE)) / (2 * step)
                         for e in np.eye(len(params))])

    assert np.abs(slope(fitted)).max() < 5e-3  # numeric differences see no way down either
    params = np.zeros(6)
    for _ in range(400):  # plain gradient descent from nowhere
        params = params - 1.0 * slope(params)
    assert abs(loss(params, x, grades, rarity, quality.RIDGE) - loss(fitted, x, grades, rarity, quality.RIDGE)) < 1e-3
    assert np.abs(params - fitted).max() < 0.15


CLASHING = ("quality", "_quality", "_at_file", "_at_row", "row", "found", "spans", "id", "digest")


def test_stages_take_nulls_repeats_and_clashing_names(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(1, "some clean text of a few words", "en", "s"), (1, "another text under the same number", "en", None), (None, None, None, None),
            (2, "", "en", "s"), (2, "", "en", "s"), (None, "token=abcdefgh", "de", "t"), (9, "password: hunter2hunter", "en", "s")]
    docs = spark.createDataFrame([(*r, len(r[1]) if r[1] else None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(c) for c in CLASHING})
    for table in (docs, docs.limit(0)):
        table, path = corpus_pipeline.land(table, "odd"), str(tmp_path)
        for name, stage in corpus_pipeline.STAGES:
            after = corpus_pipeline.land(stage(spark, table, path), "odd")
            if name == "best-fit packing":
                assert (after.count() > 0) == (table.count() > 0)
                break
            assert after.columns == table.columns and after.dtypes == table.dtypes, name
            assert all(r[c] == c for r in after.collect() for c in CLASHING), name
            table = after
    texts = {r["text"] for r in table.collect()}
    assert texts == set()  # the empty table came last


def test_a_rating_sends_one_text_to_the_driver(spark, docs, monkeypatch):
    sent = []
    monkeypatch.setattr(quality, "fit", lambda texts, grades, top: sent.append(len(texts)))
    ratings = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, grade int")
    quality.train(docs([(1, f"text {n}") for n in range(50)] + [(2, "x")]), ratings, 2)
    assert sent == [2]
