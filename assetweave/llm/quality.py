"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives a score; ordered thresholds cut it into grades:
P(grade <= j) = sigmoid(threshold_j - score). From these come the expected grade and the tail probability of the grade
that is asked for. Features of a text are its distinct words without punctuation, bins of a few shares (symbols, capitals,
distinct words, repeated words), and the beginnings of `STEM` characters that at least two of its words have, with the
levels of `STEM_SHARES` that their share of the words reaches: they show families of words whose forms are each rare.
Words and bins are hashed into 2^FEATURE_BITS weights, beginnings into as many others.

The model is fitted on the driver on at most `MOST_RATED` rated texts, those with the smallest hashes of their doc_id, with
all their features; a text has at most as many as there are weights. Scoring is one scan without a shuffle.

Defined results: null and empty texts have no words, and are scored by their bins alone; rows without a rating grade
or doc_id are not used to fit; of several ratings of a document the lowest counts; with fewer than two grades among
the ratings there is nothing to learn, and every text has the top grade; an empty table gives no rows. Of several rows of a
rated doc_id the smallest text is learned from. All columns are kept; the score takes the name it is given, which
must be free.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from assetweave.llm.scratch import free_name
from assetweave.llm.shingles import _BLANK, _LOWER
from assetweave.llm.spans import hash_spans, mix
from assetweave.llm.streams import arrow_stream, give_back

MOST_RATED = 6000
FEATURE_BITS = 18
WEIGHTS = 2 << FEATURE_BITS  # of words and bins, then of word beginnings
STEM = 5  # characters of a word's beginning
STEM_SHARES = (0.005, 0.01)
LEAST_TEXTS = 5  # a feature of fewer rated texts has no weight
SCREEN = 4  # standard deviations
PART = 1 << 20
STEPS, RATE, RIDGE = 300, 0.1, 3e-3
_WORD = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])
_KEEPS = np.array([chr(b).isalnum() or b >= 128 or chr(b) in " \n\t.,'" for b in range(256)])


def _parts(data: bytes) -> Iterator[bytes]:
    """A text in parts of at most PART bytes, cut at blanks where there are any."""
    while len(data) > PART:
        cut = data.rfind(b" ", 1, PART)
        cut = cut if cut > 0 else PART
        yield data[:cut]
        data = data[cut:]
    yield data


def _bin(kind: int, share: float, edges: tuple[float, ...]) -> int:
    return kind * 16 + int(np.searchsorted(edges, share))


def features(text: str | None) -> np.ndarray:
    """Distinct hashed features of a text, sorted."""
    found, words, begun, symbols, upper, letters, again, size = [], [], [], 0, 0, 0, 0, 0
    for part in _parts((text or "").encode()):
        data = np.frombuffer(part, np.uint8)
        inside = np.concatenate([[False], ~_BLANK[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        lower = _LOWER[data]
        hashes = hash_spans(lower, starts, ends)
        letters_in = np.concatenate([[False], _WORD[data], [False]])
        turns = np.flatnonzero(letters_in[1:] != letters_in[:-1])
        found.append(np.unique(hash_spans(lower, turns[::2], turns[1::2])))
        begun.append(_beginnings(data, lower, turns[::2], turns[1::2]))
        words.append(np.unique(hashes))
        again += int((hashes[1:] == hashes[:-1]).sum())
        symbols += int((~_KEEPS[data]).sum())
        capital = (data >= 65) & (data <= 90)
        upper += int(capital.sum())
        letters += int((((data | 32) >= 97) & ((data | 32) <= 122)).sum())
        size += len(starts)
    total, distinct = max(1, size), len(np.unique(np.concatenate(words)))
    fine = (0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)
    bins = [
        _bin(1, symbols / total, (0.01, 0.03, 0.1, 0.2, 0.4, 0.8, 1.5, 3.0)), _bin(2, upper / max(1, letters), fine),
        _bin(3, distinct / total, (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)), _bin(4, again / total, fine), _bin(5, float(size), (1, 5, 10, 30, 100, 1000, 10000)),
    ]
    found.append(mix(np.array(bins, np.uint64) + np.uint64(1 << 40)))
    plain = np.unique((np.concatenate(found) >> np.uint64(64 - FEATURE_BITS)).astype(np.int32))
    return np.concatenate([plain, _levels(begun, total) + np.int32(1 << FEATURE_BITS)])


def _beginnings(data: np.ndarray, lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the beginnings of the words of at least STEM characters, and their counts."""
    places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where characters start
    first, after = np.searchsorted(places, starts), np.searchsorted(places, ends)
    long = after - first >= STEM
    return np.unique(hash_spans(lower, starts[long], places[first[long] + STEM]), return_counts=True)


def _levels(begun: list[tuple[np.ndarray, np.ndarray]], total: int) -> np.ndarray:
    """Hashed features of the beginnings of two words or more: one for each share they reach."""
    stems, place = np.unique(np.concatenate([h for h, _ in begun]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([c for _, c in begun]), len(stems))
    reached = [mix(stems[(counts >= 2) & (counts >= share * total)] + np.uint64(k)) for k, share in enumerate(STEM_SHARES)]
    return np.unique((np.concatenate(reached) >> np.uint64(64 - FEATURE_BITS)).astype(np.int32))


@dataclass
class Model:
    weights: np.ndarray  # one for each hashed feature
    thresholds: np.ndarray  # rising; one fewer than grades

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j from 1."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


def screened(texts: list[np.ndarray], grades: np.ndarray, top: int) -> np.ndarray:
    """Features of enough texts that go with one of the grade borders more than chance would make them."""
    by_grade = np.zeros((top + 1, WEIGHTS))
    for text, grade in zip(texts, grades):
        by_grade[grade, text] += 1  # the features of a text are distinct
    count, strength = by_grade.sum(axis=0), np.zeros(WEIGHTS)
    for border in range(1, top + 1):
        share = (grades >= border).mean()
        if 0 < share < 1:
            excess = by_grade[border:].sum(axis=0) - count * share
            strength = np.maximum(strength, np.abs(excess) / np.sqrt(np.maximum(count, 1) * share * (1 - share)))
    return np.flatnonzero((count >= LEAST_TEXTS) & (strength >= SCREEN))


def fit(texts: list[np.ndarray], grades: np.ndarray, top: int) -> Model | None:
    """Maximum likelihood with a ridge, by Adam on all texts at once; None if there are fewer than two grades."""
    if len(np.unique(grades)) < 2:
        return None
    known = screened(texts, grades, top)
    number = np.full(WEIGHTS, -1, np.int32)
    number[known] = np.arange(len(known))
    texts = [n[n >= 0] for n in (number[t] for t in texts)]
    column, row = np.concatenate(texts), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    # Rare features count for more, so that common words do not outweigh them in long texts.
    rarity = np.log(len(texts) / np.bincount(column, minlength=len(known)).clip(1)) + 0.1
    share = np.array([(grades <= j).mean() for j in range(top)]).clip(1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    # Thresholds as a first one and logarithms of steps, so they stay ordered.
    cuts = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.05))])
    params = np.concatenate([np.zeros(len(known)), cuts])
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        weights, cuts = params[:len(known)], params[len(known):]
        thresholds = np.cumsum(np.concatenate([cuts[:1], np.exp(cuts[1:])]))
        score = np.bincount(row, (weights * rarity)[column], len(texts))
        bounds = np.concatenate([[-1e9], thresholds, [1e9]])
        low, high = _sigmoid(bounds[grades] - score), _sigmoid(bounds[grades + 1] - score)
        inside = np.maximum(high - low, 1e-9)
        slope_low, slope_high = low * (1 - low) / inside, high * (1 - high) / inside
        by_score = (slope_high - slope_low) / len(texts)  # of the negative log-likelihood
        by_threshold = np.array([
            (slope_low[grades == j + 1].sum() - slope_high[grades == j].sum()) / len(texts) for j in range(top)
        ])
        by_cut = np.cumsum(by_threshold[::-1])[::-1] * np.concatenate([[1.0], np.exp(cuts[1:])])
        slope = np.concatenate([rarity * np.bincount(column, by_score[row], len(known)) + RIDGE * weights, by_cut])
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        params = params - RATE * (1 - (step - 1) / STEPS) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    full = np.zeros(WEIGHTS, np.float32)
    full[known] = params[:len(known)] * rarity
    cuts = params[len(known):]
    return Model(full, np.cumsum(np.concatenate([cuts[:1], np.exp(cuts[1:])])))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def feature_column(text: str | Column) -> Column:
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([features(t.as_py()) for t in batch], pa.list_(pa.int32()))

    return arrow_stream(hashed, "array<int>")(text)


def train(docs: DataFrame, ratings: DataFrame, top: int, most: int = MOST_RATED) -> Model | None:
    """Fit on documents with a rating; `ratings` has doc_id and grade, 0 to `top`."""
    rated = ratings.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # `most` rows of 16 bytes
    texts = docs.select(docs["doc_id"], docs["text"]).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))  # one text of an id, so the bound holds for rows too
    rows = texts.select("doc_id", "grade", feature_column("text").alias("features")).toArrow().sort_by("doc_id")
    grades = np.clip(rows["grade"].to_numpy().astype(np.int64), 0, top)
    model = fit([x.values.to_numpy() if x.values is not None else np.zeros(0, np.int32) for x in rows["features"]], grades, top)
    del rows
    give_back()  # the driver goes on with other stages
    return model


def score(docs: DataFrame, model: Model | None, top: int, keep_grade: int, text: str = "text", name: str = "quality") -> DataFrame:
    """All columns, and struct `name`: expected_grade and tail, the probability of `keep_grade` or better."""
    if name in docs.columns:
        raise ValueError(f"the documents have a column {name} already")
    if model is None:
        return docs.withColumn(name, F.struct(F.lit(float(top)).alias("expected_grade"), F.lit(1.0).alias("tail")))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB of weights

    def grade(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            scores = np.array([model.weights[features(t.as_py())].sum(dtype=np.float64) for t in batch])
            tails = model.tails(scores) if len(scores) else np.zeros((0, top))
            yield pa.StructArray.from_arrays(
                [pa.array(tails.sum(axis=1)), pa.array(tails[:, keep_grade - 1])], ["expected_grade", "tail"]
            )

    return docs.withColumn(name, arrow_stream(grade, "struct<expected_grade:double,tail:double>")(docs[text]))


TOP, KEEP_GRADE, KEEP_TAIL = 2, 2, 0.6


def graded(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 poor, 1 fair prose that is toxic, 2 clean."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) == 1
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(toxic, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"))


def classify(docs: DataFrame, labels: DataFrame, name: str = "quality") -> DataFrame:
    """All columns, and struct `name`, which must be no column of the documents."""
    return score(docs, train(docs, graded(labels), TOP), TOP, KEEP_GRADE, name=name)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose probability of the clean grade is high enough, with their own columns only."""
    name = free_name(docs.columns, "quality")
    return classify(docs, labels, name).where(F.col(name)["tail"] >= KEEP_TAIL).select(*docs.columns)
