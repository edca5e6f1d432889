"""Codes of integer vectors: every part of a vector becomes the number of its nearest codebook entry, found by a GNAT.

Each component x becomes floor(scale * x), and a vector is cut into equal consecutive parts with a codebook each. A codebook
starts as that part of the vectors with the smallest vec_ids; a round assigns every part to its nearest entry and moves each
entry to the floored mean of its parts. Tasks send one row of sums per part and entry, so a round's result on the
driver has the size of the codebooks, whatever the input.

The search tree (`Gnat`) is built over the entries of a codebook. A node picks split points far from each other; every other
entry belongs to its nearest split point, and for each pair (split point, child) the node keeps the range of distances from
the point to the child's entries. A query computes its distances to the split points and leaves a child out if by the triangle
inequality every entry of it lies farther than the nearest entry so far, strictly, so no entry that ties is lost. Square roots
are rounded outwards before they are compared; what remains is compared in exact integers, first by squared distance, then
by number. Of equal entries only the one with the smallest number is in the tree.

Defined results: a null vector, and one with a null or non-finite component, is left out, and so is one whose length differs
from that of the smallest vec_id (null ids last, equal ones by their vectors), so that all have the same parts; no row is left
if that length is no multiple of `parts`. Repeated rows count each; fewer vectors than entries make smaller codebooks; an
empty table gives no rows. Other columns, whatever their names, stay away. Squared distances are 64-bit integers: a component
too large for them raises an OverflowError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assetweave.llm.scratch import land
from assetweave.llm.streams import arrow_stream, give_back
from assetweave.llm.vectors import integer_vectors

ARITY = 8
LEAF = 8
_WIDER, _NARROWER = 1 + 1e-12, 1 - 1e-12  # far beyond the error of a square root in floating point

Codebooks = list[np.ndarray]


def _squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    off = points - entry
    return np.einsum("ij,ij->i", off, off)


def _below(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * _NARROWER


def _above(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * _WIDER


class Gnat:
    """Geometric near-neighbour access tree over the rows of `entries` with the given numbers."""

    def __init__(self, entries: np.ndarray, numbers: np.ndarray | None = None, arity: int = ARITY, leaf: int = LEAF):
        self.entries = entries
        if numbers is None:
            numbers = np.sort(np.unique(entries, axis=0, return_index=True)[1])
        self.points: list[int] = []
        self.children: list[Gnat | None] = []
        if len(numbers) <= max(leaf, arity):
            self.points = [int(n) for n in numbers]
            return
        gaps = np.stack([_squared(entries[numbers], entries[numbers[0]])])
        self.points = [int(numbers[0])]
        while len(self.points) < arity:  # the entry farthest from all split points is the next one
            far = int(np.argmax(gaps.min(axis=0)))
            self.points.append(int(numbers[far]))
            gaps = np.vstack([gaps, _squared(entries[numbers], entries[numbers[far]])])
        rest = ~np.isin(numbers, self.points)
        numbers, gaps = numbers[rest], gaps[:, rest]
        home = np.argmin(gaps, axis=0)
        self.low, self.high = np.full((arity, arity), np.inf), np.full((arity, arity), -np.inf)
        for j in range(arity):
            members = home == j
            self.children.append(Gnat(entries, numbers[members], arity, leaf) if members.any() else None)
            if members.any():
                self.low[:, j] = _below(gaps[:, members].min(axis=1))
                self.high[:, j] = _above(gaps[:, members].max(axis=1))

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each query's nearest entry, the smaller one of equal ones, and its squared distance."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        number = np.full(len(queries), len(self.entries))
        self._search(queries, np.arange(len(queries)), best, number)
        return number, best

    def _search(self, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, number: np.ndarray) -> None:
        here = queries[rows]
        gaps = np.empty((len(rows), len(self.points)), np.int64)
        for i, point in enumerate(self.points):
            gaps[:, i] = _squared(here, self.entries[point])
            nearer = (gaps[:, i] < best[rows]) | ((gaps[:, i] == best[rows]) & (point < number[rows]))
            best[rows[nearer]], number[rows[nearer]] = gaps[nearer, i], point
        if not self.children:
            return
        home, low, high = np.argmin(gaps, axis=1), _below(gaps), _above(gaps)
        for at_home in (True, False):  # the child of the nearest split point narrows the radius for the others
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                radius = _above(best[rows])[:, None]
                away = (low - radius > self.high[:, j] * _WIDER).any(axis=1) | ((high + radius) * _WIDER < self.low[:, j]).any(axis=1)
                left = ~away & ((home == j) == at_home)
                if left.any():
                    child._search(queries, rows[left], best, number)


def _cut(vectors: pa.Array, parts: int) -> np.ndarray:
    """(rows, parts, size) of a batch of integer vectors of one length."""
    flat = np.asarray(vectors.flatten())
    out = flat.reshape(len(vectors), parts, -1)
    most = isqrt(2**61 // out.shape[2]) if out.shape[2] else 0
    if len(flat) and max(int(flat.max()), -int(flat.min())) > most:
        raise OverflowError(f"vector components beyond {most} have no 64-bit squared distances")
    return out


def _sums(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, n, sums) of all parts assigned to each entry."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)  # the size of the codebooks
    size = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        trees = [Gnat(b) for b in books]
        sums = np.zeros((len(books), len(books[0]), size), np.int64)
        counts = np.zeros((len(books), len(books[0])), np.int64)
        for batch in batches:
            points = _cut(batch.column("v"), len(books)) if batch.num_rows else np.zeros((0, len(books), size), np.int64)
            for p, tree in enumerate(trees):
                to, _ = tree.nearest(points[:, p])
                np.add.at(sums[p], to, points[:, p])
                counts[p] += np.bincount(to, minlength=len(counts[p]))
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
            pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
        ], ["part", "entry", "n", "sums"])
        give_back()

    partial = vectors.select("v").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    return partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(size)]).alias("sums")
    )


def first_books(vectors: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest vec_ids, none without vectors."""
    rows = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    return list(_cut(pa.array([r["v"] for r in rows], pa.list_(pa.int64())), parts).transpose(1, 0, 2)) if rows else []


def train(vectors: DataFrame, parts: int, entries: int, rounds: int) -> Codebooks:
    """Codebooks after all rounds; each is an array (entry, component)."""
    books = first_books(vectors, parts, entries)
    for _ in range(rounds if books else 0):
        books = [b.copy() for b in books]
        for row in _sums(vectors, books).collect():
            books[row["part"]][row["entry"]] = [int(s) // row["n"] for s in row["sums"]]
    return books


def encode(vectors: DataFrame, books: Codebooks, *others: str) -> DataFrame:
    """(vec_id, code, error) and the columns `others` of each vector; `code` has two hex digits a part."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        books = shared.value
        trees = [Gnat(b) for b in books]
        for batch in batches:
            codes, error = np.zeros((len(batch), len(books)), np.uint8), np.zeros(len(batch), np.int64)
            points = _cut(batch, len(books)) if len(batch) else None
            for p, tree in enumerate(trees if len(batch) else []):
                to, off = tree.nearest(points[:, p])
                codes[:, p] = to
                error += off
            yield pa.StructArray.from_arrays([pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)], ["code", "error"])

    return vectors.select("vec_id", *others, arrow_stream(run, "struct<code:string,error:bigint>")("v").alias("to")).select("vec_id", *others, "to.*")


def digest(books: Codebooks) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(c)) for b in books for c in b.ravel()).encode()).hexdigest()


def compress(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, vector: str = "embedding") -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) of all vectors, landed, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code digit pair names at most 256 entries")
    vectors = land(integer_vectors(rows, scale, "label", vector=vector), "vectors")
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").select(F.size("v").alias("n")).first()
    size = first["n"] if first else 0
    vectors = vectors.where(F.size("v") == size) if size and size % parts == 0 else vectors.where(F.lit(False))
    books = train(vectors, parts, entries, rounds)
    if not books:
        return vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), books
    return land(encode(vectors, books, "label"), "codes"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add the error summed over all rows of equal label, null labels together. The sums are landed, so that adaptive execution
    can split a label with very many rows."""
    totals = land(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "labels")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
