"""Near-duplicate groups by b-bit MinHash.

1. One scan turns each text into its set of shingles, and the set into a digest, `HASHES` minima of which the low `BITS`
   bits are packed into a signature, and one key for each band of `ROWS` full minima. Texts with the same set are one
   class from here on, so copies are never compared.
2. Classes that share a band key are candidates. With 50 bands of 7 rows a pair with similarity 0.8 is missed with a
   probability of 8e-6, one with 0.85 with 4e-9. Only keys that several classes have are kept.
3. In each bucket every class is compared with the smallest and with the largest one. The similarity is estimated
   from the number of equal groups of bits, corrected for the chance 2^-BITS that different minima agree; pairs more than
   five standard deviations below the threshold go, all others are confirmed on full sets.
4. Buckets that then still hold classes of different components are searched in full: in blocks of at most `BLOCK`
   classes, by signature, skipping pairs that links have joined meanwhile. Only links leave a task, fewer than
   it has classes. So every candidate pair is confirmed, refuted, or already in one component.

Defined results: null and empty texts, and texts of blanks, have no shingles and are linked with nothing; rows without a
doc_id take no part and have neither component nor `kept`; repeated rows are copies of each other. `drop_near_copies` decides by
row, not by doc_id. Columns other than the two asked for are not used, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from assetweave.llm.components import components
from assetweave.llm.exactdup import FILE, ROW, located, without_rows
from assetweave.llm.scratch import files_for, free_name, land
from assetweave.llm.shingles import WORDS, shingle_hashes, shingle_sets, text_words
from assetweave.llm.spans import mix
from assetweave.llm.streams import arrow_stream, arrow_streams, give_back

ROWS = 7
BANDS = 50
HASHES = ROWS * BANDS
BITS = 4
BLOCK = 1024
SURE = 5  # standard deviations
BROADCAST_ROWS = 1_000_000  # of (doc_id, 16-byte digest): 40 MB at most
PLACES = 200_000  # of four numbers each: 16 MB at most
_FACTORS = np.random.default_rng(7).integers(1, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_CHANCE = 2.0**-BITS

SIGNATURE = "struct<n:bigint,digest:binary,signature:binary,bands:array<bigint>>"
_SIGNATURE_TYPE = pa.struct([("n", pa.int64()), ("digest", pa.binary()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(low), 512):
        np.minimum(out, (low[at:at + 512, None] * _FACTORS).min(axis=0), out=out)
    return out


def packed(values: np.ndarray) -> bytes:
    """The low BITS bits of each minimum, side by side."""
    bits = (values[:, None] >> np.arange(BITS, dtype=np.uint32) & 1).astype(np.uint8)
    return np.packbits(bits.reshape(-1)).tobytes()


def band_keys(values: np.ndarray) -> np.ndarray:
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in values.reshape(BANDS, ROWS).T:
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + column)
    return total.view(np.int64)


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def small_batches(batches: Iterator[pa.Array], rows: int = 500) -> Iterator[pa.Array]:
    """Slices of Arrow batches, so that results leave a worker before they grow."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def signature_column(text: str | Column, words: int = WORDS) -> Column:
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in small_batches(batches):
            rows = []
            for one in text_words(batch):
                shingles = shingle_hashes(one, words)
                if len(shingles):
                    values = minima(shingles)
                    rows.append((len(shingles), set_digest(shingles), packed(values), band_keys(values)))
                else:
                    rows.append((0, None, None, None))
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _SIGNATURE_TYPE)], fields=list(_SIGNATURE_TYPE)
            )

    return arrow_stream(sign, SIGNATURE)(text)


def set_column(text: str | Column, words: int = WORDS) -> Column:
    """The sorted shingle hashes of a text as bytes, with their digest."""

    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in small_batches(batches):
            found = shingle_sets(batch, words)
            yield pa.StructArray.from_arrays(
                [pa.array([set_digest(s) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())],
                ["digest", "shingles"],
            )

    return arrow_stream(sets, "struct<digest:binary,shingles:binary>")(text)


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity estimates from packed signatures (bytes), corrected for chance agreement."""
    odd = np.bitwise_xor(one, others)
    odd |= odd >> 1
    odd |= odd >> 2
    differing = np.bitwise_count(odd & 0x11).sum(axis=-1, dtype=np.int64)
    return ((HASHES - differing) / HASHES - _CHANCE) / (1 - _CHANCE)


def least_estimate(threshold: float) -> float:
    agree = threshold + (1 - threshold) * _CHANCE
    return threshold - SURE * math.sqrt(agree * (1 - agree) / HASHES) / (1 - _CHANCE)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct hashes."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[place] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _bytes(column: pa.Array, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype) for x in column]


def _estimate_column(a: str, b: str) -> Column:
    def estimate(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for x, y in batches:
            yield pa.array(estimates(np.stack(_bytes(x, np.uint8)), np.stack(_bytes(y, np.uint8))) if len(x) else [], pa.float64())

    return arrow_streams(estimate, "double")(a, b)


def _linked_column(a: str, b: str, percent: int) -> Column:
    def confirm(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for x, y in batches:
            yield pa.array([linked(p, q, percent) for p, q in zip(_bytes(x, np.uint64), _bytes(y, np.uint64))], pa.bool_())

    return arrow_streams(confirm, "boolean")(a, b)


def bucket_links(classes: list, component: list, signature: list, shingles: list, percent: int) -> list[tuple]:
    """Links that join the components of one block of classes: every pair is confirmed, refuted, or joined already."""
    root = {c: c for c in component}

    def find(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    signs = np.stack(signature)
    numbers = {c: k for k, c in enumerate(root)}
    own = np.array([numbers[c] for c in component])
    low, links = least_estimate(percent / 100), []
    for i in range(1, len(classes)):
        others = np.flatnonzero(own[:i] != own[i])
        if not len(others):
            continue
        found = estimates(signs[i], signs[others])
        near = np.flatnonzero(found >= low)
        for j in others[near[np.argsort(-found[near])]].tolist():
            a, b = find(component[i]), find(component[j])
            if a != b and linked(shingles[i], shingles[j], percent):
                root[a] = b
                links.append((classes[i], classes[j]))
    return links


def near_groups(docs: DataFrame, percent: int = 85, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each document; component_id is the smallest doc_id reachable by links."""
    ids = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"))
    found = _groups(ids, percent, words, BROADCAST_ROWS)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )


def _groups(ids: DataFrame, percent: int, words: int, few_rows: int) -> DataFrame:
    """(id, n_shingles, component) of (id, text) rows; ids of any type with an order, the smallest one names a component.

    Every side that comes from an aggregate is landed before it is joined: with bare shuffles on both sides adaptive
    execution splits a digest or a band key that very many rows have.
    """
    signed = land(ids.select("id", signature_column("text", words).alias("s")).select("id", "s.*"), "signatures")
    classes = land(
        signed.where("n > 0 AND id IS NOT NULL").groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("bands").alias("bands")),
        "classes", 4 * signed.count(),  # a row has 600 bytes
    )
    of_classes = classes.count()
    entries = classes.select("digest", F.explode("bands").alias("key"))
    several = land(entries.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "several", of_classes * BANDS // 2)
    in_buckets = several.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = land(entries.join(several, "key"), "buckets", in_buckets)

    # The classes in buckets, with signature and full set.
    inside = buckets.select("digest").distinct()
    wanted = land(classes.join(inside, "digest", "left_semi").select("first_id", "digest", "n", "signature"), "wanted", of_classes)
    of_wanted, in_sets = wanted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    few = of_wanted <= few_rows
    chosen = wanted.select(F.col("first_id").alias("id"), "digest")
    texts = ids.join(F.broadcast(chosen.select("id")) if few else chosen.select("id"), "id", "left_semi")
    sets = texts.select("id", set_column("text", words).alias("s")).select("id", "s.*")
    sets = sets.join(chosen, ["id", "digest"]).groupBy("digest").agg(F.first("shingles").alias("shingles"))
    full = land(wanted.select("digest", "signature").join(sets, "digest"), "sets", max(of_wanted, in_sets // 100))  # 16 MB a file

    # Every class against the smallest and the largest of each of its buckets.
    ends = land(buckets.groupBy("key").agg(F.min("digest").alias("low"), F.max("digest").alias("high")), "ends", in_buckets // 2)
    pairs = buckets.join(ends, "key").select(F.explode(F.array("low", "high")).alias("a"), F.col("digest").alias("b"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    signs = full.select("digest", "signature")
    near = (
        pairs.join(signs.toDF("a", "x"), "a").join(signs.toDF("b", "y"), "b")
        .where(_estimate_column("x", "y") >= least_estimate(percent / 100)).select("a", "b")
    )
    hashes = full.select("digest", "shingles")
    few_files = files_for(ids.sparkSession, of_classes)
    links = land(
        near.join(hashes.toDF("a", "x"), "a").join(hashes.toDF("b", "y"), "b")
        .where(_linked_column("x", "y", percent)).select("a", "b").repartition(few_files),
        "links",
    )

    # Buckets with several components left, in full.
    joined = components(links)
    labelled = land(
        buckets.join(joined.withColumnRenamed("node", "digest"), "digest", "left")
        .select("key", "size", "digest", F.coalesce("component", "digest").alias("component")),
        "labelled", in_buckets,
    )
    left = (
        labelled.groupBy("key").agg(F.min("component").alias("one"), F.max("component").alias("other"), F.max("size").alias("size"),
                                    F.bit_xor(F.xxhash64("digest")).alias("members"))
        .where("one <> other AND size > 3").groupBy("members", "size").agg(F.min("key").alias("key")).select("key")
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (
        labelled.join(left, "key", "left_semi").withColumn("block", F.pmod(F.xxhash64("digest"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "digest", "component")
        .join(full, "digest")
    )

    def search(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("digest").combine_chunks()
        sets_ = _bytes(rows["shingles"], np.uint64)
        found = bucket_links(rows["digest"].to_pylist(), rows["component"].to_pylist(), _bytes(rows["signature"], np.uint8), sets_, percent)
        give_back()
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([y for _, y in found], pa.binary())})

    more = land(dealt.groupBy("key", "i", "j").applyInArrow(search, "a binary, b binary").repartition(few_files), "more-links")
    joined = components(links.unionByName(more))

    names = joined.join(classes.select(F.col("digest").alias("node"), "first_id"), "node")
    smallest = names.groupBy("component").agg(F.min("first_id").alias("component_id"))
    reach = names.join(smallest, "component").select(F.col("node").alias("digest"), "component_id")
    of_class = classes.select("digest", "first_id").join(reach, "digest", "left").select("digest", F.coalesce("component_id", "first_id").alias("component_id"))
    several = signed.select("id", F.col("n").alias("n_shingles"), "digest").join(land(of_class, "of-class", of_classes), "digest", "left")
    return several.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component"))


def drop_near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without all of a group but the one with its smallest doc_id, with all their columns.

    Groups are of rows, known by place and the hash of the file's path: of rows with equal doc_ids one in a group stays, and one that is linked
    with nothing stays whatever its id is. Rows without a doc_id go first where another one of the group has one. The
    places to drop are broadcast if they are few, otherwise joined.
    """
    place = [free_name(docs.columns, FILE), free_name(docs.columns, ROW)]
    whole = located(docs, *place).withColumn(place[0], F.xxhash64(place[0]))  # numbers travel, not paths
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").cast("long").alias("doc_id"), *[F.col(p).alias(n) for p, n in zip(place, ("file", "row"))])
    groups = _groups(whole.select(row.alias("id"), "text"), percent, WORDS, PLACES)
    dropped = groups.where("id <> component").select(F.col("id.file").alias(place[0]), F.col("id.row").alias(place[1]))
    return without_rows(whole, land(dropped, "dropped", whole.count()), place, docs.columns, BROADCAST_ROWS)
