"""Packing of documents into sequences: best fit, then a local search by swaps.

Documents longer than a sequence are cut into full pieces and a last one. Full pieces are sequences of their own. All other
pieces are dealt out by a hash into shards of about `SHARD` pieces, each packed by one task. In a shard, best-fit
decreasing gives a first packing. The search then takes the emptiest bins as donors. Every other underfull bin exchanges
none, one or two of its pieces for one or two larger ones of the donors (moves, one for one, one for two, two for one),
if that brings it closest to full. Each exchange raises the sum of squared fills, and the donors' rest is packed again
into fewer bins. A round that saves no bin is undone, and the next share of `DONORS` is tried; the search ends at the
lower bound, or when no share saves a bin. The underfull bins of all shards are then dealt out anew, whole, and
searched once more.

Defined results: a null or empty text is a piece of its end id alone; repeated rows are packed each; an empty table
gives no rows; ties go to the smaller piece number. Offsets in a sequence are gapless.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assetweave.llm.bpe import encode_column
from assetweave.llm.scratch import land
from assetweave.llm.streams import give_back

SHARD = 50_000
DONORS = (0.03, 0.1, 0.01, 0.3)  # shares of the underfull bins that give their pieces away in a round


class Pool:
    """Pieces by length, with bit sets to find the largest piece, or pair of pieces, that fits."""

    def __init__(self, capacity: int):
        self.capacity, self.bits, self.mirror, self.ids = capacity, 0, 0, defaultdict(list)

    def put(self, length: int, piece: int) -> None:
        if not self.ids[length]:
            self.bits |= 1 << length
            self.mirror |= 1 << (self.capacity - length)
        self.ids[length].append(piece)

    def take(self, length: int) -> int:
        piece = self.ids[length].pop()
        if not self.ids[length]:
            self.bits ^= 1 << length
            self.mirror ^= 1 << (self.capacity - length)
        return piece

    def largest(self, most: int) -> int:
        """The largest length up to `most`, 0 if there is none."""
        return max(0, (self.bits & ((2 << most) - 1)).bit_length() - 1) if most > 0 else 0

    def pair(self, total: int) -> tuple[int, int] | None:
        """Two lengths that add up to `total`."""
        shift = self.capacity - total
        both = self.bits & (self.mirror >> shift if shift >= 0 else self.mirror << -shift)
        while both:
            one = both.bit_length() - 1
            other = total - one
            if other > 0 and (one != other or len(self.ids[one]) > 1):
                return one, other
            both ^= 1 << one
        return None


def best_fit(lengths: list[int], pieces: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes to the fullest bin that still has room for it."""
    open_bins, rooms, bins = defaultdict(list), 0, []
    for length, piece in sorted(zip(lengths, pieces), key=lambda x: (-x[0], x[1])):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(bins)
            bins.append([])
        bins[at].append(piece)
        if rest := room - length:
            open_bins[rest].append(at)
            rooms |= 1 << rest
    return bins


def improve(pool: Pool, bin_: list[int], length: np.ndarray, room: int) -> int:
    """Exchange pieces of one bin for larger ones of the pool, as long as that fills it further; its new room."""
    while room:
        sizes = sorted({(int(length[p]), p) for p in bin_})
        by_size = dict((s, p) for s, p in reversed(sizes))
        singles = list(by_size)
        pairs = {a + b: (a, b) for i, a in enumerate(singles) for b in singles[i + 1:]}  # only their sum counts
        outs = [()] + [(s,) for s in singles] + list(pairs.values())
        best = (0, (), ())
        for out in outs:
            given = sum(out)
            target = given + room
            one = pool.largest(min(target, pool.capacity))
            if one > given and one - given > best[0]:
                best = (one - given, out, (one,))
            if best[0] < room and len(out) < 2 and (two := pool.pair(target)):
                best = (room, out, two)
            if best[0] == room:
                break
        gain, out, into = best
        if not gain:
            break
        for size in out:
            piece = by_size[size]
            bin_.remove(piece)
            pool.put(size, piece)
        bin_.extend(pool.take(size) for size in into)
        room -= gain
    return room


def pack_lengths(length: np.ndarray, capacity: int, bins: list[list[int]] | None = None) -> list[list[int]]:
    """Bins of piece numbers, each of at most `capacity` in total; the search starts from `bins` if they are given."""
    bins = best_fit(length.tolist(), list(range(len(length))), capacity) if bins is None else bins
    least = -(-int(length.sum()) // capacity)
    tried = 0
    while len(bins) > least and tried < len(DONORS):
        fewer = exchanged(bins, length, capacity, len(bins) - least if tried == 0 else 2, DONORS[tried])
        bins, tried = (fewer, 0) if len(fewer) < len(bins) else (bins, tried + 1)
    return bins


def exchanged(bins: list[list[int]], length: np.ndarray, capacity: int, fewest: int, share: float) -> list[list[int]]:
    """The bins after one round of exchanges with a share of the underfull ones, at least `fewest`."""
    rooms = np.array([capacity - int(length[b].sum()) for b in bins])
    order = np.argsort(-rooms, kind="stable")
    under = order[rooms[order] > 0]
    count = max(2, int(len(under) * share), fewest)
    donors = set(under[:count].tolist())
    bins, pool = [list(b) for b in bins], Pool(capacity)
    for d in sorted(donors):
        for piece in bins[d]:
            pool.put(int(length[piece]), piece)
    for b in under[count:][::-1].tolist():
        improve(pool, bins[b], length, int(rooms[b]))
    rest = [p for size in sorted(pool.ids) for p in pool.ids[size]]
    return [b for i, b in enumerate(bins) if i not in donors] + best_fit(length[rest].tolist(), rest, capacity)


def pack(pieces: DataFrame, capacity: int, length: str = "length", shard: int = SHARD) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces of at most `capacity`; other columns are kept.

    The pieces are landed first: they are counted, and dealt out by their place in the landed files, so that repeated
    rows spread like any others.
    """
    pieces = land(pieces, "pieces")
    schema = pieces.schema
    place = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    short = pieces.where(F.col(length) < capacity)
    shards = max(1, -(-short.count() // shard))

    def packed_by(first_shard: int, again: bool):
        def one(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("_place")
            lengths = rows[length].to_numpy().astype(np.int64)
            start = None
            if again:
                order = np.argsort(rows["sequence_id"].to_numpy(), kind="stable")
                turns = np.flatnonzero(np.diff(rows["sequence_id"].to_numpy()[order])) + 1
                start = [b.tolist() for b in np.split(order, turns)]
            sequence, offset, room = (np.zeros(len(rows), np.int64) for _ in range(3))
            for number, bin_ in enumerate(pack_lengths(lengths, capacity, start)):
                sequence[bin_] = number
                offset[bin_] = np.cumsum(lengths[bin_]) - lengths[bin_]
                room[bin_] = capacity - lengths[bin_].sum()
            sequence += (rows["_shard"].to_numpy().astype(np.int64) + first_shard) << 32
            out = rows.select([*schema.names, "_place"])
            for name, values in (("_room", room), ("sequence_id", sequence), ("offset", offset)):
                out = out.append_column(name, pa.array(values))
            give_back()
            return out

        return one

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    names += ", _place long, _room long, sequence_id long, offset long"
    dealt = short.withColumn("_place", place).withColumn("_shard", F.pmod("_place", F.lit(shards)))
    packed = dealt.groupBy("_shard").applyInArrow(packed_by(0, False), names)
    if shards > 1:
        packed = land(packed, "packed")
        under = packed.where("_room > 0")
        anew = max(1, -(-under.count() // shard))
        under = under.drop("_room", "offset").withColumn("_shard", F.pmod(F.xxhash64("sequence_id"), F.lit(anew)))
        again = under.groupBy("_shard").applyInArrow(packed_by(shards, True), names)
        packed = packed.where("_room = 0").unionByName(again)
    packed = packed.drop("_place", "_room")
    full = pieces.where(F.col(length) >= capacity)
    alone = full.withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    return packed.unionByName(alone)


PIECE = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"


def cut(ids: pa.ListArray, capacity: int) -> pa.Array:
    """The pieces of lists of ids: none longer than `capacity`, all but the last of that length; with their crc32."""
    data = memoryview(np.ascontiguousarray(ids.flatten().to_numpy(zero_copy_only=False), "<i4")).cast("B")
    at, rows = 0, []
    for size in ids.value_lengths().fill_null(0).to_pylist():
        starts = range(0, size, capacity)
        ends = [min(size, s + capacity) for s in starts]
        rows.append([
            {"piece": k, "start": s, "length": e - s, "ids_crc32": zlib.crc32(data[4 * (at + s):4 * (at + e)])}
            for k, (s, e) in enumerate(zip(starts, ends))
        ])
        at += size
    return pa.array(rows, PIECE_TYPE)


PIECE_TYPE = pa.list_(pa.struct([
    ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
]))


def pack_documents(docs: DataFrame, tokenizer: str, end: int, capacity: int, shard: int = SHARD) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece of each document's ids."""
    pieces = encode_column(docs.sparkSession, docs["text"], tokenizer, end, lambda ids: cut(ids, capacity), PIECE)
    return pack(docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.inline(pieces)), capacity, shard=shard)
