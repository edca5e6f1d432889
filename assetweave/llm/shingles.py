"""Sets of five-word shingles, as sorted 64-bit hashes, for whole Arrow batches of texts.

Words are runs of characters other than space and tab to carriage return, with A-Z in lower case. A text with fewer words
than a shingle has one shingle of all its words; a text without words, or null, has none. Words are hashed in blocks of
bytes cut at blanks, so that a very long text needs memory for its words' hashes only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from assetweave.llm.spans import hash_spans, mix

WORDS = 5
BLOCK = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a byte block."""
    blank = np.flatnonzero(_BLANK[data])
    hashes, starts, begin = [], [], 0
    while begin < len(data):
        # Up to the last blank within a block; if there is none, up to the next one.
        cut = int(np.searchsorted(blank, begin + BLOCK))
        if len(data) - begin <= BLOCK:
            end = len(data)
        elif cut and blank[cut - 1] > begin:
            end = int(blank[cut - 1])
        else:
            end = int(blank[cut]) if cut < len(blank) else len(data)
        part = _LOWER[data[begin:end]]
        inside = np.concatenate([[False], ~_BLANK[part], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        hashes.append(hash_spans(part, first, last))
        starts.append(first + begin)
        begin = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_hashes(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text's word hashes."""
    if not len(words):
        return np.zeros(0, np.uint64)
    count = min(size, len(words))
    total = np.full(len(words) - count + 1, count, np.uint64)
    for k in range(count):
        total = mix(total * _STEP + words[k:len(words) - count + 1 + k])
    return np.unique(total)


def text_words(texts: pa.Array, most: int = 4 * BLOCK) -> list[np.ndarray]:
    """Word hashes of each text; texts are joined into blocks of about `most` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    out, row = [], 0
    ends = np.cumsum(sizes + 1)
    while row < len(texts):
        base = int(ends[row - 1]) if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, base + most)))
        joined = " ".join(t.as_py() or "" for t in texts.slice(row, stop - row)).encode()
        hashes, starts = word_hashes(np.frombuffer(joined, np.uint8))
        bounds = np.searchsorted(starts, ends[row:stop] - base)
        out.extend(np.split(hashes, bounds[:-1]) if stop - row > 1 else [hashes])
        row = stop
    return out


def shingle_sets(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    return [shingle_hashes(w, size) for w in text_words(texts)]
