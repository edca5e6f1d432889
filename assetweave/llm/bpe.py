"""BPE encoding and decoding with a deterministic automaton over token arcs.

The merges are compiled once, in their order, by merge gadgets. The automaton starts with one state that loops on
every base symbol. The gadget of a merge (a, b) -> ab takes the state q that a leads to, gives a a copy of q without
the arc b, and adds an arc ab, to the state b led to, wherever an arc a exists. After all merges a path spells a word
if and only if it is the tokenization of that word, so each prefix of a word is reached by exactly one path. Encoding
a word walks the tables from left to right; decoding emits the labels of the arcs.

The tables grow with the vocabulary alone. They are compiled on the driver and broadcast (about 20 MB for 49,000
tokens). Text is split first, as the vocabulary file says, a block of bytes at a time; words already met are looked up in
a table of bounded size in each Python worker, all others walk the automaton together.

Defined results: null text is an empty one, and has no ids; null ids decode to an empty text; ids that are not in the
vocabulary are left out by decoding, as the tokenizers library does. Rows are never dropped; other columns stay as they are,
and a column named like the output is replaced.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from tokenizers import Tokenizer

from assetweave.llm.spans import HashTable, hash_spans
from assetweave.llm.streams import Arrays, arrow_stream

CACHED_WORDS = 500_000
BLOCK = 1 << 18
LONG_WORD = 64
SYMBOLS = 512  # a byte, and the same byte at the end of a word
ROOT = 0

# Characters for which Python lowers, composes and splits as the vocabulary file asks; other texts take the library's
# own normalizer and splitter.
PLAIN = re.compile(r"[^\t-\r -~¡-į]")


def byte_symbols() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others in
    order for the characters from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = sorted(set(range(256)) - set(printable))
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Automaton:
    """Tables of one vocabulary file: the symbol trie of the tokens, the arcs, and the labels."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # The library's normalizer and splitter without its model, which the tables replace.
        self.path, self.bare = path, json.dumps(spec | {"model": spec["model"] | {"vocab": {}, "merges": []}, "added_tokens": []})
        self.encoder: Encoder | None = None  # of a Python worker
        model, self.specials = spec["model"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.labels = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        self._trie(vocab)
        self._arcs(len(vocab), [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges])

    def _trie(self, vocab: dict[str, int]) -> None:
        byte_of, nodes = byte_symbols(), {}
        size = max(vocab.values()) + 1
        self.length = np.zeros(size, np.int32)
        tokens = {}
        for text, token in vocab.items():
            ends = bool(self.suffix) and text.endswith(self.suffix)
            symbols = [byte_of[c] for c in (text[: -len(self.suffix)] if ends else text)]
            symbols[-1] += 256 * ends
            node = ROOT
            for symbol in symbols:
                node = nodes.setdefault(node * SYMBOLS + symbol, len(nodes) + 1)
            tokens[node], self.length[token] = token, len(symbols)
        self.keys = np.array(sorted(nodes), np.int64)
        self.next = np.array([nodes[k] for k in self.keys.tolist()], np.int32)
        self.row, self.jump = self._displaced(self.keys, self.next, len(nodes) + 1)
        self.token = np.full(len(nodes) + 1, -1, np.int32)
        self.token[list(tokens)] = list(tokens.values())

    @staticmethod
    def _displaced(keys: np.ndarray, following: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """The trie as one table: the step of a node by a symbol is at row[node] + symbol, with its node for a check."""
        row, jump = np.zeros(nodes, np.int32), np.full((SYMBOLS * 8, 2), -1, np.int32)
        node, symbol = keys // SYMBOLS, keys % SYMBOLS
        begins = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        groups = sorted(zip(begins, np.append(begins[1:], len(keys)), strict=True), key=lambda g: g[0] - g[1])
        free, low = np.ones(len(jump), bool), 0
        for begin, end in groups:
            wanted = symbol[begin:end]
            while True:
                if len(free) < low + 3 * SYMBOLS:
                    jump = np.concatenate([jump, np.full_like(jump, -1)])
                    free = np.append(free, np.ones_like(free))
                fits = free[low + wanted[0]:len(free) - SYMBOLS + wanted[0]].copy()
                for s in wanted[1:]:
                    fits &= free[low + s:len(free) - SYMBOLS + s]
                at = int(fits.argmax())
                if len(fits) and fits[at]:
                    break
                jump = np.concatenate([jump, np.full_like(jump, -1)])
                free = np.append(free, np.ones_like(free))
            row[node[begin]] = low + at
            jump[low + at + wanted, 0], jump[low + at + wanted, 1] = node[begin], following[begin:end]
            free[low + at + wanted] = False
            low = max(low, int(free.argmax()) - SYMBOLS)
        row[np.setdiff1d(np.arange(nodes), node)] = 0
        return row, jump

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The nodes after a symbol, -1 where the trie has none."""
        found = self.jump[self.row[node] + symbol]
        return np.where(found[:, 0] == node, found[:, 1], -1)

    def _arcs(self, size: int, merges: list[tuple[int, int, int]]) -> None:
        """`without` has a row of bits for each state: the tokens it has no arc for."""
        leads, users, states = np.zeros(size, np.int32), [size - len(merges)], 1
        without = np.zeros((256, (size + 7) // 8), np.uint8)
        sign = np.zeros(size, np.uint64)  # of the set of states without the arc, to find equal sets
        marks = np.random.default_rng(0).integers(1, 2**63, len(merges) + 1, dtype=np.uint64)
        for a, b, ab in merges:
            q, after = leads[a], leads[b]
            if without[q, b >> 3] >> (b & 7) & 1:
                raise ValueError("a merge can never be used; this vocabulary has no such automaton")
            if users[q] == 1 and a != b:
                copy = q  # nothing else leads to q
            else:
                copy, states = states, states + 1
                if states > len(without):
                    without = np.concatenate([without, np.zeros_like(without)])
                without[copy] = without[q]
                sign ^= np.unpackbits(without[q], bitorder="little")[:size] * marks[copy]
                users[q] -= 1
                users.append(1)
                leads[a] = copy
            without[copy, b >> 3] |= 1 << (b & 7)
            sign[b] ^= marks[copy]
            leads[ab] = after
            users[after] += 1
            without[:states, ab >> 3] |= (without[:states, a >> 3] >> (a & 7) & 1) << (ab & 7)
            sign[ab] = sign[a]
        # Tokens that the same states have no arc for share a column.
        _, first, self.column = np.unique(sign, return_index=True, return_inverse=True)
        self.column, self.leads = self.column.astype(np.int32), leads
        rows = [np.packbits(np.unpackbits(w, bitorder="little")[first], bitorder="little") for w in without[:states]]
        self.width = len(rows[0])
        self.without = np.concatenate(rows)


@functools.lru_cache(maxsize=4)
def compile_automaton(path: str) -> Automaton:
    return Automaton(path)


def _classes() -> np.ndarray:
    """Blank, letter, number or other, for the characters below U+0130."""
    kinds = ((regex.compile(r"\s"), BLANK), (regex.compile(r"\p{L}"), LETTER), (regex.compile(r"\p{N}"), NUMBER))
    return np.array([next((k for p, k in kinds if p.match(chr(c))), OTHER) for c in range(0x130)], np.uint8)


BLANK, LETTER, NUMBER, OTHER = range(4)
CLASSES = _classes()
SHORT = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")  # after an apostrophe: fixed by the vocabulary file
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def plain_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block of lower-case UTF-8 without characters beyond U+012F, as SPLIT finds
    them. The block has to end with a blank or a zero byte; zero bytes count as blanks."""
    kind = CLASSES[data]
    lead = np.flatnonzero(data >= 0xC0)
    kind[lead] = kind[lead + 1] = CLASSES[(data[lead].astype(np.int32) & 0x1F) << 6 | data[lead + 1] & 0x3F]
    kind[data == 0] = BLANK
    before = np.empty_like(kind)
    before[0], before[1:] = BLANK, kind[:-1]
    first = (kind != before) | (kind == NUMBER) & (data & 0xC0 != 0x80)
    quotes = np.flatnonzero((data == ord("'")) & (before != OTHER))
    quotes = quotes[kind[quotes + 1] == LETTER]
    if len(quotes):
        one, two = data[quotes + 1], data[np.minimum(quotes + 2, len(data) - 1)]
        size = np.zeros(len(quotes), np.int64)
        for text in SHORT:
            size[(one == text[0]) & ((two == text[-1]) | (len(text) == 1))] = len(text)
        quotes, size = quotes[size > 0], size[size > 0]
        first[quotes + 1] = False
        first[quotes + 1 + size] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(data))
    word = kind[starts] != BLANK
    return starts[word], ends[word]


class Encoder:
    """Encodes texts with an automaton; one for each Python worker.

    Words are found, hashed and looked up for whole blocks of bytes; only words that are not in the table walk the
    automaton. The table is emptied when it holds `CACHED_WORDS` words.
    """

    def __init__(self, automaton: Automaton):
        self.a = automaton
        library = Tokenizer.from_str(automaton.bare)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.special = regex.compile("(" + "|".join(map(regex.escape, automaton.specials)) + ")") if automaton.specials else None
        self.byte_of = byte_symbols()
        self.goto: dict[int, int] | None = None
        self.table = HashTable()
        self.at, self.count, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the place where each text begins, with the end of the last."""
        plain = [self.a.pattern == SPLIT and bool(t) and not PLAIN.search(t) and not self._marked(t) for t in texts]
        joined = "\0".join([t for t, p in zip(texts, plain, strict=True) if p])
        ids, bounds = self._block(joined) if any(plain) else (np.zeros(0, np.uint32), [0])
        parts, sizes, k = [], [], 0
        for text, is_plain in zip(texts, plain, strict=True):
            part = ids[bounds[k]:bounds[k + 1]] if is_plain else self._other(text) if text else ids[:0]
            k += is_plain
            parts.append(part)
            sizes.append(len(part))
        return (ids if all(plain) else np.concatenate([ids[:0], *parts])), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def _marked(self, text: str) -> bool:
        return self.special is not None and "<" in text and self.special.search(text) is not None

    def _block(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(joined.lower().encode() + b"\0", np.uint8)
        blank = np.flatnonzero(data <= ord(" "))
        parts, marks, done, start = [], [0], 0, 0
        while start < len(data):
            cut = np.searchsorted(blank, start + BLOCK)
            stop = int(blank[min(max(cut - 1, np.searchsorted(blank, start)), len(blank) - 1)]) + 1
            piece = data[start:stop]
            ids, starts, total = self._piece(piece)
            parts.append(ids)
            zeros = np.flatnonzero(piece == 0)
            marks.extend((done + total[np.searchsorted(starts, zeros)]).tolist())
            done, start = done + len(ids), stop
        return np.concatenate(parts), np.array(marks)

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a block of words; the words' starts; the number of ids before each word."""
        starts, ends = plain_words(data)
        place = self._places(data, starts, ends)
        count = self.count[place]
        total = np.zeros(len(place) + 1, np.int64)
        np.cumsum(count, out=total[1:])
        return self.ids[np.repeat(self.at[place] - total[:-1], count) + np.arange(total[-1])], starts, total

    def _places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = hash_spans(data, starts, ends)
        place = self.table.find(hashes)
        if (place < 0).any() and self.table.count > CACHED_WORDS:
            self.table.clear()
            self.at, self.count, self.ids = self.at[:0], self.count[:0], self.ids[:0]
            place[:] = -1
        missing = np.flatnonzero(place < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            s, e = starts[missing[first]], ends[missing[first]]
            ids, bounds = self._walk_spans(data, s, e)
            places = (len(self.at) + np.arange(len(new))).astype(np.int32)
            self.at = np.concatenate([self.at, (bounds[:-1] + len(self.ids)).astype(np.int32)])
            self.count = np.concatenate([self.count, np.diff(bounds).astype(np.int32)])
            self.ids = np.concatenate([self.ids, ids])
            self.table.add(new, places)
            place[missing] = places[np.searchsorted(new, hashes[missing])]
        return place

    def _other(self, text: str) -> np.ndarray:
        """A text with special tokens, or with characters that need the library's normalizer and splitter."""
        out = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.a.specials:
                out.append(np.array([self.a.specials[part]], np.uint32))
            elif part:
                found = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part))
                words = [bytes(map(self.byte_of.__getitem__, w)) for w, _ in found]
                if words:
                    ends = np.cumsum([len(w) for w in words])
                    out.append(self._walk_spans(np.frombuffer(b"".join(words), np.uint8), np.append(0, ends[:-1]), ends)[0])
        return np.concatenate([np.zeros(0, np.uint32), *out])

    def _walk_spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words data[start:end], and where the ids of each word begin, with the end of the last."""
        sizes = ends - starts
        short = np.flatnonzero(sizes <= LONG_WORD)
        long = {int(i): self._walk(data[starts[i]:ends[i]]) for i in np.flatnonzero(sizes > LONG_WORD)}
        ids, count = self._walk_all(data, starts[short], sizes[short])
        if not long:
            return ids, np.append(0, np.cumsum(count))
        counts = np.zeros(len(starts), np.int64)
        counts[short] = count
        counts[list(long)] = [len(x) for x in long.values()]
        bounds = np.append(0, np.cumsum(counts))
        out = np.zeros(bounds[-1], np.uint32)
        where = np.repeat(np.isin(np.arange(len(starts)), short), counts)
        out[where] = ids
        for i, found in long.items():
            out[bounds[i]:bounds[i + 1]] = found
        return out, bounds

    def _walk_all(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many short words, one table step for all of them at a time; and the number of each word's."""
        a, words = self.a, len(starts)
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        at = np.cumsum(sizes) - sizes
        symbols = data[np.repeat(starts - at, sizes) + np.arange(int(sizes.sum()))].astype(np.int32)
        if a.suffix:
            symbols[at + sizes - 1] += 256
        base = at + np.arange(words)  # a word has one place more than symbols
        state = np.zeros(len(symbols) + words, np.int64)
        arc = np.full(len(state), -1, np.int32)
        for start in range(int(sizes.max())):
            word = np.flatnonzero(sizes > start)
            node, end = np.zeros(len(word), np.int64), start
            while len(word):
                node, end = a.step(node, symbols[at[word] + end]), end + 1
                on = node >= 0
                word, node = word[on], node[on]
                token = a.token[node]
                whole = np.flatnonzero(token >= 0)
                w, t = word[whole], token[whole]
                column = a.column[t]
                taken = a.without[state[base[w] + start] * a.width + (column >> 3)] >> (column & 7) & 1 == 0
                w, t = w[taken], t[taken]
                state[base[w] + end], arc[base[w] + end] = a.leads[t], t
                more = sizes[word] > end
                word, node = word[more], node[more]
        # Back from the end of each word; its last id comes first.
        left, places, steps, count = sizes.copy(), [], [], np.zeros(words, np.int64)
        word = np.arange(words)
        while len(word):
            token = arc[base[word] + left[word]]
            places.append(word)
            steps.append(token)
            count[word] += 1
            left[word] -= a.length[token]
            word = word[left[word] > 0]
        ends = np.cumsum(count)
        ids = np.zeros(int(ends[-1]), np.uint32)
        for k, (word, token) in enumerate(zip(places, steps, strict=True)):
            ids[ends[word] - 1 - k] = token
        return ids, count

    def _walk(self, word: np.ndarray) -> np.ndarray:
        """The ids of one long word."""
        a = self.a
        if self.goto is None:
            self.goto = dict(zip(a.keys.tolist(), a.next.tolist(), strict=True))
        symbols = word.tolist()
        symbols[-1] += 256 * bool(a.suffix)
        size = len(symbols)
        state, arc = [0] * (size + 1), [-1] * (size + 1)
        for start in range(size):
            node, row = ROOT, state[start] * a.width
            for end in range(start, size):
                node = self.goto.get(node * SYMBOLS + symbols[end])
                if node is None:
                    break
                token = int(a.token[node])
                if token >= 0:
                    column = int(a.column[token])
                    if not a.without[row + (column >> 3)] >> (column & 7) & 1:
                        state[end + 1], arc[end + 1] = int(a.leads[token]), token
        ids = []
        while size:
            ids.append(arc[size])
            size -= int(a.length[arc[size]])
        return np.array(ids[::-1], np.uint32)


def worker_encoder(shared) -> Encoder:
    """The encoder of this Python worker for a broadcast automaton. It lives as long as the automaton, which Spark takes from a
    worker whose next task does not use it."""
    automaton = shared.value
    if automaton.encoder is None:
        automaton.encoder = Encoder(automaton)
    return automaton.encoder


_shared: dict[tuple[str, str], object] = {}


def share(spark: SparkSession, path: str):
    """The automaton of a vocabulary file, broadcast once for each application; its size depends on the file alone."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _shared:
        _shared[key] = spark.sparkContext.broadcast(compile_automaton(path))
    return _shared[key]


def text_blocks(texts: pa.Array, most: int = 1 << 20) -> Iterator[list[str | None]]:
    """The texts of an Arrow batch in blocks of about `most` characters; a longer text is a block of its own."""
    block, size = [], 0
    for text in texts:
        value = text.as_py()
        if block and size + len(value or "") > most:
            yield block
            block, size = [], 0
        block.append(value)
        size += len(value or "")
    if block:
        yield block


def id_lists(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view(np.int32)))


def label_texts(labels: dict[int, str], ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Labels of the arcs of each text, joined by one space as the library does for a file without a decoder."""
    names = list(map(labels.get, ids.tolist()))
    texts = (names[i:j] for i, j in zip(bounds.tolist(), bounds[1:].tolist()))
    return [" ".join(t if None not in t else [x for x in t if x is not None]) for t in texts]


def encode_column(
    spark: SparkSession, text: str | Column, path: str, end: int | None = None,
    made: Callable[[pa.ListArray], pa.Array] = lambda ids: ids, returns: str = "array<int>",
) -> Column:
    """Ids of a text column, as array<int>; with the id `end` at the end of each text if given. Or what `made` makes of lists of
    ids, of the type `returns`: one Python worker for both then."""
    shared = share(spark, path)

    def encode(batches: Arrays) -> Arrays:
        encoder = worker_encoder(shared)
        for batch in batches:
            for block in text_blocks(batch):
                ids, bounds = encoder.encode(block)
                if end is not None:
                    ids, bounds = np.insert(ids, bounds[1:], end), bounds + np.arange(len(bounds))
                yield made(id_lists(ids, bounds))

    return arrow_stream(encode, returns)(text)


def decode_column(spark: SparkSession, ids: str | Column, path: str) -> Column:
    """Texts of the labels of a column of ids."""
    shared = share(spark, path)

    def decode(batches: Arrays) -> Arrays:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                flat = part.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                sizes = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                yield pa.array(label_texts(shared.value.labels, flat, np.append(0, np.cumsum(sizes))), pa.string())

    return arrow_stream(decode, "string")(ids)


def round_trip_column(spark: SparkSession, text: str | Column, path: str) -> Column:
    """struct(ids, decoded): a text's ids, and the text that these ids decode to, in one pass."""
    shared = share(spark, path)

    def both(batches: Arrays) -> Arrays:
        encoder = worker_encoder(shared)
        for batch in batches:
            for block in text_blocks(batch):
                ids, bounds = encoder.encode(block)
                texts = pa.array(label_texts(shared.value.labels, ids, bounds), pa.string())
                yield pa.StructArray.from_arrays([id_lists(ids, bounds), texts], ["ids", "decoded"])

    return arrow_stream(both, "struct<ids:array<int>,decoded:string>")(text)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", end: int | None = None) -> DataFrame:
    return df.withColumn(out, encode_column(df.sparkSession, df[text], path, end))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    return df.withColumn(out, decode_column(df.sparkSession, df[ids], path))
