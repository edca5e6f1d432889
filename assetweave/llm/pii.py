"""Personal data by a semi-Markov conditional random field.

Base spans come from four patterns and always stay. Around every place that looks like data (a run of digits, an at sign, an
address of numbers) a window of atoms (letters, digits, blanks, single signs) is cut into segments by the model: a
segment is one atom of plain text, or a whole entity of at most `MOST_ATOMS` atoms. Features look at whole segments:
shape, digits, check sum, parts, separators, neighbours. The best segmentation of a window comes from dynamic programming over
ends and lengths, which chooses borders and types jointly; a found entity becomes a span if its posterior probability, from
the forward and backward sums, is at least `SURE` and no base span overlaps it.

The model is fitted on the driver by maximum likelihood, on at most `MOST_WINDOWS` windows with a base span and as many
without one, from the documents with the smallest hashes of their doc_id. Base spans give the types; in
half of the windows the entity is written in another way first (without country code, other separators, `at` and `dot`
spelled out), so the model learns entities the patterns miss.

Defined results: a null or empty text has no spans; repeated rows are searched each; very long texts cost windows only
where something looks like data, and time in proportion to their length; of equally good segmentations one that ends in plain
text is taken, else the shorter entity, else the kind that is listed first; an empty table gives no rows. Other columns,
whatever their names, are kept out.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from assetweave.llm.streams import arrow_stream

# Kinds in their order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")  # possessive: a run of digits is gone through once
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

MOST_WINDOWS = 300
MOST_ATOMS, MOST_CHARS, MARGIN = 24, 64, 24
SURE = 0.75
EPOCHS, RATE = 6, 0.3
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|[^\S\n]+|.", re.S)
_TRIGGER = re.compile(r"@|[0-9][0-9 ().+-]{5,}[0-9]|[0-9]+\.[0-9]+\.[0-9]+|(?i:[([{ ]at[)\]} ][^\s([{]++\s?[([{ ]dot)")
_ANY = re.compile(r"[0-9@]|(?i:[([{ ]dot)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start. Each kind in one pass over the text."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for run in _DOTTED.finditer(text):
        parts, place = run.group().split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[k:k + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[k:k + 4]):
                out.append(("ip", place, place + size))
            place += size + 1
    for found in _CARD.finditer(text):
        digits = _digits(found.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", found.start(), found.end()))
    for found in _PHONE.finditer(text):
        if 8 <= len(_digits(found.group())) <= 15:
            out.append(("phone", found.start(), found.end()))
    return out


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Parts of a text around everything that looks like data, with a margin, apart from each other."""
    start = end = -1
    for found in _TRIGGER.finditer(text):
        low, high = max(0, found.start() - MARGIN), min(len(text), found.end() + MARGIN)
        if low > end >= 0:
            yield start, end
            start = low
        elif end < 0:
            start = low
        end = high
    if end >= 0:
        yield start, end


def _code(atom: str) -> str:
    c = atom[0]
    return f"d{min(len(atom), 9)}" if "0" <= c <= "9" else "w" if c.isalpha() else "_" if c.isspace() else c


# What the features of a segment are made of, in their order.
Key = tuple[int, str, bool, bool, bool, bool, bool, bool, bool, int, str, bool, str, bool, bool, bool]
_NAMES = ("digits", "signs", "luhn", "card", "ip", "at", "mail", "spelled", "words", "groups", "tail", "phone", "first", "joins", "goes on", "balanced")


def feature_names(key: Key) -> list[str]:
    return [f"{name}={value}" for name, value in zip(_NAMES, key, strict=True)]


class Atoms:
    """A window as atoms: letters, digits, blanks, single signs."""

    def __init__(self, text: str):
        self.text = text
        self.atoms = _ATOM.findall(text)
        self.bounds = [0]
        for atom in self.atoms:
            self.bounds.append(self.bounds[-1] + len(atom))
        self.codes = [_code(a) for a in self.atoms]
        self.may_say_at = "@" in text or "at" in text.lower()

    def into(self, j: int) -> Iterator[tuple[int, Key]]:
        """(first atom, key) of every segment that ends with atom j - 1 and may be an entity: it begins with no blank, ends with a
        letter or digit, is on one line, and has an at, seven digits or three dots. All features grow with the segment."""
        text, bounds, atoms = self.text, self.bounds, self.atoms
        end = bounds[j]
        if not text[end - 1].isalnum():
            return
        after = text[end:end + 1]
        goes_on = after.isalnum() or after == "@"
        digits = check = groups = dots = opened = 0
        words = at_word = dot_word = at_sign = space = False
        signs: set[str] = set()
        sorted_signs = tail = ""
        for i in range(j - 1, max(0, j - MOST_ATOMS) - 1, -1):
            start, atom = bounds[i], atoms[i]
            if end - start > MOST_CHARS or atom == "\n":
                return
            c = atom[0]
            blank = False
            if "0" <= c <= "9":
                groups += 1
                for d in reversed(atom):  # the sum counts from the right, so digits before change none of it
                    n = ord(d) - 48
                    check += n if digits % 2 == 0 else n * 2 - 9 * (n > 4)
                    digits += 1
            elif "a" <= c <= "z" or "A" <= c <= "Z":
                words = True
                low = atom.lower() if len(atom) < 4 else ""
                at_word, dot_word = at_word or low == "at", dot_word or low == "dot"
            elif not c.isalnum():
                blank = c.isspace()
                if not signs.issuperset(atom):
                    signs.update(atom)
                    sorted_signs = "".join(sorted(signs))
                dots += c == "."
                opened += (c == "(") - (c == ")")
                at_sign, space = at_sign or c == "@", space or " " in atom
            if len(tail) < 5:
                tail = self.codes[i] + tail
            if blank:
                continue
            if not (7 <= digits <= 20 or digits >= 4 and dots == 3 or at_sign or self.may_say_at and self._says_at(start, end)):
                continue
            luhn_, at = digits >= 13 and check % 10 == 0, at_sign or at_word
            before = text[start - 1:start]
            yield i, (
                min(digits, 20), sorted_signs, luhn_, 16 <= digits <= 19 and luhn_ and not words, dots == 3 and _is_ip(text[start:end]), at,
                at and (dots > 0 or dot_word) and not space, at and dot_word, words, groups, "w" if words else tail[-5:],
                not words and 8 <= digits <= 15 and groups > 2, "d1" if "0" <= c <= "9" else _code(c),
                before.isalnum() or before in (".", "-", "@"), goes_on, opened == 0,
            )

    def _says_at(self, start: int, end: int) -> bool:
        low = self.text[start:end].lower()
        return " at " in low or "at]" in low or "at)" in low


def _is_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)


@dataclass
class Lattice:
    """The segments of a window: (first atom, end atom, type, features); type 0 is plain text."""

    bounds: list[int]
    edges: list[tuple[int, int, int]] = field(default_factory=list)
    names: list[list[str]] = field(default_factory=list)


def lattice(window: str) -> Lattice:
    """All segments at once, for windows to learn from."""
    atoms = Atoms(window)
    out = Lattice(atoms.bounds)
    for j in range(1, len(atoms.bounds)):
        out.edges.append((j - 1, j, 0))
        out.names.append([f"atom={atoms.codes[j - 1]}"])
        for i, key in atoms.into(j):
            names = feature_names(key)
            for kind in range(1, len(KINDS) + 1):
                out.edges.append((i, j, kind))
                out.names.append(names)
    return out


class Model:
    """Weights of (type, feature)."""

    def __init__(self):
        self.number: dict[tuple[int, str], int] = {}
        self.weights = np.zeros(0)

    def indexes(self, lat: Lattice, grow: bool = False) -> list[list[int]]:
        out = []
        for (_, _, kind), names in zip(lat.edges, lat.names, strict=True):
            if grow:
                out.append([self.number.setdefault((kind, n), len(self.number)) for n in ["bias", *names]])
            else:
                out.append([k for n in ["bias", *names] if (k := self.number.get((kind, n))) is not None])
        return out

    def scores(self, indexes: list[list[int]]) -> list[float]:
        return [float(self.weights[i].sum()) for i in indexes]


def posteriors(lat: Lattice, scores: list[float]) -> np.ndarray:
    """The probability of each segment, by forward and backward sums."""
    size = len(lat.bounds)
    forward, backward = [-np.inf] * size, [-np.inf] * size
    forward[0] = backward[-1] = 0.0
    into: list[list[int]] = [[] for _ in range(size)]
    outof: list[list[int]] = [[] for _ in range(size)]
    for k, (i, j, _) in enumerate(lat.edges):
        into[j].append(k)
        outof[i].append(k)
    for j in range(1, size):
        forward[j] = float(np.logaddexp.reduce([forward[lat.edges[k][0]] + scores[k] for k in into[j]]))
    for i in range(size - 2, -1, -1):
        backward[i] = float(np.logaddexp.reduce([backward[lat.edges[k][1]] + scores[k] for k in outof[i]]))
    return np.exp([forward[i] + s + backward[j] - forward[-1] for (i, j, _), s in zip(lat.edges, scores, strict=True)])


_MOST_KEPT = 200_000


class Scorer:
    """Scores of segments by their keys; what was computed is kept, up to a bound."""

    def __init__(self, model: Model):
        self.weights = {name: [0.0] * (len(KINDS) + 1) for _, name in model.number}
        for (kind, name), n in model.number.items():
            self.weights[name][kind] = float(model.weights[n])
        self.kept: dict[Key, list[float]] = {}
        self.none = [0.0] * (len(KINDS) + 1)

    def plain(self, code: str) -> float:
        return self.weights.get("bias", self.none)[0] + self.weights.get(f"atom={code}", self.none)[0]

    def entity(self, key: Key) -> list[float]:
        """The score of each kind, from 1 on."""
        found = self.kept.get(key)
        if found is None:
            if len(self.kept) >= _MOST_KEPT:
                self.kept.clear()
            rows = [self.weights.get(n, self.none) for n in ["bias", *feature_names(key)]]
            found = self.kept[key] = [sum(r[k] for r in rows) for k in range(1, len(KINDS) + 1)]
        return found


def _log_sum(terms: list[float]) -> float:
    most = max(terms)
    return most + math.log(sum(math.exp(t - most) for t in terms))


def decode(window: str, scorer: Scorer) -> list[tuple[int, int, int, float]]:
    """(start, end, kind, probability) of the entities of the best segmentation, in characters.

    Forward sums and best segmentation in one pass, backward sums in another one over the same segments, which are made
    anew: only a few numbers an atom are kept, however long the window is.
    """
    atoms = Atoms(window)
    size = len(atoms.bounds)
    plain = [scorer.plain(c) for c in atoms.codes]
    forward, best, back, several = [0.0] * size, [0.0] * size, [(0, 0, 0.0)] * size, False
    for j in range(1, size):
        terms = [forward[j - 1] + plain[j - 1]]
        best[j], back[j] = best[j - 1] + plain[j - 1], (j - 1, 0, plain[j - 1])
        for i, key in atoms.into(j):
            several = True
            for kind, score in enumerate(scorer.entity(key), 1):
                terms.append(forward[i] + score)
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, kind, score)
        forward[j] = _log_sum(terms) if len(terms) > 1 else terms[0]
    path, j = [], size - 1
    while j and several:
        i, kind, score = back[j]
        if kind:
            path.append((i, j, kind, score))
        j = i
    if not path:
        return []
    out: list[list[float]] = [[] for _ in range(size)]  # of the segments that begin at an atom, until it is reached
    backward = [0.0] * size
    for j in range(size - 1, 0, -1):
        if j < size - 1:
            backward[j] = _log_sum(out[j])
            out[j] = []
        out[j - 1].append(plain[j - 1] + backward[j])
        for i, key in atoms.into(j):
            out[i].extend(score + backward[j] for score in scorer.entity(key))
    return [(atoms.bounds[i], atoms.bounds[j], kind, math.exp(forward[i] + score + backward[j] - forward[-1])) for i, j, kind, score in path[::-1]]


def rewritten(kind: str, text: str, turn: int) -> str:
    """The same datum in another spelling."""
    if kind == "phone":
        bare = re.sub(r"^\+[0-9]+[ -]?", "", text)
        return [bare, bare.replace("-", "."), re.sub(r"[()]", "", bare).replace(" ", "-"), text.replace("-", " ")][turn % 4]
    if kind == "email":
        name, _, host = text.partition("@")
        return [f"{name} at {host.replace('.', ' dot ')}", f"{name} [at] {host.replace('.', ' [dot] ')}"][turn % 2]
    if kind == "card":
        return " ".join(re.findall(r"[0-9]{1,4}", _digits(text))) if turn % 2 else "-".join(re.findall(r"[0-9]{1,4}", _digits(text)))
    return text


def samples(text: str | None) -> list[tuple[str, str, int, int]]:
    """Windows of a text to learn from: (window, kind, start, end) for base spans that stand alone, and with an empty kind
    for windows without any."""
    if not text or not _ANY.search(text):
        return []
    spans, out = base_spans(text), []
    starts, ends = sorted(s for _, s, _ in spans), sorted(e for _, _, e in spans)
    touching = lambda low, high: bisect_left(starts, high) - bisect_right(ends, low)
    for kind, start, end in spans:
        low, high = max(0, start - MARGIN), min(len(text), end + MARGIN)
        if end - start <= MOST_CHARS and touching(low, high) == 1:
            out.append((text[low:high], kind, start - low, end - low))
    for low, high in windows(text):
        if high - low <= 4 * MOST_CHARS and not touching(low, high):
            out.append((text[low:high], "", 0, 0))
    return out


def train(rows: list[tuple[str, str, int, int]]) -> Model:
    """Fit on windows as `samples` gives them; every second entity is rewritten first."""
    learned: list[tuple[str, list[tuple[int, int, int]]]] = []
    for turn, (window, kind, start, end) in enumerate(rows):
        if kind:
            entity = rewritten(kind, window[start:end], turn // 2) if turn % 2 else window[start:end]
            gold = [(KINDS.index(kind) + 1, start, start + len(entity))]
            learned.append((window[:start] + entity + window[end:], gold))
        else:
            learned.append((window, []))
    model, prepared = Model(), []
    for window, gold in learned:
        lat = lattice(window)
        wanted = {(s, e): k for k, s, e in gold}
        covered = {p for s, e in wanted for p in range(s, e)}
        chosen = np.array([
            float(wanted.get((lat.bounds[i], lat.bounds[j])) == kind if kind else lat.bounds[i] not in covered)
            for i, j, kind in lat.edges
        ])
        if sum(lat.bounds[j] - lat.bounds[i] for (i, j, _), c in zip(lat.edges, chosen, strict=True) if c) == lat.bounds[-1]:
            prepared.append((lat, model.indexes(lat, grow=True), chosen))
    model.weights = np.zeros(len(model.number))
    squares = np.full(len(model.number), 1e-6)
    for _ in range(EPOCHS):
        for lat, indexes, chosen in prepared:
            off = chosen - posteriors(lat, model.scores(indexes))
            slope = np.zeros(len(model.weights))
            for k in np.flatnonzero(np.abs(off) > 1e-4):
                slope[indexes[k]] += off[k]
            slope -= 1e-3 * model.weights
            squares += slope**2
            model.weights += RATE * slope / np.sqrt(squares)
    return model


def _merged(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the places that spans cover, apart from each other."""
    starts: list[int] = []
    ends: list[int] = []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def find(text: str | None, model: Model | Scorer) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans with what the model adds, by kind, then start."""
    if not text or not _ANY.search(text):
        return [], []
    scorer = model if isinstance(model, Scorer) else Scorer(model)
    base = base_spans(text)
    starts, ends = _merged(base)
    covered = lambda low, high: range(bisect_right(ends, low), bisect_left(starts, high))
    added = []
    for low, high in windows(text):
        rest, at = [], low
        for n in covered(low, high):
            rest += [text[at:max(at, starts[n])], " " * (min(ends[n], high) - max(starts[n], low))]
            at = min(ends[n], high)
        if not _TRIGGER.search("".join([*rest, text[at:high]])):
            continue
        for start, end, kind, sure in decode(text[low:high], scorer):
            if sure >= SURE and not covered(low + start, low + end):
                added.append((KINDS[kind - 1], low + start, low + end))
    order = {k: n for n, k in enumerate(KINDS)}
    key = lambda s: (order[s[0]], s[1], s[2])
    return sorted(base, key=key), sorted(base + added, key=key)


SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def fit_on(docs: DataFrame, most: int = MOST_WINDOWS) -> Model:
    """Fit on the whole texts of the 10 * `most` documents with the smallest hashes among those with digits or at signs;
    `most` windows with an entity and `most` without reach the driver."""

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [[dict(zip(("window", "kind", "start", "end"), x)) for x in samples(t.as_py())] for t in batch]
            yield pa.array(rows, _SAMPLE_TYPE)

    some = docs.where(docs["text"].rlike("[0-9@]") & docs["doc_id"].isNotNull()).select(docs["doc_id"].alias("doc_id")).distinct()
    chosen = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(10 * most)
    texts = docs.select(docs["doc_id"], docs["text"]).join(F.broadcast(chosen), "doc_id")
    found = texts.select(F.inline(arrow_stream(cut, _SAMPLE)("text"))).distinct()
    kinds = [found.where(F.col("kind") == "") if plain else found.where(F.col("kind") != "") for plain in (False, True)]
    rows = [r for part in kinds for r in part.orderBy(F.xxhash64("window"), "window", "start").limit(most).collect()]
    return train([tuple(r) for r in rows])


_SAMPLE = "array<struct<window:string,kind:string,start:int,end:int>>"
_SAMPLE_TYPE = pa.list_(pa.struct([("window", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def spans_column(docs: DataFrame, text: str | Column, model: Model) -> Column:
    """struct(base, spans) of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [find(t.as_py(), scorer) for t in batch]
            as_rows = lambda spans: [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans]
            yield pa.StructArray.from_arrays(
                [pa.array(as_rows([b for b, _ in found]), _SPANS_TYPE), pa.array(as_rows([a for _, a in found]), _SPANS_TYPE)],
                ["base", "spans"],
            )

    return arrow_stream(scan, f"struct<base:{SPANS},spans:{SPANS}>")(text)


def scan(docs: DataFrame, most: int = MOST_WINDOWS) -> DataFrame:
    """(doc_id, base, spans) of each document, spans in code points."""
    model = fit_on(docs, most)
    return docs.select(docs["doc_id"], spans_column(docs, docs["text"], model).alias("found")).select("doc_id", "found.*")
