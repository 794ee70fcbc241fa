"""SentencePiece encoding and decoding with a given BPE vocabulary.

A batch's distinct units (a run of spaces and what follows it) are concatenated and indexed by a
suffix array. Every piece of the vocabulary is looked up in it by binary search, which gives the
range of its occurrences. These edges are sorted by position, and the symbols of
all units are relaxed along them: the best edge over two neighbours joins them, until none is
left. Ids are those of the sentencepiece library for the same model.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
from pyspark.sql import DataFrame

from .shared import arrow_batch

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
BATCH_CHARS = 3_000_000  # of text encoded at a time; a longer text is a batch of its own
MOST_UNITS = 400_000  # remembered from batch to batch
DEPTH = 16  # code points by which suffixes are sorted, the longest piece at most
_UNIT = re.compile(" +[^ ]*")
_NONE = np.int32(2**31 - 1)
_OTHER = np.uint32(0x110000)  # no code point
_TIED = -1e8  # pieces below this score tie, and the leftmost goes first


@dataclass
class Vocabulary:
    """Pieces of a model as plain data, which tasks carry along."""

    pieces: list[str]  # normal pieces, spaces as spaces
    ids: np.ndarray
    rank: np.ndarray  # place by score, ties equal
    tied: int  # ranks from here on tie
    byte_ids: np.ndarray
    raw: list[bytes]  # what each id decodes to
    signs: np.ndarray  # code points that occur in pieces


def load(model: str = MODEL) -> Vocabulary:
    """Read a model file, in the driver."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, ids, scores, raw, byte_ids = [], [], [], [], np.full(256, m.unk_id(), np.int32)
    for i in range(m.get_piece_size()):
        piece = m.id_to_piece(i)
        if m.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            raw.append(bytes([int(piece[3:5], 16)]))
        elif m.is_control(i) or m.is_unknown(i):
            raw.append(b"")
        else:
            piece = piece.replace(SPACE, " ")
            raw.append(piece.encode())
            pieces.append(piece)
            ids.append(i)
            scores.append(m.get_score(i))
    if max(map(len, pieces)) > DEPTH:
        raise ValueError(f"a piece is longer than {DEPTH} code points")
    if any(" " in p.lstrip(" ") for p in pieces):
        raise ValueError("a piece has a space behind other signs; units would not be independent")
    signs = np.unique(_points("".join(pieces)))
    if len(signs) > 65_000:
        raise ValueError("the pieces have too many different signs")
    order, rank = np.unique(-np.array(scores), return_inverse=True)
    return Vocabulary(pieces, np.array(ids, np.int32), rank.astype(np.int32), int(np.searchsorted(order, -_TIED)), byte_ids, raw, signs)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _strings(codes: np.ndarray, bits: int) -> np.ndarray:
    """Rows of ``DEPTH`` codes as sortable byte strings."""
    return np.ascontiguousarray(codes.astype(f">u{bits // 8}")).view(f"S{bits // 8 * DEPTH}").ravel()


class Index:
    """Suffix array of a text, by the first ``DEPTH`` code points of each suffix."""

    def __init__(self, points: np.ndarray):
        self.signs, codes = np.unique(points, return_inverse=True)
        self.codes = codes.astype(np.uint16) + np.uint16(1)
        bits = 8 if len(self.signs) < 255 else 16
        each = 64 // bits
        padded = np.concatenate([self.codes, np.zeros(DEPTH, np.uint16)]).astype(np.uint64)
        n = len(self.codes)
        keys = []
        for at in range(0, DEPTH, each):
            key = np.zeros(n, np.uint64)
            for j in range(each):
                key = (key << np.uint64(bits)) | padded[at + j : at + j + n]
            keys.append(key)
        # Sorted by the first codes; only where they tie by the rest as well.
        self.array = np.argsort(keys[0])
        first = keys[0][self.array]
        tie = np.append(False, first[1:] == first[:-1])
        tie[:-1] |= tie[1:]
        spots = np.flatnonzero(tie)
        inside = self.array[spots]
        self.array[spots] = inside[np.lexsort([k[inside] for k in keys[::-1]])]
        self.bits = bits
        padded = padded.astype(f"u{bits // 8}")
        self.prefixes = _strings(np.lib.stride_tricks.sliding_window_view(padded, DEPTH)[self.array], bits)

    def occurrences(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First and last place in the array of the suffixes that begin with each piece."""
        lengths = np.array([len(p) for p in pieces])
        points = _points("".join(pieces))
        at = np.searchsorted(self.signs, points)
        at[at == len(self.signs)] = 0
        known = self.signs[at] == points
        starts = np.cumsum(lengths) - lengths
        column = np.arange(DEPTH)
        inside = column < lengths[:, None]
        spot = np.where(inside, starts[:, None] + column, 0)
        codes = np.where(inside, at[spot] + 1, 0)
        possible = np.logical_and.reduce(known[spot] | ~inside, axis=1)
        low = _strings(codes, self.bits)
        high = _strings(np.where(inside, codes, (1 << self.bits) - 1), self.bits)
        first = np.searchsorted(self.prefixes, low, "left")
        last = np.searchsorted(self.prefixes, high, "right")
        return first, np.where(possible, last, first)


def _edges(points: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of all pieces, sorted by position and length: their keys and pieces.

    Signs that are in no piece share one code, so that however many there are the index can tell the others.
    """
    at = np.minimum(np.searchsorted(v.signs, points), len(v.signs) - 1)
    index = Index(np.where(v.signs[at] == points, points, _OTHER))
    first, last = index.occurrences(v.pieces)
    many = np.maximum(last - first, 0)
    piece = np.repeat(np.arange(len(v.pieces)), many)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    lengths = np.array([len(p) for p in v.pieces])
    key = index.array[place] * 32 + lengths[piece]
    order = np.argsort(key)
    return key[order], piece[order]


def _segmented(points: np.ndarray, unit_starts: np.ndarray, v: Vocabulary):
    """Relax: start of every symbol that is left, and its piece (-1: no piece, its bytes)."""
    n = len(points)
    keys, found = _edges(points, v)

    def look_up(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = end - start
        key = start * 32 + np.minimum(length, 31)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1) if len(keys) else np.zeros(len(key), int)
        hit = (keys[at] == key) & (length <= DEPTH) if len(keys) else np.zeros(len(key), bool)
        return np.where(hit, found[at] if len(keys) else 0, -1)

    rank_of = np.append(v.rank, _NONE)  # the last is for no piece
    first_of_unit = np.zeros(n + 1, bool)
    first_of_unit[unit_starts] = True
    first_of_unit[n] = True
    # No piece lies across an uncovered border, so what is between two of them is independent.
    covered = np.zeros(n + 1, np.int64)
    start, length = keys // 32, keys % 32
    np.add.at(covered, start + 1, 1)
    np.add.at(covered, start + length, -1)
    border = (np.cumsum(covered)[:n] == 0) | first_of_unit[:n]
    segment = np.cumsum(border) - 1
    after = np.arange(1, n + 1)  # start of the next symbol
    before = np.arange(-1, n - 1)
    alive = np.ones(n, bool)
    best = np.full(n, _NONE, np.int32)  # rank of the edge over a symbol and the next
    fresh = np.flatnonzero(~border[1:])  # symbols with a next one in their segment
    best[fresh] = rank_of[look_up(fresh, fresh + 2)]
    active = np.flatnonzero(best != _NONE)
    lead = np.full(segment[-1] + 1 if n else 0, _NONE, np.int32)
    end_of = np.append(np.flatnonzero(border)[1:], n) if n else np.zeros(0, int)
    while len(active):
        own = segment[active]
        heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        lead[own[heads]] = np.minimum.reduceat(best[active], heads)
        at_best = best[active] == lead[own]
        chosen = active[at_best]
        group = own[at_best]
        new = np.append(True, group[1:] != group[:-1])
        # Of the same piece all go at once, of a run of overlapping ones every second.
        run = np.append(True, (chosen[1:] != after[chosen[:-1]]) | (group[1:] != group[:-1])) if len(chosen) else new
        since = np.arange(len(chosen)) - np.maximum.accumulate(np.where(run, np.arange(len(chosen)), 0))
        chosen = chosen[np.where(best[chosen] >= v.tied, new, since % 2 == 0)]
        gone = after[chosen]
        alive[gone] = False
        best[gone] = _NONE
        after[chosen] = after[gone]
        inner = after[chosen] < n
        before[after[chosen][inner]] = chosen[inner]
        # Edges to the next and from the previous symbol are new.
        left = before[chosen]
        left = left[(left >= 0) & ~border[chosen]]
        again = np.concatenate([chosen, left])
        again = again[alive[again]]
        best[again] = _NONE
        again = again[after[again] < end_of[segment[again]]]
        best[again] = rank_of[look_up(again, after[after[again]])]
        active = np.flatnonzero(best != _NONE)
    starts = np.flatnonzero(alive)
    return starts, look_up(starts, np.append(starts[1:], n))


def encode_units(units: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units one after another, and where each unit's begin (and the last end)."""
    lengths = np.array([len(u) for u in units])
    points = _points("".join(units))
    unit_starts = np.cumsum(lengths) - lengths
    starts, piece = _segmented(points, unit_starts, v)
    ids = np.where(piece >= 0, v.ids[piece], -1)
    # A sign without a piece becomes its bytes.
    many = np.ones(len(ids), np.int64)
    odd = np.flatnonzero(ids < 0)
    as_bytes = [chr(p).encode("utf-8", "replace") for p in points[starts[odd]]]
    many[odd] = [len(b) for b in as_bytes]
    out = np.repeat(ids, many)
    if len(odd):
        out[np.repeat(ids < 0, many)] = v.byte_ids[np.frombuffer(b"".join(as_bytes), np.uint8)]
    bounds = np.concatenate(([0], np.cumsum(many)))
    return out.astype(np.int32), bounds[np.searchsorted(starts, np.append(unit_starts, len(points)))]


class Encoder:
    """Encodes batches of texts; units that an earlier batch had are not indexed again."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[str, int] = defaultdict(count().__next__)
        self.ids, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin (and the last end)."""
        if len(self.seen) > MOST_UNITS:
            self._forget()
        known = len(self.seen)
        units: list[int] = []
        many = []
        for text in texts:
            found = _UNIT.findall(" " + text.replace(SPACE, " ")) if text else []
            many.append(len(found))
            units.extend(map(self.seen.__getitem__, found))
        if not units:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        if len(self.seen) > known:
            ids, bounds = encode_units(list(islice(self.seen, known, None)), self.vocabulary)
            self.bounds = np.concatenate([self.bounds, bounds[1:] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
        unit = np.array(units)
        size = np.diff(self.bounds)[unit]
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) + np.repeat(self.bounds[unit] - ends + size, size)
        of_text = np.concatenate(([0], np.cumsum(many)))
        return self.ids[place], np.concatenate(([0], ends))[of_text]


def encode(texts: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and where each text's begin (and the last end)."""
    return Encoder(vocabulary)(texts)


def decode(ids: list[int], v: Vocabulary) -> str:
    """The text of ids; bytes that are no UTF-8 become U+FFFD, the space put in front goes."""
    return b"".join([v.raw[i] for i in ids]).decode("utf-8", "replace")[1:] if ids else ""


def _batches(texts: list[str | None]):
    """Ranges of rows of about ``BATCH_CHARS``."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= BATCH_CHARS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def with_ids(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids and round_trip of every whole text.

    round_trip tells whether the decoded ids are the text again; they are unless it has U+2581, which
    the vocabulary uses for the space. Null and empty texts have no ids. Rows that
    repeat are encoded each. An empty table gives an empty result.
    """
    import pyarrow as pa

    schema = "doc_id long, n_tokens long, ids array<int>, round_trip boolean"

    def task(batches):
        encode = Encoder(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _batches(texts):
                own = [t or "" for t in texts[a:b]]
                ids, bounds = encode(own)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                same = [decode(ids[x:y].tolist(), vocabulary) == t for x, y, t in zip(bounds[:-1], bounds[1:], own, strict=True)]
                yield arrow_batch(schema, [batch.column(0).slice(a, b - a), np.diff(bounds), lists, same])

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", f"`{text}` AS text").mapInArrow(task, schema)


def with_texts(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and text of rows of doc_id and ids. Null ids give a null text."""

    def task(batches):
        for batch in batches:
            texts = [None if ids is None else decode(ids, vocabulary) for ids in batch.column(1).to_pylist()]
            yield arrow_batch("doc_id long, text string", [batch.column(0), texts])

    return encoded.selectExpr("CAST(doc_id AS LONG) AS doc_id", "ids").mapInArrow(task, "doc_id long, text string")
