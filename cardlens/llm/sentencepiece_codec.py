"""SentencePiece encoding and decoding in batches.

A text is cut into words (blanks, then the rest up to the next blank), since no piece
has a blank after another character. Different words of a batch are segmented once,
all together: from every character at once, the trie of the pieces is followed as far
as it goes, which gives the arcs. Then position by position, for all words that reach
it, the best arc that ends there is kept with a back pointer.

- Unigram models: an arc's weight is its piece's score, summed along the path.
- BPE models: merging is local. A sequence of pieces is what merging makes of a word
  exactly when each neighbouring pair is what merging makes of the two. So the arc of
  a piece is open if it and the last piece before it form such a pair, and closed
  otherwise; one path is open. Pairs are merged many together, and remembered.

BPE gives the very ids of the sentencepiece library for the same file. So does unigram,
but where two paths are equal up to rounding: scores are summed by word here.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cardlens.llm.arrays import byte_pieces, mixed, row_slices, text_bytes

# Numbers of the public model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNKNOWN_PENALTY = np.float32(10.0)
UNKNOWN_TEXT = " ⁇ "
BLANK = 0x2581

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.int64(1 << 24)
_POINT_BITS = 21
SLICE = 1 << 20
REMEMBERED_WORDS = 300_000  # some 15 MB
REMEMBERED_BITS = 21  # places for pairs of pieces, 16 MB; a new pair takes an older one's place
SEGMENTED = 1 << 17  # characters of words that are segmented together
MERGED = 1 << 19  # characters of pairs of pieces that are merged together


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a message in the protocol buffer wire format."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            size = 4 if kind == 5 else 8
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class PieceModel:
    """What encoding and decoding need of a model file."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    algorithm: int
    prefix: bool = True
    squeeze: bool = True

    @classmethod
    def load(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        pieces, scores, kinds = [], [], []
        algorithm, prefix, squeeze = UNIGRAM, True, True
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                pieces.append(own[1].decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif number == 2:
                algorithm = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("models that normalize characters are not supported")
                prefix, squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if algorithm not in (UNIGRAM, BPE) or USER_DEFINED in kinds:
            raise ValueError("only unigram and BPE models without user-defined pieces are supported")
        blank = chr(BLANK)
        if any(blank in p.lstrip(blank) for p, kind in zip(pieces, kinds) if kind == NORMAL):
            raise ValueError("pieces that reach across words are not supported")
        return cls(pieces, np.array(scores, np.float32), np.array(kinds), algorithm, prefix, squeeze)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenation of start, start + 1, ... for each start and size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Lookup:
    """Values of integer keys, for many keys at once; -1 for those it does not have.

    Most keys asked for are absent, and a table of bits of their hashes says so for
    nearly all of them. The others are searched among the sorted keys.
    """

    def __init__(self, values: dict[int, int]):
        self.keys = np.array(sorted(values), np.int64)
        self.values = np.array([values[k] for k in self.keys.tolist()], np.int64)
        self.bits = max(10, len(values).bit_length() + 4)
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[_places(self.keys, self.bits)] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        flat = keys.reshape(-1)
        out = np.full(len(flat), -1, np.int64)
        some = np.flatnonzero(self.maybe[_places(flat, self.bits)])
        if len(some):
            asked = flat[some]
            at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
            out[some] = np.where(self.keys[at] == asked, self.values[at], -1)
        return out.reshape(keys.shape)


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """A number of so many bits for each key: the high ones of a product."""
    return ((keys.astype(np.uint64) * _MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Codec:
    model: PieceModel

    def __post_init__(self):
        m = self.model
        self._forget()
        usable = [i for i, kind in enumerate(m.kinds) if kind == NORMAL]
        symbols = [(m.pieces[i], i) for i in usable]
        have = {p for p, _ in symbols}
        # characters that only occur inside pieces are symbols of their own, with no id
        inner = sorted({c for p, _ in symbols for c in p} - have)
        self.count = len(m.pieces)
        self.inner = np.array([ord(c) for c in inner], np.int64)
        symbols += [(c, self.count + k) for k, c in enumerate(inner)]
        self.longest = max((len(p) for p, _ in symbols), default=1)
        self.text_of = {i: p for p, i in symbols}
        self.id_of = {p: i for p, i in symbols}
        self._prepare_trie(symbols)
        self.weights = np.zeros(self.count + len(inner), np.float32)
        self.weights[: self.count] = m.scores
        self.unknown_score = np.float32(m.scores[usable].min() if usable else 0) - UNKNOWN_PENALTY
        self.weights[self.count :] = self.unknown_score
        self.bytes_ids = np.full(256, -1, np.int64)
        for i, kind in enumerate(m.kinds):
            if kind == BYTE:
                self.bytes_ids[int(m.pieces[i][3:5], 16)] = i
        self.unknown_id = int(np.flatnonzero(m.kinds == UNKNOWN)[0])
        surfaces = []
        for p, kind in zip(m.pieces, m.kinds):
            surfaces.append(
                bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL
                else UNKNOWN_TEXT.encode() if kind == UNKNOWN else p.replace(chr(BLANK), " ").encode()
            )
        self.surface_sizes = np.array([len(s) for s in surfaces], np.int64)
        self.surface_starts = np.cumsum(self.surface_sizes) - self.surface_sizes
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        if m.algorithm == BPE:
            self._prepare_merges(usable)

    def _prepare_trie(self, symbols: list[tuple[str, int]]) -> None:
        """Edges by node and character, and the symbol of each node's text, -1 for none."""
        edges, symbol_at = {}, [-1]
        for text, symbol in symbols:
            node = 0
            for c in text:
                key = node << _POINT_BITS | ord(c)
                if key not in edges:
                    edges[key] = len(symbol_at)
                    symbol_at.append(-1)
                node = edges[key]
            symbol_at[node] = symbol
        self.edges = Lookup(edges)
        self.symbol_at = np.array(symbol_at, np.int64)

    def _prepare_merges(self, usable: list[int]) -> None:
        merges = {}
        for i in usable:
            p = self.model.pieces[i]
            for cut in range(1, len(p)):
                left, right = self.id_of.get(p[:cut]), self.id_of.get(p[cut:])
                if left is not None and right is not None:
                    merges[left * int(_PAIR) + right] = i
        self.merges = Lookup(merges)
        # the last place is what an absent pair, -1, finds
        self.merge_scores = np.append(self.weights, np.float32(-np.inf))
        self.remembered = np.zeros(1 << REMEMBERED_BITS, np.int64)
        # each symbol's text as symbols of one character
        self.spelt_sizes = np.array([len(self.text_of.get(i, "")) for i in range(len(self.weights))], np.int64)
        self.spelt_starts = np.cumsum(self.spelt_sizes) - self.spelt_sizes
        self.spelt = np.array([self.id_of[c] for i in sorted(self.text_of) for c in self.text_of[i]], np.int64)
        self.step = max(1, MERGED // (2 * self.longest))
        self.alone = np.zeros(len(self.weights), bool)
        for size in range(1, self.longest + 1):
            some = np.flatnonzero(self.spelt_sizes == size)
            for a in range(0, len(some), self.step):
                part = some[a : a + self.step]
                rows = self.spelt[self.spelt_starts[part][:, None] + np.arange(size)]
                self.alone[part] = self._merged(rows)[:, 0] == part

    def _merged(self, rows: np.ndarray) -> np.ndarray:
        """Merge each row of symbols (-1 pads at its end): highest score first, then leftmost."""
        rows = rows.copy()
        active = np.arange(len(rows))
        while len(active) and rows.shape[1] > 1:
            s = rows[active]
            pair = np.where((s[:, 1:] >= 0) & (s[:, :-1] >= 0), s[:, :-1] * _PAIR + s[:, 1:], -1)
            merged = self.merges(pair)
            score = self.merge_scores[merged]
            best = score.argmax(axis=1)
            line = np.arange(len(s))
            go = merged[line, best] >= 0
            s, best, merged, active = s[go], best[go], merged[go], active[go]
            line = np.arange(len(s))
            s[line, best] = merged[line, best]
            column = np.arange(s.shape[1])
            source = np.minimum(column + (column > best[:, None]), s.shape[1] - 1)
            moved = np.take_along_axis(s, source, axis=1)
            moved[:, -1] = -1
            rows[active] = moved
        return rows

    def _pair_open(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the text of two pieces gives just these two."""
        pair = left * _PAIR + right
        place = _places(pair, REMEMBERED_BITS)
        kept = self.remembered[place]  # twice the pair's number from 1, and 1 if it is open
        good = (kept & 1).astype(bool)
        lost = np.flatnonzero(kept >> 1 != pair + 1)
        if len(lost):
            new, back = np.unique(pair[lost], return_inverse=True)
            steps = range(0, len(new), self.step)
            fresh = np.concatenate([self._merge_pairs(new[a : a + self.step]) for a in steps])
            self.remembered[_places(new, REMEMBERED_BITS)] = (new + 1) * 2 + fresh
            good[lost] = fresh[back]
        return good

    def _merge_pairs(self, pair: np.ndarray) -> np.ndarray:
        left, right = pair // _PAIR, pair % _PAIR
        both = np.stack([left, right], axis=1).reshape(-1)
        sizes = self.spelt_sizes[both].reshape(-1, 2).sum(axis=1)
        rows = np.full((len(pair), int(sizes.max())), -1, np.int64)
        inside = np.arange(rows.shape[1]) < sizes[:, None]
        rows[inside] = self.spelt[_ranges(self.spelt_starts[both], self.spelt_sizes[both])]
        got = self._merged(rows)
        good = (got[:, 0] == left) & (got[:, 1] == right)
        return good & (got[:, 2] == -1) if got.shape[1] > 2 else good

    def _arcs(self, points: np.ndarray, word: np.ndarray, nth: np.ndarray, columns: np.ndarray, first: int, stop: int):
        """Character before, last character, length and symbol of arcs, by end, the longest first.

        The n-th character of a word is at ``columns[n] + word``; -1 is before the first.
        Arcs end at an n-th character from ``first`` to before ``stop``. A character c
        without piece is an arc of symbol -c - 2.
        """
        found = []
        start = end = np.arange(columns[max(0, first + 1 - self.longest)], columns[stop])
        node = np.zeros(len(start), np.int64)
        for size in range(1, self.longest + 1):
            node = self.edges(node << _POINT_BITS | points[end])
            symbol = np.where(node < 0, -1, self.symbol_at[node])
            keep = end >= columns[first]
            if size == 1:
                symbol = np.where(symbol < 0, -points[end] - 2, symbol)
            elif self.model.algorithm == BPE:
                keep &= (symbol >= 0) & self.alone[symbol]
            else:
                keep &= symbol >= 0
            found.append((start[keep], end[keep], np.full(int(keep.sum()), size), symbol[keep]))
            n = nth[start] + size
            # words are there by size, so the next column has this one if it has so many
            on = np.flatnonzero((node >= 0) & (n < stop))
            n = n[on]
            on = on[word[start[on]] < columns[n + 1] - columns[n]]
            if not len(on):
                break
            start, node = start[on], node[on]
            end = columns[nth[start] + size] + word[start]
        start, end, length, symbol = map(np.concatenate, zip(*found))
        order = np.argsort(end * (self.longest + 1) - length)
        start = start[order]
        before = np.where(nth[start] > 0, columns[nth[start] - 1] + word[start], -1)
        return before, end[order], length[order], symbol[order]

    def _paths(self, points: np.ndarray, word: np.ndarray, nth: np.ndarray, columns: np.ndarray):
        """Back pointers (piece length, symbol) at each character, where an arc ends."""
        # the last place, which is also -1, is before the first character
        kept_length = np.zeros(len(points) + 1, np.int32)
        kept_symbol = np.full(len(points) + 1, -1, np.int64)
        bpe = self.model.algorithm == BPE
        total = np.zeros(0 if bpe else len(points) + 1, np.float32)
        for first, stop in row_slices(columns, SEGMENTED):
            before, end, length, symbol = self._arcs(points, word, nth, columns, first, stop)
            if not bpe:
                weight = np.where(symbol < 0, self.unknown_score, self.weights[np.maximum(symbol, 0)])
            cuts = np.searchsorted(end, columns[first : stop + 1]).tolist()
            for n, a, b in zip(range(first, stop), cuts, cuts[1:]):
                if bpe:
                    left, right = kept_symbol[before[a:b]], symbol[a:b]
                    fine = (left < 0) | (right < 0)
                    check = np.flatnonzero(~fine)
                    fine[check] = self._pair_open(left[check], right[check])
                else:
                    sums = total[before[a:b]] + weight[a:b]
                    each = end[a:b] - columns[n]
                    most = np.maximum.reduceat(sums, np.flatnonzero(np.diff(each, prepend=-1)))
                    total[columns[n] : columns[n + 1]] = most
                    fine = sums == most[each]
                some = a + np.flatnonzero(fine)
                some = some[np.diff(end[some], prepend=-1) > 0]  # the longest piece wins ties
                kept_length[end[some]] = length[some]
                kept_symbol[end[some]] = symbol[some]
        return kept_length, kept_symbol

    def _segment(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Symbols of words, as one array and the number of each word's symbols."""
        counts = np.zeros(len(starts), np.int64)
        owners, turns, flat = [], [], []
        by_size = np.argsort(-sizes, kind="stable")
        for a, b in row_slices(np.concatenate([[0], np.cumsum(sizes[by_size])]), SEGMENTED):
            some = by_size[a:b]
            size = sizes[some]
            # first characters of all words, then second ones, and so on; the longest word first
            reach = np.searchsorted(-size, -np.arange(size[0]))
            columns = np.concatenate([[0], np.cumsum(reach)])
            nth = np.repeat(np.arange(size[0]), reach)
            word = _ranges(np.zeros_like(reach), reach)
            own = points[starts[some][word] + nth].astype(np.int64)
            length, symbol = self._paths(own, word, nth, columns)
            line, at = np.arange(len(some)), size
            lines, parts = [], []
            while len(line):
                last = columns[at - 1] + line
                lines.append(line)
                parts.append(symbol[last])
                at = at - length[last]
                line, at = line[at > 0], at[at > 0]
            owner = some[np.concatenate(lines)]
            counts += np.bincount(owner, minlength=len(starts))
            owners.append(owner)
            turns.append(np.repeat(np.arange(len(lines)), [len(x) for x in lines]))
            flat.append(np.concatenate(parts))
        out = np.empty(int(counts.sum()), np.int64)
        if flat:  # they were found from the last one on
            out[np.cumsum(counts)[np.concatenate(owners)] - 1 - np.concatenate(turns)] = np.concatenate(flat)
        return out, counts

    def _remembered(self, h: np.ndarray, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Where in ``pool`` the symbols of the words with hashes ``h`` are; new words are segmented."""
        if len(self.word_hashes) > REMEMBERED_WORDS:
            self._forget()
        at = np.searchsorted(self.word_hashes, h)
        known = at < len(self.word_hashes)
        known[known] = self.word_hashes[at[known]] == h[known]
        new = ~known
        if new.any():
            flat, counts = self._segment(points, starts[new], sizes[new])
            begin = len(self.pool) + np.cumsum(counts) - counts
            self.pool = np.concatenate([self.pool, flat.astype(np.int32)])
            place = at[new]
            self.word_hashes = np.insert(self.word_hashes, place, h[new])
            self.word_begins = np.insert(self.word_begins, place, begin)
            self.word_counts = np.insert(self.word_counts, place, counts)
            at = np.searchsorted(self.word_hashes, h)
        return self.word_begins[at], self.word_counts[at]

    def _forget(self) -> None:
        self.word_hashes = np.zeros(0, np.uint64)
        self.word_begins = self.word_counts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _prepared(self, text: str) -> str:
        if self.model.squeeze:
            text = " ".join(part for part in text.split(" ") if part)
        if not text:
            return ""
        return ((" " if self.model.prefix else "") + text).replace(" ", chr(BLANK))

    def _encode_slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ready = [self._prepared(t) for t in texts]
        size = np.array([len(t) for t in ready], np.int64)
        offsets = np.concatenate([[0], np.cumsum(size)])
        points = _points("".join(ready))
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        blank = points == BLANK
        first = blank.copy()
        first[1:] &= ~blank[:-1]
        first[offsets[:-1][size > 0]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(points))
        by_row = np.searchsorted(starts, offsets)
        # hash the words to find the different ones
        powers = np.multiply.accumulate(np.full(int((ends - starts).max()), _MULTIPLIER, np.uint64))
        inside = np.arange(len(points)) - np.repeat(starts, ends - starts)
        h = mixed(np.add.reduceat(mixed(points.astype(np.uint64) + np.uint64(1)) * powers[inside], starts))
        different, some, back = np.unique(h, return_index=True, return_inverse=True)
        begin, counts = self._remembered(different, points, starts[some], (ends - starts)[some])
        symbols = self.pool[_ranges(begin[back], counts[back])]
        by_word = np.concatenate([[0], np.cumsum(counts[back])])
        return self._to_ids(symbols, by_word[by_row])

    def _to_ids(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and how many each row has; characters without piece become bytes or unknown."""
        lost = (symbols < 0) | (symbols >= self.count)
        point = np.where(symbols < 0, -symbols - 2, 0)
        inner = symbols >= self.count
        point[inner] = self.inner[symbols[inner] - self.count]
        sizes = np.ones(len(symbols), np.int64)
        if self.bytes_ids.min() >= 0:
            sizes[lost] = 1 + (point[lost] >= 0x80) + (point[lost] >= 0x800) + (point[lost] >= 0x10000)
            ids = np.repeat(np.where(lost, 0, symbols), sizes)
            where = np.repeat(lost, sizes)
            nth = (np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[where]
            of, total = np.repeat(point, sizes)[where], np.repeat(sizes, sizes)[where]
            value = (of >> (6 * (total - 1 - nth))) & 0x3F
            lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[total] | (of >> (6 * (total - 1)))
            ids[where] = self.bytes_ids[np.where(total == 1, of, np.where(nth == 0, lead, value | 0x80))]
        else:  # neighbouring unknown characters of a row are one token
            repeated = lost.copy()
            repeated[1:] &= lost[:-1]
            repeated[:1] = False
            repeated[offsets[:-1][offsets[:-1] < len(symbols)]] = False
            sizes[repeated] = 0
            ids = np.where(lost, self.unknown_id, symbols)[~repeated]
        running = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(running[offsets])

    def encode(self, text: pa.Array) -> pa.Array:
        """Lists of ids; null stays null, the empty text has no ids."""
        _, offsets = text_bytes(text)
        texts = text.to_pylist()
        flats, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in row_slices(offsets, SLICE):
            ids, sizes = self._encode_slice([t or "" for t in texts[a:b]])
            flats.append(ids.astype(np.int32))
            counts.append(sizes)
        ends = np.cumsum(np.concatenate(counts))
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(np.concatenate(flats).astype(np.int32))
        )
        return pa.array(lists) if text.null_count == 0 else _with_nulls(lists, text)

    def decode(self, ids: pa.Array) -> pa.Array:
        """Texts; null stays null. Bytes that are no UTF-8 become U+FFFD; ids outside the
        vocabulary and null ids count as unknown."""
        flat = ids.flatten()
        flat = np.asarray(flat.fill_null(-1) if flat.null_count else flat, np.int64)
        flat = np.where((flat < 0) | (flat >= self.count), self.unknown_id, flat)
        sizes = np.array([0 if v is None else v for v in pc.list_value_length(ids).to_pylist()], np.int64)
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for k, valid in enumerate(ids.is_valid().to_pylist()):
            own = flat[cuts[k] : cuts[k + 1]]
            data = self.surface[_ranges(self.surface_starts[own], self.surface_sizes[own])].tobytes()
            text = data.decode(errors="replace")
            if self.model.prefix and text.startswith(" "):
                text = text[1:]
            out.append(text if valid else None)
        return pa.array(out, pa.string())


def _with_nulls(lists: pa.ListArray, like: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(lists.offsets, lists.values, mask=like.is_null())


@lru_cache(maxsize=2)
def codec_of(data: bytes) -> Codec:
    """One codec for each model in a Python worker, which serves many tasks."""
    return Codec(PieceModel.parse(data))


class SentencePiece:
    """Encoding and decoding of columns with one model file, which only the driver reads.

    A Python worker remembers words it has segmented and pairs of pieces it has merged,
    of which natural text has a limited number.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.data = f.read()
        PieceModel.parse(self.data)  # complain here rather than in a task

    def encode(self, text: Column) -> Column:
        data = self.data

        @arrow_udf("array<int>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = codec_of(data)
            for batch in batches:
                parts = [codec.encode(part) for part in byte_pieces(batch, SLICE)]
                yield pa.concat_arrays(parts) if parts else codec.encode(batch)

        return run(text)

    def round_trip(self, text: Column) -> Column:
        """Struct of the ids of a text and what they decode to, in one pass."""
        data = self.data

        def both(codec: Codec, part: pa.Array) -> pa.Array:
            ids = codec.encode(part)
            return pa.StructArray.from_arrays([ids, codec.decode(ids)], ["ids", "decoded"])

        @arrow_udf("ids array<int>, decoded string")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = codec_of(data)
            for batch in batches:
                parts = [both(codec, part) for part in byte_pieces(batch, SLICE)]
                yield pa.concat_arrays(parts) if parts else both(codec, batch)

        return run(text)

    def decode(self, ids: Column) -> Column:
        data = self.data

        @arrow_udf("string")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = codec_of(data)
            for batch in batches:
                yield codec.decode(batch)

        return run(ids)


def default_model_path(spark: SparkSession) -> str:
    """The model file named by ``spark.cardlens.sentencepiece.model``, else the public one here."""
    return spark.conf.get("spark.cardlens.sentencepiece.model", "/opt/tokenizers/piece_bpe_32k.model")


def sentencepiece_stage(docs: DataFrame, path: str) -> DataFrame:
    """Documents as token ids: doc_id, source, lang, n_tokens and ids; one row for each row.

    A null text has null ids and no tokens.
    """
    ids = SentencePiece(path).encode(F.col("text"))
    encoded = docs.select("doc_id", "source", "lang", ids.alias("ids"))
    return encoded.select(
        "doc_id", "source", "lang", F.coalesce(F.size("ids"), F.lit(0)).alias("n_tokens"), "ids"
    ).withColumn("n_tokens", F.greatest("n_tokens", F.lit(0)))
