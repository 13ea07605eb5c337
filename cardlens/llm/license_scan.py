"""Finding licence texts in documents.

Every template has overlapping windows of one and a half times its length laid over a
text, half a template apart, so that each occurrence is inside one window. A window's
MinHash bands retrieve the templates that agree in a band. With two rows in each of 32
bands, a window that holds four fifths of a template is found with a probability above
0.999 (``band_probability``). Windows that hold too few word pairs of any template of
their length are passed over before that, by running counts. What is retrieved is
verified exactly: the share of the template's word pairs that a part of the window
contains, the part with the most of them and the least else.

Shingles are pairs of words, since many licence notes have fewer than five.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cardlens.llm.arrays import mixed, row_slices, span_hashes, text_bytes

# Licence notes as they are usually written: fixed values.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("All rights reserved", "All rights reserved."),
)

BANDS, ROWS = 32, 2
LEAST = 0.8

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SALTS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _words(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends and n + 1 offsets of runs of letters and digits."""
    inside = _WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _pairs(h: np.ndarray) -> np.ndarray:
    return mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])


def _bands(shingles: np.ndarray) -> np.ndarray:
    low = mixed(shingles[:, None] ^ _SALTS[None, :]).min(axis=0).reshape(BANDS, ROWS)
    key = mixed(low[:, 0] * np.uint64(0x2545F4914F6CDD1D) + low[:, 1])
    return mixed(key + np.arange(BANDS, dtype=np.uint64))


def band_probability(words: int, pairs: int, least: float = LEAST) -> float:
    """Least probability that a window agrees in a band with a template that it just holds.

    The template has ``words`` words and ``pairs`` different pairs of them; all other
    pairs of the window are taken to be different ones that the template lacks.
    """
    held = int(np.ceil(least * pairs - 1e-9))
    window = words + words // 2 - 1
    alike = held / (pairs + window - held)
    return 1 - (1 - alike**ROWS) ** BANDS


class Scanner:
    def __init__(self, templates=TEMPLATES, least: float = LEAST):
        self.names = [name for name, _ in templates]
        self.least = least
        self.sets, self.times, self.length, self.by_band = [], [], [], {}
        for number, (_, text) in enumerate(templates):
            data = _FOLD[np.frombuffer(text.encode(), np.uint8)]
            starts, ends, _ = _words(data, np.array([0, len(data)]))
            if len(starts) < 2:
                raise ValueError("a template needs two words")
            own, times = np.unique(_pairs(span_hashes(data, starts, ends)), return_counts=True)
            self.sets.append(own)
            self.times.append(times)
            self.length.append(len(starts))
            for key in _bands(own).tolist():
                self.by_band.setdefault(key, set()).add(number)
        self.groups = sorted(set(self.length))

    def scan(self, text: pa.Array) -> list[list[dict]]:
        """By text: licence, byte span and containment of each occurrence, in order."""
        data, offsets = text_bytes(text)
        out: list[list[tuple[int, dict]]] = [[] for _ in range(len(text))]
        for a, b in row_slices(offsets):
            base = offsets[a]
            piece = _FOLD[data[base : offsets[b]]]
            own = offsets[a : b + 1] - base
            starts, ends, at = _words(piece, own)
            if len(starts) < 2:
                continue
            h = _pairs(span_hashes(piece, starts, ends))
            for size in self.groups:
                self._windows(size, h, starts, ends, at, own, out, a)
        return [self._merged(hits) for hits in out]

    def _windows(self, size, h, starts, ends, at, own, out, first_row) -> None:
        numbers = [n for n, length in enumerate(self.length) if length == size]
        known = np.unique(np.concatenate([self.sets[n] for n in numbers]))
        where = np.minimum(np.searchsorted(known, h), len(known) - 1)
        running = np.concatenate([[0], np.cumsum(known[where] == h)])
        width, stride = size + size // 2, max(1, size // 2)
        # windows start every ``stride`` words of a row; the last one may be shorter
        count = np.where(np.diff(at) >= 2, -(-np.maximum(np.diff(at) - 1, 1) // stride), 0)
        row = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        low = at[row] + nth * stride
        high = np.minimum(low + width, at[row + 1]) - 1  # shingles end one word earlier
        # a window with fewer shingles of templates than any verification asks for is no match
        need = min(int(np.ceil(self.least * len(self.sets[n]) - 1e-9)) for n in numbers)
        for i in np.flatnonzero(running[np.maximum(high, low)] - running[low] >= need).tolist():
            window = h[low[i] : high[i]]
            some = np.unique(window)
            hits = set().union(*(self.by_band.get(k, ()) for k in _bands(some).tolist()))
            for n in hits.intersection(numbers):
                found = self._occurrence(window, n)
                if found is None:
                    continue
                first, last, different, others = found
                begin = int(starts[low[i] + first] - own[row[i]])
                end = int(ends[low[i] + last + 1] - own[row[i]])
                out[first_row + row[i]].append((others, {
                    "license": self.names[n], "start": begin, "end": end,
                    "containment": different / len(self.sets[n]),
                }))

    def _occurrence(self, window: np.ndarray, n: int) -> tuple[int, int, int, int] | None:
        """First and last shingle of a template's occurrence in a window, how many different
        ones of the template lie between, if they are enough, and how many others.

        Each shingle of the template, as often as it is there, counts for a span, each
        other one against it, so that a span does not reach into the next copy. The first
        best one is taken.
        """
        template, times = self.sets[n], self.times[n]
        at = np.flatnonzero(np.isin(window, template))
        need = int(np.ceil(self.least * len(template) - 1e-9))
        kind = np.searchsorted(template, window[at])
        order = np.argsort(kind, kind="stable")
        nth = np.arange(len(at)) - np.searchsorted(kind[order], kind[order])

        def earlier(back: np.ndarray) -> np.ndarray:
            """Where the same shingle stood ``back`` occurrences before, -1 if it did not."""
            place = np.full(len(at), -1)
            some = nth >= back
            place[order[some]] = order[np.flatnonzero(some) - back[some]]
            return place

        last, surplus = earlier(np.ones(len(at), np.int64)), earlier(times[kind[order]])
        best, found = 0, None
        for s in range(len(at)):
            different = np.cumsum(last[s:] < s)
            if different[-1] < need:
                break
            own, length = np.cumsum(surplus[s:] < s), at[s:] - at[s] + 1
            worth = np.where(different >= need, 2 * own - length + len(window), 0)
            e = int(worth.argmax())
            if worth[e] > best:
                best, found = worth[e], (int(at[s]), int(at[s + e]), int(different[e]), int(length[e] - own[e]))
        return found

    @staticmethod
    def _merged(hits: list[tuple[int, dict]]) -> list[dict]:
        """Of overlapping occurrences of one licence the fullest (then with the fewest other
        shingles, shortest, first) stays."""
        kept: list[dict] = []

        def rank(found: tuple[int, dict]) -> tuple:
            others, x = found
            return -x["containment"], others, x["end"] - x["start"], x["start"], x["license"]

        for _, hit in sorted(hits, key=rank):
            if not any(k["license"] == hit["license"] and k["start"] < hit["end"] and hit["start"] < k["end"] for k in kept):
                kept.append(hit)
        return sorted(kept, key=lambda x: (x["start"], x["end"], x["license"]))


def find_licenses(text: Column, templates=TEMPLATES, least: float = LEAST) -> Column:
    """Array of (license, start, end, containment) of a text; spans are in UTF-8 bytes.

    Case and all but letters and digits are ignored. Null and empty texts have none.
    Copies of a note that follow one another are occurrences of their own.
    """

    @arrow_udf("array<struct<license:string,start:bigint,end:bigint,containment:double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(templates, least)
        kind = pa.list_(pa.struct([
            ("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())
        ]))
        for batch in batches:
            yield pa.array(scanner.scan(batch), kind)

    return run(F.coalesce(text, F.lit("")))
