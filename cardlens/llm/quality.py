"""Quality classifier: a generalised additive model with pairwise interactions.

The model is an intercept, one look-up table for each feature and one for each of a
few pairs of features, all over binned values. Tables are grown by boosting: in
each round every feature in turn gets a shallow tree fitted to the current errors,
whose leaves are added to the feature's table. Pairs follow in the same way, over
the features that explain most of what is left. A text's score is a sum of table
entries at its bins, which is one vectorised addition for each table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cardlens.llm.arrays import (
    byte_pieces, fold_case, row_of, row_slices, row_sums, span_hashes, text_bytes, words,
)

SCORED_BYTES = 1 << 18  # texts whose features are held at once

FEATURES = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "symbols", "stops",
    "line_breaks", "non_ascii", "pipes", "distinct_words", "repeated_neighbours",
    "most_frequent_word", "distinct_lines", "words_with_symbols",
)


def _table(chars: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[[ord(c) for c in chars]] = 1
    return table


_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_DIGIT = _table("0123456789")
_SYMBOL = _table("!#$%&*+/<=>@[\\]^_`{}~\"")
_STOP = _table(".,;:?")
_PIPE = _table("|")
_BREAK = _table("\n")
_NON_ASCII = np.r_[np.zeros(128, np.uint8), np.ones(128, np.uint8)]


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By row: number of different hashes, and how often the most frequent one occurs."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else []
    runs = np.diff(np.r_[new, len(h)]).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, row[new] if len(h) else row, runs)
    return np.bincount(row[new] if len(h) else row, minlength=n), most


def features(text: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text; null counts as empty, whose shares are 0."""
    data, offsets = text_bytes(text)
    out = np.zeros((len(text), len(FEATURES)))
    for first, last in row_slices(offsets):
        a, b = offsets[first], offsets[last]
        piece, own = data[a:b], offsets[first : last + 1] - a
        n = last - first
        starts, ends, at = words(piece, own)
        size, count = np.diff(own), np.diff(at)
        some, any_word = np.maximum(size, 1), np.maximum(count, 1)

        def share(table, piece=piece, own=own):
            return row_sums(table[piece], own)

        h = span_hashes(fold_case(piece), starts, ends)
        row = row_of(at)
        different, most = _distinct(row, h, n)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        breaks = np.flatnonzero(piece == 10)
        line_starts = np.union1d(own[:-1][size > 0], breaks + 1)
        line_starts = line_starts[line_starts < len(piece)]
        line_ends = np.r_[line_starts[1:], len(piece)][: len(line_starts)]
        line_row = np.searchsorted(own, line_starts, "right") - 1
        lines = np.bincount(line_row, minlength=n)
        own_lines, _ = _distinct(line_row, span_hashes(piece, line_starts, line_ends), n)
        odd = np.zeros(len(starts))
        if len(starts):
            sums = np.r_[0, np.cumsum(_SYMBOL[piece], dtype=np.int64)]
            odd = sums[ends] > sums[starts]
        out[first:last] = np.column_stack([
            np.log1p(size), np.log1p(count),
            row_sums(ends - starts, at) / any_word,
            share(_UPPER) / np.maximum(share(_LETTER), 1),
            share(_DIGIT) / some, share(_SYMBOL) / some, share(_STOP) / any_word,
            share(_BREAK) / any_word, share(_NON_ASCII) / some, share(_PIPE) / any_word,
            different / any_word, row_sums(same, at) / any_word, most / any_word,
            own_lines / np.maximum(lines, 1), row_sums(odd, at) / any_word,
        ])
    return out


@dataclass(frozen=True)
class AdditiveModel:
    """``edges`` cut each feature into bins; tables hold log odds by bin."""

    intercept: float
    edges: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int], ...]
    pair_tables: tuple[np.ndarray, ...]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)])

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[b[:, k]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[b[:, i], b[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Newton steps of a tree over ordered bins with gradients ``g`` and weights ``h``."""
    step = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 2:
        return step
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    gains[(left_h < 1) | (h.sum() - left_h < 1)] = 0
    cut = int(gains.argmax()) + 1
    if gains[cut - 1] <= 1e-9:
        return step
    return np.r_[_shallow_tree(g[:cut], h[:cut], depth - 1), _shallow_tree(g[cut:], h[cut:], depth - 1)]


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps over a grid: the best first cut along one axis, then one cut of
    each side along the other."""
    best, steps = 0.0, np.zeros_like(g)
    for axis in (0, 1):
        gg, hh = (g, h) if axis == 0 else (g.T, h.T)
        for cut in range(1, len(gg)):
            total, table = 0.0, np.empty_like(gg)
            for side in (slice(0, cut), slice(cut, None)):
                sg, sh = gg[side].sum(axis=0), hh[side].sum(axis=0)
                row = _shallow_tree(sg, sh, 1)
                table[side] = row
                for value in np.unique(row):
                    total += _gain(sg[row == value].sum(), sh[row == value].sum())
            total -= _gain(g.sum(), h.sum())
            if total > best:
                best, steps = total, (table if axis == 0 else table.T)
    return steps, best


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = 24, rounds: int = 120, pair_rounds: int = 20,
    max_pairs: int = 4, rate: float = 0.15,
) -> AdditiveModel:
    """Boost an additive model; one class only, or no rows, gives a constant score."""
    k = x.shape[1]
    edges = tuple(
        np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)
        for f in range(k)
    )
    mean = (y.sum() + 0.5) / (len(y) + 1.0)
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = AdditiveModel(float(np.log(mean / (1 - mean))), edges, tuple(tables), (), ())
    if len(np.unique(y)) < 2:
        return model
    b = model.bins(x)
    odds = np.full(len(x), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(k):
            g, h = slopes()
            size = len(tables[f])
            step = rate * _shallow_tree(
                np.bincount(b[:, f], g, size), np.bincount(b[:, f], h, size), depth=2
            )
            tables[f] += step
            odds += step[b[:, f]]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        shape = (len(tables[i]), len(tables[j]))
        return np.bincount(b[:, i] * shape[1] + b[:, j], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ranked = sorted(
        ((_pair_tree(grid(i, j, g), grid(i, j, h))[1], i, j) for i, j in combinations(range(k), 2)),
        reverse=True,
    )
    pairs = tuple((i, j) for gain, i, j in ranked[:max_pairs] if gain > 0)
    pair_tables = [np.zeros((len(tables[i]), len(tables[j]))) for i, j in pairs]
    for _ in range(pair_rounds):
        for (i, j), table in zip(pairs, pair_tables):
            g, h = slopes()
            step = rate * _pair_tree(grid(i, j, g), grid(i, j, h))[0]
            table += step
            odds += step[b[:, i], b[:, j]]
    return AdditiveModel(model.intercept, edges, tuple(tables), pairs, tuple(pair_tables))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 6000) -> AdditiveModel:
    """Fit on at most ``max_rows`` labelled documents, the same ones on every run.

    Labelled ids are dealt to ``max_rows`` cells by hash, and each cell gives one id.
    An id with conflicting labels counts as good where at least half of them say so;
    of several documents with one id, one is taken. Null ids and labels are left out.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    hashed = F.xxhash64("doc_id")
    voted = known.groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    chosen = (
        voted.groupBy(F.pmod(hashed, F.lit(max_rows)).alias("cell"))
        .agg(F.min_by(F.struct("doc_id", "quality"), F.struct(hashed, "doc_id")).alias("row"))
        .select("row.doc_id", (F.col("row.quality") >= 0.5).cast("int").alias("good"))
    )
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    @arrow_udf("array<double>")
    def vector(text: pa.Array) -> pa.Array:
        return pa.array(list(features(text)), pa.list_(pa.float64()))

    rows = (
        found.select("doc_id", "good", vector("text").alias("x"))
        .groupBy("doc_id").agg(F.min(F.struct("x", "good")).alias("row"))
        .select("doc_id", "row.x", "row.good").toPandas().sort_values("doc_id")
    )
    x = np.stack(rows.x.to_list()) if len(rows) else np.zeros((0, len(FEATURES)))
    return fit(x, rows.good.to_numpy(float))


def quality_score(text: Column, model: AdditiveModel) -> Column:
    """Score from 0 to 1 of a text; null is scored as empty, whatever its length."""

    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [model.score(features(part)) for part in byte_pieces(batch, SCORED_BYTES)]
            yield pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    return score(text)


def quality_stage(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Keep documents that score at least ``least``; columns are those of ``docs``."""
    model = train(docs, labels)
    return docs.filter(quality_score(F.col("text"), model) >= least)
