"""Language identification in two steps: the family first, then the language.

Features are relative frequencies of letter n-grams (one to three bytes of the
lower-cased text, everything but letters counting as one gap). A linear classifier
over frequencies scores a text as the mean of one table entry per n-gram, so whole
texts are scored by table look-ups and sums, without a vector per document.

Families are told apart by one linear support vector machine each (one against the
rest); inside the winning family every pair of languages has its own machine, and
the language with most won duels, then the largest sum of margins, is taken.

Machines only tell learned languages apart. Whether a text is like any of them is judged
by its likeness: the mean log ratio of the frequency its three-byte n-grams have in a
language to that by chance, for the most alike language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cardlens.llm.arrays import byte_pieces, row_slices, row_sums, text_bytes

UNKNOWN = "und"

# Families by ISO 639-1 code: fixed values. A code that is not here is a family by itself.
FAMILIES = {
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "germanic": ("af", "da", "de", "en", "is", "lb", "nb", "nl", "nn", "no", "sv"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "malayic": ("id", "ms"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "semitic": ("am", "ar", "he", "mt"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "turkic": ("az", "kk", "tr", "uz"),
    "uralic": ("et", "fi", "hu"),
}

BITS = 12  # n-grams of two and three bytes are hashed to so many bits each
DIMS = (256, 1 << BITS, 1 << BITS)
SLACK = 6.0  # by which the likeness of a single n-gram may miss the bound; less by the root of their number
STAGE_BYTES = 1 << 18  # texts that a filtering task looks at at once
PACKED = 64.0  # scale of frequencies sent as half floats

# Letters and bytes of longer characters count; all else is a gap.
_SYMBOL = np.zeros(256, np.uint32)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = np.arange(27, 155)


def family_of(lang: str) -> str:
    """Family of a language code; of "en-US" or "en_US" that of "en"."""
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in FAMILIES.items() if code in codes), code)


@dataclass(frozen=True)
class LanguageModel:
    """Tables of weights by n-gram order; ``pairs`` holds (language, language, row)."""

    families: tuple[str, ...]
    languages: tuple[tuple[str, ...], ...]  # by family
    pairs: tuple[tuple[tuple[int, int, int], ...], ...]  # by family
    weights: tuple[np.ndarray, ...]  # by order, one row for each machine
    bias: np.ndarray
    likeness: np.ndarray  # by language and hashed n-gram of order 3
    least_likeness: float


def _grams(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Index of the n-gram that begins at each byte, for orders 1 to 3; 0 is none."""
    s = _SYMBOL[data]
    out = [s]
    ends = offsets[1:][np.diff(offsets) > 0]
    code = s.astype(np.uint32)
    for order in (2, 3):
        code = code[:-1] * np.uint32(155) + s[order - 1 :]
        index = np.zeros(len(s), np.uint32)
        index[: len(code)] = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        for back in range(1, order):  # would reach into the next text
            index[np.maximum(ends - back, 0)] = 0
        out.append(index)
    return out


def _bounds(lower: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts, each between two gaps."""
    return text_bytes(pc.binary_join_element_wise(" ", pc.fill_null(lower, ""), " ", ""))


def _means(tables: list[np.ndarray], grams: list[np.ndarray], offsets: np.ndarray) -> np.ndarray:
    """Mean table entry by row and order, summed over the orders."""
    total = np.zeros(len(offsets) - 1)
    for table, index in zip(tables, grams):
        total += row_sums(table[index], offsets) / np.maximum(row_sums(index != 0, offsets), 1)
    return total


def _frequencies(lower: pa.Array) -> np.ndarray:
    """Frequency vectors of a few texts, for training."""
    data, offsets = _bounds(lower)
    rows = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        blocks = []
        for index, size in zip(_grams(data[a:b], np.array([0, b - a])), DIMS):
            counts = np.bincount(index, minlength=size)[:size].astype(np.float32)
            counts[0] = 0
            blocks.append(counts / max(counts.sum(), 1))
        rows.append(np.concatenate(blocks))
    return np.array(rows, np.float32).reshape(-1, sum(DIMS))


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, sweeps: int = 40, seed: int = 7):
    """Weights and bias of an L1-loss linear machine, by dual coordinate descent.

    ``y`` is +1 or -1. The smaller class costs more, so that both weigh the same. The
    weights are kept up to date, so memory is in proportion to the rows.
    """
    norms = np.array([float(row @ row) for row in x]) + 1  # the bias is a feature of value 1
    w, bias = np.zeros(x.shape[1]), 0.0
    positive = max((y > 0).sum(), 1)
    negative = max((y < 0).sum(), 1)
    most = np.where(y > 0, cost * len(y) / (2 * positive), cost * len(y) / (2 * negative))
    alpha = np.zeros(len(y))
    rng = np.random.default_rng(seed)
    for _ in range(sweeps):
        for i in rng.permutation(len(y)):
            new = min(max(alpha[i] - (y[i] * (x[i] @ w + bias) - 1) / norms[i], 0.0), most[i])
            if new != alpha[i]:
                by = (new - alpha[i]) * y[i]
                w += by * x[i]
                bias += by
                alpha[i] = new
    return w, bias


def sampled(rows: DataFrame, group: Column, per_group: int) -> DataFrame:
    """At most ``per_group`` different texts of each group: the same ones on every run.

    The texts are dealt to ``per_group`` cells by hash and each cell gives the one
    with the smallest hash. Copies count once, so a text with many copies neither
    fills the sample nor lands in one task.
    """
    hashed = rows.select(group.alias("group"), "text", F.xxhash64("text").alias("hash"))
    cells = hashed.groupBy("group", F.pmod("hash", F.lit(per_group)).alias("cell"))
    chosen = cells.agg(F.min("hash").alias("hash")).select("group", "hash")
    found = hashed.join(F.broadcast(chosen), ["group", "hash"])  # bounded by the sample's size
    return found.groupBy("group", "hash").agg(F.min("text").alias("text"))


def _log_ratios(frequencies: np.ndarray, letters: float) -> np.ndarray:
    """Log of the smoothed mean frequency of n-grams to that by chance; 0 for no n-gram."""
    size = frequencies.shape[1]
    mean = frequencies.mean(axis=0)
    mean = (mean * letters + 0.1) / (mean.sum() * letters + 0.1 * size)
    ratios = np.log(0.99 * size * mean + 0.01).astype(np.float32)
    ratios[0] = 0
    return ratios


def _likeness(x: np.ndarray, langs: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, float]:
    """Tables by language, and the likeness that is asked for.

    That is 0, no better than chance, or what all but a hundredth of the training texts
    reach when one half of a language's texts is judged by the other, if this is less.
    """
    tables, reached = [], []
    for name in sorted(set(langs)):
        own, size = x[langs == name], letters[langs == name]
        tables.append(_log_ratios(own, size.sum()))
        for half in (0, 1):
            judged, by = own[half::2], own[1 - half :: 2]
            if len(judged) and len(by):
                reached.append(judged @ _log_ratios(by, size[1 - half :: 2].sum()))
    least = float(np.quantile(np.concatenate(reached), 0.01)) if reached else -np.inf
    return np.array(tables), min(0.0, least)


def train(rows: DataFrame, per_language: int = 250) -> LanguageModel | None:
    """Fit on rows with ``text`` and ``lang``: at most ``per_language`` texts a language.

    Rows without language, text or any letter are left out. Returns None where none
    is left. The driver holds the sample: some 17 MB for 250 texts of a language.
    """
    usable = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sample = sampled(usable, F.col("lang"), per_language)

    @arrow_udf("binary")
    def vectors(text: pa.Array) -> pa.Array:
        return pa.array([v.astype(np.float16).tobytes() for v in _frequencies(text) * PACKED], pa.binary())

    got = sample.select(
        "group", "hash", vectors(F.lower("text")).alias("v"), F.length("text").alias("letters")
    ).toPandas()
    if not len(got):
        return None
    got = got.sort_values(["group", "hash"])
    x = np.stack([np.frombuffer(v, np.float16) for v in got.v]).astype(np.float32)
    cuts = np.cumsum((0,) + DIMS)
    likeness, least = _likeness(x[:, cuts[2] :] / PACKED, got.group.to_numpy(), got.letters.to_numpy(float))
    scale = []
    for a, b in zip(cuts[:-1], cuts[1:]):  # each order weighs the same
        norm = max(np.linalg.norm(x[:, a:b], axis=1).mean(), 1e-6)
        x[:, a:b] /= norm
        scale.append(PACKED / norm)
    langs = got.group.to_numpy()
    kind = np.array([family_of(v) for v in langs])
    families = tuple(sorted(set(kind)))
    rows_w, rows_b = [], []

    def machine(chosen: np.ndarray, positive: np.ndarray) -> int:
        w, b = linear_svm(x[chosen], np.where(positive[chosen], 1.0, -1.0))
        rows_w.append(w)
        rows_b.append(b)
        return len(rows_b) - 1

    everyone = np.ones(len(x), bool)
    for name in families:
        if len(families) > 1:
            machine(everyone, kind == name)
        else:
            rows_w.append(np.zeros(x.shape[1]))
            rows_b.append(1.0)
    languages, pairs = [], []
    for name in families:
        members = tuple(sorted(set(langs[kind == name])))
        languages.append(members)
        pairs.append(tuple(
            (i, j, machine(np.isin(langs, (members[i], members[j])), langs == members[i]))
            for i, j in combinations(range(len(members)), 2)
        ))
    w = np.array(rows_w)
    tables = []
    for order, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        table = w[:, a:b] * scale[order]
        table[:, 0] = 0
        tables.append(table.astype(np.float32))
    return LanguageModel(families, tuple(languages), tuple(pairs), tuple(tables), np.array(rows_b), likeness, least)


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(2 * margin, -30, 30)))


def predict(model: LanguageModel, lower: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language and score (probability-like, 0 to 1) of each lower-cased text."""
    data, offsets = _bounds(lower)
    names = np.empty(len(lower), object)
    scores = np.zeros(len(lower))
    for first, last in row_slices(offsets):
        a, b = offsets[first], offsets[last]
        own = offsets[first : last + 1] - a
        grams = _grams(data[a:b], own)

        def margins(row: int, grams=grams, own=own) -> np.ndarray:
            return _means([t[row] for t in model.weights], grams, own) + model.bias[row]

        by_family = np.stack([margins(k) for k in range(len(model.families))])
        family = by_family.argmax(axis=0)
        certain = _sigmoid(by_family.max(axis=0))
        for k, members in enumerate(model.languages):
            rows = np.flatnonzero(family == k)
            if not len(rows):
                continue
            mine = np.repeat(family == k, np.diff(own))
            part = [g[mine] for g in grams]
            cuts = np.concatenate([[0], np.cumsum(np.diff(own)[rows])])
            won = np.zeros((len(members), len(rows)))
            margin = np.zeros((len(members), len(rows)))
            least = np.ones((len(members), len(rows)))
            for i, j, row in model.pairs[k]:
                m = margins(row, part, cuts)
                won[i] += m >= 0
                won[j] += m < 0
                margin[i] += m
                margin[j] -= m
                least[i] = np.minimum(least[i], _sigmoid(m))
                least[j] = np.minimum(least[j], _sigmoid(-m))
            best = (won + np.tanh(margin) / 4).argmax(axis=0)
            names[first + rows] = np.array(members, object)[best]
            scores[first + rows] = certain[rows] * least[best, np.arange(len(rows))]
    return names, scores


def like_learned(model: LanguageModel, lower: pa.Array) -> np.ndarray:
    """Whether each lower-cased text is like some learned language; few n-grams tell little."""
    data, offsets = _bounds(lower)
    alike = np.zeros(len(lower), bool)
    for first, last in row_slices(offsets):
        own = offsets[first : last + 1] - offsets[first]
        index = _grams(data[offsets[first] : offsets[last]], own)[2]
        n = np.maximum(row_sums(index != 0, own), 1)
        best = np.max([row_sums(t[index], own) for t in model.likeness], axis=0) / n
        alike[first:last] = best >= model.least_likeness - SLACK / np.sqrt(n)
    return alike


def identify(text: Column, model: LanguageModel | None) -> Column:
    """Struct (lang_pred, score) of a text.

    A text that is null or has no letter is ``und`` with score 0; so is every text
    where there was nothing to learn from.
    """
    nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return nothing

    @arrow_udf("lang_pred string, score double")
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lower in batches:
            names, scores = predict(model, lower)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["lang_pred", "score"],
            )

    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return F.when(lettered, guess(F.lower(text))).otherwise(nothing)


def language_stage(docs: DataFrame, least: float = 0.05, held: Column | None = None) -> DataFrame:
    """Keep the documents that are like a learned language, known with a score of at least ``least``.

    Columns are those of ``docs``. Learns from the rows of ``docs`` with a language
    (those where ``held`` is not true). Rows that are null or without letters go.
    Repeated rows are each judged; where no row has a language to learn from, all
    rows with letters stay, as nothing speaks against them.
    """
    known = docs if held is None else docs.filter(~F.coalesce(held, F.lit(False)))
    model = train(known.select("text", "lang"))
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))

    # one function for both questions, so that texts and model are in a worker once
    @arrow_udf("boolean")
    def sure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [
                (predict(model, lower)[1] >= least) & like_learned(model, lower)
                for lower in byte_pieces(batch, STAGE_BYTES)
            ]
            yield pa.array(np.concatenate([np.zeros(0, bool), *parts]), pa.bool_())

    return docs.filter(F.col("text").rlike(r"\p{L}") & sure(F.lower("text")))
