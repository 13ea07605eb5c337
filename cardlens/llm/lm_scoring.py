"""Scoring whole documents with a gated recurrent language model.

The output is factored by classes: P(word) = P(class | state) * P(word | class). The
most frequent words fill classes of equal size, whose words are told apart by a second
softmax on the state. All other words fall into classes by spelling (their last
letters), where a word's share is its smoothed count. Exact counts of the whole
training corpus are made by Spark, so the vocabulary may grow with the input; the
network stays as it is.

Training goes once through all training documents, in a few rounds. In a round every
task runs truncated backpropagation over its documents from the same weights, and the
weights are averaged by the number of words seen. Documents lie one after another in
lanes that advance together; the state is carried from window to window and set to
zero where a document begins.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.arrays import (
    fold_case, mixed, row_slices, row_sums, span_hashes, text_bytes, words,
)
from cardlens.sources.scratch import store

HEAD_CLASSES = 16
CLASS_WORDS = 16
HEAD = HEAD_CLASSES * CLASS_WORDS
TAILS = 24  # spelling classes
END = HEAD + TAILS  # the end of a document, also what stands before its first word
SYMBOLS = END + 1
CLASSES = HEAD_CLASSES + TAILS + 1

HIDDEN = 16
WINDOW = 16  # steps of truncated backpropagation
UPDATE_WORDS = 2048  # words whose gradients make one step
ROUNDS = 3
CHUNK = 2_000_000  # words laid into lanes together
COMMON_WORDS = 300_000  # most frequent words whose counts go to every task: some 5 MB
_LN10 = np.log(10.0)


@dataclass
class Vocabulary:
    """``common``: sorted hashes of frequent words, with counts and symbols (0 to HEAD + TAILS).

    ``tail_log``: log10 of the size of each spelling class, unknown word included.
    """

    common: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    tail_log: np.ndarray
    head_counts: np.ndarray
    tail_counts: np.ndarray
    ends: int
    total: int
    different: int


def _spelling(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Spelling class of words: a hash of the last three letters (bytes above 64)."""
    letters = np.flatnonzero(data > 64)
    last = np.searchsorted(letters, ends) - 1
    code = np.zeros(len(starts), np.uint64)
    for back in range(3):
        at = np.maximum(last - back, 0)
        where = letters[at] if len(letters) else np.zeros(len(starts), np.int64)
        inside = (last - back >= 0) & (where >= starts)
        code = code * np.uint64(257) + np.where(inside, data[where] if len(data) else 0, 0).astype(np.uint64)
    return (mixed(code) % np.uint64(TAILS)).astype(np.int16)


def _read(text: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By slice of rows: first row, words by row, different hashes, their spelling class,
    and for each word its place among the different ones."""
    data, offsets = text_bytes(text)
    for first, last in row_slices(offsets):
        piece = fold_case(data[offsets[first] : offsets[last]])
        starts, ends, at = words(piece, offsets[first : last + 1] - offsets[first])
        h, some, back = np.unique(span_hashes(piece, starts, ends), return_index=True, return_inverse=True)
        yield first, at, h, _spelling(piece, starts[some], ends[some]), back


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def merged() -> tuple:
        h = np.concatenate([x[0] for x in held])
        n = np.concatenate([x[1] for x in held])
        kind = np.concatenate([x[2] for x in held])
        h, some, back = np.unique(h, return_index=True, return_inverse=True)
        return h, np.bincount(back, n, len(h)).astype(np.int64), kind[some]

    def batch(part: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(part[0].view(np.int64)), pa.array(part[1]), pa.array(part[2])], ["h", "n", "kind"]
        )

    for b in batches:
        for _, _, h, kind, back in _read(b.column(0)):
            if len(h):
                held.append((h, np.bincount(back, minlength=len(h)), kind))
                size += len(h)
        if size > 3_000_000:
            held = [merged()]
            size = len(held[0][0])
            if size > 1_500_000:
                yield batch(held[0])
                held, size = [], 0
    if held:
        yield batch(merged())


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, kind, n): hash, spelling class and count of every word of all texts."""
    rows = texts.mapInArrow(_word_counts, "h bigint, n bigint, kind smallint")
    return rows.groupBy("h").agg(F.min("kind").alias("kind"), F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, documents: int, common_words: int = COMMON_WORDS) -> tuple[Vocabulary, int]:
    """What tasks need of the stored ``counts``, and the count from which a word is common."""
    level = F.floor(F.log2("n") * 4).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).toPandas()
    levels = levels.sort_values("level", ascending=False)
    fit = levels[levels.words.cumsum() <= common_words]
    least = int(fit.level.min()) if len(fit) else 1 << 20
    common = counts.filter(level >= least).select("h", "n", "kind").toArrow()  # at most common_words
    h, n, kind = (common.column(c).to_numpy() for c in ("h", "n", "kind"))
    h = h.astype(np.int64).view(np.uint64)
    smallest = int(n.min()) if len(n) else 1 << 62
    kinds = counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("words")).toPandas()
    first = np.lexsort((h, -n.astype(np.int64)))[:HEAD]  # by count, then hash
    symbols = HEAD + kind.astype(np.int64)
    symbols[first] = np.arange(len(first))
    order = np.argsort(h)
    tail_n, tail_v = np.zeros(TAILS), np.zeros(TAILS)
    tail_n[kinds.kind.to_numpy(int)] = kinds.n
    tail_v[kinds.kind.to_numpy(int)] = kinds.words
    np.subtract.at(tail_n, kind[first].astype(int), n[first])
    np.subtract.at(tail_v, kind[first].astype(int), 1.0)
    head_counts = np.zeros(HEAD)
    head_counts[: len(first)] = n[first]
    return Vocabulary(
        common=h[order],
        counts=n[order].astype(np.float64),
        symbols=symbols[order].astype(np.int16),
        tail_log=np.log10(tail_n + tail_v + 1),
        head_counts=head_counts,
        tail_counts=tail_n + tail_v + 1,
        ends=documents,
        total=int(kinds.n.sum()) + documents,
        different=int(kinds.words.sum()) + (1 if documents else 0),
    ), smallest


_CLASS_OF = np.concatenate([
    np.repeat(np.arange(HEAD_CLASSES), CLASS_WORDS), HEAD_CLASSES + np.arange(TAILS), [CLASSES - 1]
])


class Network:
    """Gated recurrent unit with two output softmaxes; weights in one flat float32 array."""

    SHAPES = {
        "x": (SYMBOLS, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
        "wc": (HIDDEN, CLASSES), "bc": (CLASSES,),
        "wi": (HEAD_CLASSES, HIDDEN, CLASS_WORDS), "bi": (HEAD_CLASSES, CLASS_WORDS),
    }
    SIZE = sum(int(np.prod(s)) for s in SHAPES.values())

    def __init__(self, flat: np.ndarray):
        self.flat = np.array(flat, np.float32)
        self.p = self._views(self.flat)

    @classmethod
    def _views(cls, flat: np.ndarray) -> dict[str, np.ndarray]:
        views, at = {}, 0
        for name, shape in cls.SHAPES.items():
            size = int(np.prod(shape))
            views[name] = flat[at : at + size].reshape(shape)
            at += size
        return views

    @classmethod
    def fresh(cls, v: Vocabulary, seed: int = 3) -> Network:
        """Small random weights; the biases already give the frequencies of the corpus."""
        rng = np.random.default_rng(seed)
        net = cls(rng.normal(0, 0.1, cls.SIZE))
        by_class = np.concatenate([
            v.head_counts.reshape(HEAD_CLASSES, CLASS_WORDS).sum(axis=1), v.tail_counts, [v.ends]
        ]) + 1
        net.p["b"][:] = 0
        net.p["bc"][:] = np.log(by_class / by_class.sum())
        net.p["bi"][:] = np.log(v.head_counts.reshape(HEAD_CLASSES, CLASS_WORDS) + 1)
        net.p["wc"] *= 0.5
        net.p["wi"] *= 0.5
        return net

    def window(self, h: np.ndarray, x: np.ndarray, target: np.ndarray, begin: np.ndarray, learn: bool):
        """Run (steps, lanes) inputs from state ``h``.

        Gives the new state, the natural log probability of each target symbol (for a
        spelling class that of the class), and gradients if ``learn``. Targets below 0
        are gaps.
        """
        p = self.p
        steps, lanes = x.shape
        states = np.empty((steps, lanes, HIDDEN), np.float32)
        table = p["x"] + p["b"]
        if learn:
            befores, gates_z, gates_r, reset, news = np.empty((5, steps, lanes, HIDDEN), np.float32)
        for t in range(steps):
            if begin[t].any():
                h = np.where(begin[t][:, None], np.float32(0), h)
            a = table[x[t]]
            u = h @ p["u"]
            gates = a[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN]
            np.tanh(gates, out=gates)  # (1 + tanh(a)) / 2 is the logistic function of 2 a
            gates += 1
            gates *= 0.5
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            un = u[:, 2 * HIDDEN :]
            n = r * un
            n += a[:, 2 * HIDDEN :]
            np.tanh(n, out=n)
            if learn:
                befores[t], gates_z[t], gates_r[t], reset[t], news[t] = h, z, r, un, n
            h = n + z * (h - n)
            states[t] = h
        flat = states.reshape(-1, HIDDEN)
        wanted = target.reshape(-1)
        real = wanted >= 0
        symbol = np.where(real, wanted, END)
        kind = _CLASS_OF[symbol]
        line = np.arange(len(flat))
        logits = flat @ p["wc"] + p["bc"]
        logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        total = e.sum(axis=1)
        logp = logits[line, kind] - np.log(total)
        if learn:
            grad = {k: np.zeros_like(v) for k, v in p.items()}
            d = e / total[:, None]
            d[line, kind] -= 1
            d[~real] = 0
            grad["wc"] = flat.T @ d
            grad["bc"] = d.sum(axis=0)
            d_flat = d @ p["wc"].T
        head = np.flatnonzero(real & (symbol < HEAD))
        head = head[np.argsort(kind[head], kind="stable")]
        cuts = np.searchsorted(kind[head], np.arange(HEAD_CLASSES + 1))
        for c in range(HEAD_CLASSES):
            rows = head[cuts[c] : cuts[c + 1]]
            if not len(rows):
                continue
            own = flat[rows]
            lg = own @ p["wi"][c] + p["bi"][c]
            lg -= lg.max(axis=1, keepdims=True)
            ex = np.exp(lg)
            s = ex.sum(axis=1)
            nth = symbol[rows] - c * CLASS_WORDS
            k = np.arange(len(rows))
            logp[rows] += lg[k, nth] - np.log(s)
            if learn:
                d = ex / s[:, None]
                d[k, nth] -= 1
                grad["wi"][c] = own.T @ d
                grad["bi"][c] = d.sum(axis=0)
                d_flat[rows] += d @ p["wi"][c].T
        logp[~real] = 0
        if not learn:
            return h, logp.reshape(steps, lanes), None
        d_states = d_flat.reshape(steps, lanes, HIDDEN)
        # factors that do not depend on the gradient, for all steps at once
        by_n = (1 - gates_z) * (1 - news * news)
        by_z = 2 * (befores - news) * gates_z * (1 - gates_z)
        by_r = 2 * reset * gates_r * (1 - gates_r)
        d_h = np.zeros((lanes, HIDDEN), np.float32)
        d_a = np.empty((steps, lanes, 3 * HIDDEN), np.float32)
        d_u = np.empty((steps, lanes, 3 * HIDDEN), np.float32)
        back = np.ascontiguousarray(p["u"].T)
        for t in range(steps - 1, -1, -1):
            d_h = d_h + d_states[t]
            own = d_u[t]
            d_n = d_h * by_n[t]
            np.multiply(d_h, by_z[t], out=own[:, :HIDDEN])
            np.multiply(d_n, by_r[t], out=own[:, HIDDEN : 2 * HIDDEN])
            np.multiply(d_n, gates_r[t], out=own[:, 2 * HIDDEN :])
            d_a[t, :, 2 * HIDDEN :] = d_n
            d_h = d_h * gates_z[t] + own @ back
            if begin[t].any():
                d_h = np.where(begin[t][:, None], np.float32(0), d_h)
        d_a[:, :, : 2 * HIDDEN] = d_u[:, :, : 2 * HIDDEN]
        grad["u"] = befores.reshape(-1, HIDDEN).T @ d_u.reshape(-1, 3 * HIDDEN)
        d_a = d_a.reshape(-1, 3 * HIDDEN)
        grad["b"] = d_a.sum(axis=0)
        inputs = x.reshape(-1)
        order = np.argsort(inputs, kind="stable")
        some, at = np.unique(inputs[order], return_index=True)
        grad["x"][some] = np.add.reduceat(d_a[order], at, axis=0)
        return h, logp.reshape(steps, lanes), np.concatenate(
            [grad[k].reshape(-1) for k in self.SHAPES]
        ).astype(np.float32, copy=False)


def _lanes(symbols: np.ndarray, offsets: np.ndarray, lanes: int):
    """Lay documents into lanes, longest first, each to the shortest lane.

    Gives target symbols (steps, lanes) with -1 for gaps, inputs, begins, and for each
    word its step and lane.
    """
    sizes = np.diff(offsets)
    heap = [(0, k) for k in range(lanes)]
    start, lane = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        used, k = heapq.heappop(heap)
        start[i], lane[i] = used, k
        heapq.heappush(heap, (used + int(sizes[i]), k))
    steps = max(used for used, _ in heap)
    step = np.arange(len(symbols)) - np.repeat(offsets[:-1] - start, sizes)
    where = np.repeat(lane, sizes)
    target = np.full((steps, lanes), -1, np.int16)
    target[step, where] = symbols
    x = np.full((steps, lanes), END, np.int16)
    x[1:] = np.where(target[:-1] >= 0, target[:-1], END)
    begin = np.zeros((steps, lanes), bool)
    begin[start, lane] = True
    x[begin] = END
    return target, x, begin, step, where


def _windows(target: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Windows of steps with the lanes that still have words; longer ones for few lanes."""
    last = np.where((target >= 0).any(axis=0), len(target) - (target[::-1] >= 0).argmax(axis=0), 0)
    t = 0
    while t < len(target):
        live = np.flatnonzero(last > t)
        size = int(np.clip(2 * UPDATE_WORDS // max(len(live), 1), WINDOW, 16 * WINDOW))
        yield slice(t, t + size), live
        t += size


def _symbols(text: pa.Array, v: Vocabulary):
    """By slice: first row, offsets, symbols, known counts (0 if not common) and hashes.

    Every row has one item more than words: its end.
    """
    for first, at, h, kind, back in _read(text):
        place = np.minimum(np.searchsorted(v.common, h), max(len(v.common) - 1, 0))
        found = v.common[place] == h if len(v.common) else np.zeros(len(h), bool)
        symbol = np.where(found, v.symbols[place] if len(v.common) else 0, HEAD + kind.astype(np.int64)).astype(np.int16)
        count = np.where(found, v.counts[place] if len(v.common) else 0.0, 0.0)
        rows = len(at) - 1
        offsets = at + np.arange(rows + 1)
        n = offsets[-1]
        is_end = np.zeros(n, bool)
        is_end[offsets[1:] - 1] = True
        s, c, u = np.full(n, END, np.int16), np.full(n, float(v.ends)), np.zeros(n, np.uint64)
        s[~is_end], c[~is_end], u[~is_end] = symbol[back], count[back], h[back]
        yield first, offsets, s, c, u


def _chunks(slices: Iterator[tuple], limit: int = CHUNK) -> Iterator[list]:
    held, size = [], 0
    for item in slices:
        held.append(item)
        size += len(item[2])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _joined(held: list) -> tuple[np.ndarray, np.ndarray]:
    symbols = np.concatenate([x[2] for x in held])
    sizes = np.concatenate([np.diff(x[1]) for x in held])
    return symbols, np.concatenate([[0], np.cumsum(sizes)])


def _train_task(batches: Iterator[pa.RecordBatch], v, start: np.ndarray, rate: float) -> Iterator[pa.RecordBatch]:
    net = Network(start)
    m, s = np.zeros(net.SIZE, np.float32), np.zeros(net.SIZE, np.float32)
    total = np.zeros(net.SIZE, np.float32)
    updates = seen = count = 0

    def update(share: float) -> None:
        nonlocal total, updates
        total /= count
        total *= min(1.0, 1.0 / max(float(np.sqrt((total * total).sum())), 1e-9))
        updates += 1
        m[:] += 0.1 * (total - m)
        s[:] += 0.01 * (total * total - s)
        step = share * rate * min(1.0, updates / 20)
        net.flat -= step * (m / (1 - 0.9**updates)) / (np.sqrt(s / (1 - 0.99**updates)) + 1e-5)
        total[:] = 0

    slices = (x for b in batches for x in _symbols(b.column(0), v.value))
    for held in _chunks(slices):
        symbols, offsets = _joined(held)
        if not len(symbols):
            continue
        lanes = int(np.clip(len(symbols) // (WINDOW * 100), 4, 256))
        target, x, begin, _, _ = _lanes(symbols, offsets, lanes)
        h = np.zeros((lanes, HIDDEN), np.float32)
        for cut, live in _windows(target):
            h[live], _, g = net.window(h[live], x[cut][:, live], target[cut][:, live], begin[cut][:, live], True)
            total += g
            count += int((target[cut][:, live] >= 0).sum())
            if count < UPDATE_WORDS:  # few lanes left: a long document alone must not set the course
                continue
            update(1.0)
            count = 0
        seen += len(symbols)
    if count:  # what is left makes a smaller step
        update(min(1.0, count / UPDATE_WORDS))
    if seen:
        yield pa.RecordBatch.from_arrays(
            [pa.array([float(seen)]), pa.array([net.flat.astype(np.float64)], pa.list_(pa.float64()))], ["words", "weights"]
        )


def train(texts: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after one pass over all ``texts``: each text is in one round, by its hash."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast(v)  # at most COMMON_WORDS entries
    weights = Network.fresh(v).flat
    for k in range(rounds):
        part = texts.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k)
        run = partial(_train_task, v=shared, start=weights, rate=0.01 / (1 + 2 * k))
        trained = part.mapInArrow(run, "words double, weights array<double>")
        each = trained.select("words", F.posexplode("weights").alias("i", "w"))
        mean = each.groupBy("i").agg((F.sum(F.col("words") * F.col("w")) / F.sum("words")).alias("w"))
        got = mean.toPandas().sort_values("i")  # one row for each weight
        if len(got):
            weights = got.w.to_numpy().astype(np.float32)
    return weights


def _score_task(batches: Iterator[pa.RecordBatch], v, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    voc: Vocabulary = v.value
    net = Network(weights)
    base_row = TaskContext.get().partitionId() << 40
    row = 0

    def slices():
        for b in batches:
            ids = b.column("doc_id")
            for first, offsets, s, c, u in _symbols(b.column("text"), voc):
                yield ids.slice(first, len(offsets) - 1), offsets, s, c, u

    for held in _chunks(slices()):
        symbols, offsets = _joined(held)
        count = np.concatenate([x[3] for x in held])
        hashes = np.concatenate([x[4] for x in held])
        longest = int(np.diff(offsets).max())
        lanes = int(np.clip(len(symbols) // max(longest, 256), 4, 1024))
        target, x, begin, step, where = _lanes(symbols, offsets, lanes)
        logp = np.zeros(target.shape, np.float32)
        h = np.zeros((lanes, HIDDEN), np.float32)
        for cut, live in _windows(target):
            h[live], got, _ = net.window(h[live], x[cut][:, live], target[cut][:, live], begin[cut][:, live], False)
            logp[cut.start : cut.start + len(got), live] = got
        tail = (symbols >= HEAD) & (symbols < END)
        log_count = np.log10(count + 1)
        model = logp[step, where] / _LN10
        model[tail] += log_count[tail] - voc.tail_log[symbols[tail] - HEAD]
        rare = tail & (count == 0)
        ids = pa.concat_arrays([c for x in held for c in ([x[0]] if isinstance(x[0], pa.Array) else x[0].chunks)])
        rows = len(offsets) - 1
        cuts = np.concatenate([[0], np.cumsum(row_sums(rare, offsets))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashes[rare].view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(base_row + row + np.arange(rows)), ids, pa.array(np.diff(offsets)),
                pa.array(row_sums(count > 0, offsets).astype(np.int64)), pa.array(row_sums(log_count, offsets)),
                pa.array(row_sums(model, offsets)), lists,
            ],
            ["row", "doc_id", "n_tokens", "known", "log_counts", "model", "rare"],
        )
        row += rows


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) by row of ``docs``.

    Learns from the rows where ``held_out`` is not true. A null text is an empty one: just
    its end. ``score`` is the model's log10 probability of all words and the end, of a word
    that training lacks that of one such word of its spelling class. Repeated rows are each
    counted and scored. With nothing to learn from, counts are 0 and both scores are those
    of a uniform guess.
    """
    flagged = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                          F.coalesce(held_out, F.lit(False)).alias("held_out"))
    learning = flagged.filter(~F.col("held_out")).select("text")
    counts = store(word_counts(learning), "word-counts")
    v, least = vocabulary(counts, learning.count())
    weights = train(learning, v)
    shared = docs.sparkSession.sparkContext.broadcast(v)
    scored = store(
        flagged.select("doc_id", "text").mapInArrow(
            partial(_score_task, v=shared, weights=weights),
            "row bigint, doc_id bigint, n_tokens bigint, known bigint, log_counts double, model double, rare array<bigint>",
        ),
        "scored",
    )
    # counts of the words that are not common, by a join
    rare = scored.select("row", F.explode("rare").alias("h")).join(counts.filter(F.col("n") < least), "h")
    found = rare.groupBy("row").agg(
        F.count("*").alias("more_known"), F.sum(F.log10(F.col("n") + 1)).alias("more_log")
    )
    more_log = F.coalesce("more_log", F.lit(0.0))
    unit = float(np.log10(v.total + v.different + 1))
    done = scored.drop("rare").join(found, "row", "left").select(
        "doc_id", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(v.total).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") + more_log - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("model") + more_log).alias("score"),
    )
    return done
