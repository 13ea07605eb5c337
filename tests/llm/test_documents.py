"""Language, quality, mixing, pieces, licences and language model on small and odd tables."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardlens.llm import (
    arrays, language_id, license_scan, lm_scoring, mixing, quality, sentencepiece_codec,
)

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def test_words_and_hashes():
    texts = ["Ab ab\tAB", "", None, "é x", " y\x0bz", "a" * 50]
    data, offsets = arrays.text_bytes(pa.array(texts))
    data = arrays.fold_case(data)
    starts, ends, at = arrays.words(data, offsets)
    got = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert got == [w for t in texts for w in split(t)]
    assert np.diff(at).tolist() == [len(split(t)) for t in texts]
    h = arrays.span_hashes(data, starts, ends)
    assert h[0] == h[1] == h[2] and len(set(h.tolist())) == len(set(got))


def test_language(spark, odd_docs, no_docs):
    model = language_id.train(odd_docs.select("text", "lang"))
    guess = language_id.identify(F.col("text"), model)
    got = {r.text: (r.g.lang_pred, r.g.score) for r in odd_docs.select("text", guess.alias("g")).collect()}
    for nothing in (None, "", " \n\t ", "123 !?"):
        assert got[nothing] == ("und", 0.0)
    known = odd_docs.filter("doc_id < 40").collect()
    assert sum(got[r.text][0] == r.lang for r in known) >= 0.95 * len(known)
    assert all(0 <= s <= 1 for _, s in got.values())
    kept = language_id.language_stage(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 4
    assert language_id.language_stage(no_docs).count() == 0
    assert language_id.train(odd_docs.filter("doc_id = 100").select("text", "lang")) is None


def test_language_stage_drops_what_is_like_no_language(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.filter(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    rng = np.random.default_rng(0)
    gibberish = [
        " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 9))) for _ in range(60))
        for _ in range(20)
    ]
    unlearned = [
        "Vanha kettu juoksi metsän läpi ja hyppäsi laiskan koiran yli, koska yöllä oli kylmä ja susi odotti kivien takana.",
        "Szybki brązowy lis przeskoczył nad leniwym psem i uciekł przed starym szarym wilkiem w ciemną noc nad rzeką.",
        "Быстрая коричневая лиса перепрыгнула через ленивую собаку и убежала от старого серого волка ночью.",
    ]
    odd = spark.createDataFrame([(-1 - i, v, None) for i, v in enumerate(gibberish + unlearned)], docs.schema)
    kept = language_id.language_stage(docs.unionByName(odd)).select("doc_id")
    assert kept.filter("doc_id < 0").count() == 0
    assert kept.filter("doc_id >= 0").count() >= 0.99 * docs.count()


def test_linear_machine_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0.1, 1.0, -1.0)
    w, b = language_id.linear_svm(x, y, cost=100.0, sweeps=200)
    assert (np.sign(x @ w + b) == y).mean() > 0.97


def test_quality(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 1), 0) for i in range(40)] + [(None, 1, 0), (5, None, 0), (0, 0, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    model = quality.train(odd_docs, labels)
    got = odd_docs.select("doc_id", quality.quality_score(F.col("text"), model).alias("q")).collect()
    assert all(r.q is not None and 0 <= r.q <= 1 for r in got)
    kept = quality.quality_stage(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    assert quality.quality_stage(no_docs, labels).count() == 0
    one_class = quality.train(odd_docs, labels.filter("quality = 1"))
    assert one_class.score(np.zeros((1, len(quality.FEATURES))))[0] > 0.5
    nothing = quality.train(odd_docs, labels.limit(0))
    assert nothing.score(np.zeros((1, len(quality.FEATURES))))[0] == 0.5


def test_additive_model_learns_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000], rounds=20, pair_rounds=40)
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9
    # one score by hand
    b = [int(np.searchsorted(e, v, "right")) for e, v in zip(model.edges, x[0])]
    odds = model.intercept + sum(t[k] for t, k in zip(model.tables, b))
    odds += sum(t[b[i], b[j]] for (i, j), t in zip(model.pairs, model.pair_tables))
    assert model.score(x[:1])[0] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_targets_by_resharing(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, "d": 3, "e": 0, None: 70}
    rows = [(k, v) for k, v in sizes.items()]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size bigint")).collect()}
    names = sorted(k for k in sizes if k is not None) + [None]
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
    target, left, free = {}, sum(sizes.values()), set(names)
    while free:  # share, cap, share again what is above
        level = left / sum(weight[k] for k in free)
        above = {k for k in free if level * weight[k] > 3 * sizes[k]}
        for k in above or free:
            target[k] = 3 * sizes[k] if above else level * weight[k]
            left -= target[k]
        free -= above or free
    assert got == pytest.approx(target)


def test_mixing(spark, odd_docs, no_docs):
    first = mixing.with_copies(odd_docs)
    assert first.columns == [*odd_docs.columns, "mix"] or first.columns[-1] == "mix"
    docs = odd_docs.drop("mix")
    rows = mixing.with_copies(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.mix.size == len(split(r.text)) and 0 <= r.mix.copies <= 3 for r in rows)
    again = mixing.with_copies(docs.repartition(3)).collect()
    key = lambda r: (str(r.doc_id), str(r.text), r.mix.copies)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.count() == sum(r.mix.copies for r in rows)
    assert mixing.mix(no_docs).count() == 0


MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(sentencepiece_codec.PieceModel.load(MODEL))


def test_pieces_equal_the_library(codec):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=MODEL)
    texts = ["", " ", "  a  b ", "hello wörld\n\n\tx\x00", "漢字かな 😀 ☃ ▁x", "a" * 300, "https://x.org/a?b=1&c=22",
             "    indented();\n  if (x) {", "Ĳﬁ ½"]
    rng = np.random.default_rng(0)
    letters = list("ab cdehilmnorstéß日, .\n")
    texts += ["".join(rng.choice(letters, int(n))) for n in rng.integers(0, 60, 300)]
    ids = codec.encode(pa.array(texts)).to_pylist()
    assert ids == [library.encode(t) for t in texts]
    back = codec.decode(pa.array(ids, pa.list_(pa.int32()))).to_pylist()
    assert back == [t.replace("▁", " ") for t in texts]
    assert back == [library.decode(i).replace("▁", " ") for i in ids]


def test_unigram_is_the_best_path():
    M = sentencepiece_codec
    pieces = {"▁": -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "▁a": -3.2, "ba": -4.1, "bab": -6.0, "▁ab": -7.5}
    names = ["<unk>", *pieces]
    model = M.PieceModel(names, np.array([0.0, *pieces.values()], np.float32), np.array([2] + [1] * len(pieces)), M.UNIGRAM)
    codec = M.Codec(model)

    def brute(word):
        if not word:
            return 0.0, []
        options = []
        for n in range(1, len(word) + 1):
            if word[:n] in pieces:
                rest = brute(word[n:])
                options.append((pieces[word[:n]] + rest[0], [names.index(word[:n])] + rest[1]))
        return max(options, key=lambda x: x[0]) if options else (-math.inf, [])

    for text in ("ab", "abab", "bab", "babab", "a b ab", "aabbab"):
        best = [brute("▁" + w) for w in text.split()]
        got = codec.encode(pa.array([text])).to_pylist()[0]
        score = sum([0.0, *pieces.values()][i] for i in got)
        assert score == pytest.approx(sum(b[0] for b in best))
        assert codec.decode(pa.array([got], pa.list_(pa.int32()))).to_pylist() == [text]
    assert codec.encode(pa.array(["xy"])).to_pylist()[0] == [names.index("▁"), 0]


def test_new_words_take_few_searches(codec, monkeypatch):
    rng = np.random.default_rng(1)
    letters = list("etaoinshrdlucmfw" * 3 + "gypbvkxqzéß日")
    words = ["".join(rng.choice(letters, int(n))) for n in rng.integers(2, 14, 30_000)]
    searched = []
    search = np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *more: searched.append(np.size(v)) or search(a, v, *more))
    texts = [" ".join(words[k : k + 100]) for k in range(0, len(words), 100)]
    codec.encode(pa.array(texts))
    assert sum(searched) < 15 * sum(map(len, texts))
    assert len(searched) < 500


@pytest.mark.parametrize("kind", ["BPE", "UNIGRAM"])
def test_pieces_do_not_depend_on_parts_or_what_is_remembered(kind, monkeypatch):
    M = sentencepiece_codec
    model = M.PieceModel.load(MODEL)
    model.algorithm = getattr(M, kind)
    rng = np.random.default_rng(2)
    letters = list("aab cdeilnorstéß日漢▁\n")
    texts = ["".join(rng.choice(letters, int(n))) for n in rng.integers(0, 80, 60)]
    texts += ["ab" * 200, "日本語漢字" * 30, "", None, "=" * 150 + " ==", "x" + " " * 90 + "y"]
    whole = M.Codec(model).encode(pa.array(texts))
    for name, less in (("SEGMENTED", 40), ("MERGED", 100), ("REMEMBERED_BITS", 4), ("REMEMBERED_WORDS", 50), ("SLICE", 200)):
        monkeypatch.setattr(M, name, less)
    codec = M.Codec(model)
    assert codec.encode(pa.array(texts)).equals(whole)
    assert codec.encode(pa.array(texts[::-1])).to_pylist() == whole.to_pylist()[::-1]


def test_pieces_there_and_back(spark):
    texts = [None, "", "  a  b ", "日本" * 5, "Ab\n\tc ▁x"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    codec = sentencepiece_codec.SentencePiece(MODEL)
    rows = docs.select("text", codec.round_trip(F.col("text")).alias("b"), codec.encode(F.col("text")).alias("ids")).collect()
    assert [r.text for r in rows] == texts
    assert all(r.b.ids == r.ids and r.b.decoded == (r.text and r.text.replace("▁", " ")) for r in rows)
    assert docs.filter("doc_id < 0").select(codec.round_trip(F.col("text"))).count() == 0


def test_pieces_stage(spark, odd_docs, no_docs):
    got = sentencepiece_codec.sentencepiece_stage(odd_docs, MODEL).collect()
    assert len(got) == odd_docs.count()
    assert {r.doc_id: r.n_tokens for r in got}[100] == 0
    assert all(r.ids is None or r.n_tokens == len(r.ids) for r in got)
    assert sentencepiece_codec.sentencepiece_stage(no_docs, MODEL).count() == 0


def test_licences(spark, odd_docs):
    notes = ["Released under the MIT License.", "all rights RESERVED", "Licensed under the Apache License, Version 2.0",
             "licensed under\nCC BY-NC 4.0", "nothing to see", None, "", "x " * 500 + "All rights reserved. " + "y " * 500]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(notes)], "doc_id int, text string")
    got = {r.doc_id: r.m for r in df.select("doc_id", license_scan.find_licenses(F.col("text")).alias("m")).collect()}
    assert [[m.license for m in got[i]] for i in range(8)] == [
        ["MIT"], ["All rights reserved"], ["Apache-2.0"], ["CC-BY-NC-4.0"], [], [], [], ["All rights reserved"]]
    hit = got[7][0]
    assert notes[7].encode()[hit.start:hit.end] == b"All rights reserved" and hit.containment == 1.0
    # every template in the midst of other words, at all offsets
    scanner = license_scan.Scanner()
    for name, text in license_scan.TEMPLATES:
        long = [("filler text here " * k) + text + " more words follow" for k in range(8)]
        assert all(name in [m["license"] for m in found] for found in scanner.scan(pa.array(long)))


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_language_model(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text")
    flag = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7, F.lit(-1)) == 2
    got = lm_scoring.score_documents(docs, flag).collect()
    rows = docs.collect()
    counts, ends = Counter(), 0
    for r in rows:
        if r.doc_id is None or not held(r.doc_id):
            counts.update(split(r.text))
            ends += 1
    total, different = sum(counts.values()) + ends, len(counts) + 1
    assert len(got) == len(rows)
    expected = Counter()
    for r in rows:
        c = [counts[w] for w in split(r.text)] + [ends]
        base = sum(math.log10((x + 1) / (total + different + 1)) for x in c)
        expected[(r.doc_id, len(c), sum(x > 0 for x in c), total, round(base, 4))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == expected
    assert all(r.score < 0 for r in got)
    assert lm_scoring.score_documents(no_docs, flag).count() == 0
    alone = lm_scoring.score_documents(docs.filter("doc_id = 7"), F.lit(True)).first()
    assert alone.n_known == 0 and alone.base_score == 0 and alone.train_tokens == 0


def test_network_is_not_narrowed():
    assert lm_scoring.HIDDEN >= 16
    assert lm_scoring.Network.SHAPES["u"] == (lm_scoring.HIDDEN, 3 * lm_scoring.HIDDEN)


def test_network_gradient():
    rng = np.random.default_rng(0)
    net = lm_scoring.Network(rng.normal(0, 0.3, lm_scoring.Network.SIZE))
    net.flat = net.flat.astype(np.float64)
    net.p = net._views(net.flat)
    x = rng.integers(0, lm_scoring.SYMBOLS, (6, 5))
    target = rng.integers(-1, lm_scoring.SYMBOLS, (6, 5))
    begin = rng.random((6, 5)) < 0.2
    h = np.zeros((5, lm_scoring.HIDDEN))
    g = net.window(h, x, target, begin, True)[2]
    for i in rng.choice(np.flatnonzero(np.abs(g) > 1e-2), 20):
        old = net.flat[i]
        loss = []
        for step in (1e-2, -1e-2):
            net.flat[i] = old + step
            loss.append(-net.window(h, x, target, begin, False)[1].sum())
        net.flat[i] = old
        assert (loss[0] - loss[1]) / 2e-2 == pytest.approx(g[i], rel=0.05, abs=5e-3)


def test_network_probabilities_and_carried_state():
    rng = np.random.default_rng(2)
    net = lm_scoring.Network(rng.normal(0, 0.4, lm_scoring.Network.SIZE))
    h = np.zeros((1, lm_scoring.HIDDEN), np.float32)
    x = np.array([[5]])
    begin = np.zeros((1, 1), bool)
    p = [np.exp(net.window(h, x, np.array([[s]]), begin, False)[1][0, 0]) for s in range(lm_scoring.SYMBOLS)]
    assert sum(p) == pytest.approx(1, abs=1e-4)
    # windows of any length give the same document
    symbols = rng.integers(0, lm_scoring.END, 50).astype(np.int16)
    target, inputs, begins, step, where = lm_scoring._lanes(symbols, np.array([0, 20, 50]), 1)
    whole = net.window(h, inputs, target, begins, False)[1]
    state, parts = h, []
    for t in range(0, len(target), 7):
        state, logp, _ = net.window(state, inputs[t:t + 7], target[t:t + 7], begins[t:t + 7], False)
        parts.append(logp)
    assert np.allclose(np.concatenate(parts), whole, atol=1e-4)
