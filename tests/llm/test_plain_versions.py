"""Operators beside plain versions of themselves, and every query as it is registered."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cardlens.llm import arrays, jaccard_join, language_id, license_scan, lm_scoring, quality
from tests.llm.test_documents import split
from tests.llm.test_pairs import brute

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

ODD_TEXTS = [
    None, "", " ", "\n", "\n\n a \n", "one", "One one ONE two", "a|b|c\nline\nline\n", "ünï çödé £5 and more, yes; no: why?",
    "$x = {y} <- f(x) | 1 2 3\n\n", "The end. The end. The end.", "tab\tand\vvertical\ffeed\rreturn", "x" * 3000,
    "word " * 500 + "\nlast",
]


# --- quality features ----------------------------------------------------------


def plain_features(text):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0d]+", data)
    folded = [w.lower() for w in words]
    lines = re.findall(rb"[^\n]*\n|[^\n]+", data)
    size, n = max(len(data), 1), max(len(words), 1)

    def count(chars):
        return sum(data.count(c.encode()) for c in chars)

    upper = sum(65 <= c <= 90 for c in data)
    letters = upper + sum(97 <= c <= 122 for c in data)
    symbols = "!#$%&*+/<=>@[\\]^_`{}~\""
    return [
        math.log1p(len(data)), math.log1p(len(words)), sum(map(len, words)) / n, upper / max(letters, 1),
        count("0123456789") / size, count(symbols) / size, count(".,;:?") / n, count("\n") / n,
        sum(c >= 128 for c in data) / size, count("|") / n, len(set(folded)) / n,
        sum(a == b for a, b in zip(folded, folded[1:])) / n, max(Counter(folded).values(), default=0) / n,
        len(set(lines)) / max(len(lines), 1), sum(any(s.encode() in w for s in symbols) for w in words) / n,
    ]


def test_quality_features_equal_a_plain_version():
    got = quality.features(pa.array(ODD_TEXTS, pa.string()))
    assert got.shape == (len(ODD_TEXTS), len(quality.FEATURES))
    for text, row in zip(ODD_TEXTS, got):
        assert row == pytest.approx(plain_features(text), abs=1e-12), text


# --- languages -----------------------------------------------------------------


def plain_margin(model, row, lower):
    data = [0] + [c - 96 if 97 <= c <= 122 else c - 101 if c >= 128 else 0 for c in lower.encode()] + [0]
    total = float(model.bias[row])
    for order, table in enumerate(model.weights, 1):
        entries = []
        for i in range(len(data) - order + 1):
            code = 0
            for s in data[i:i + order]:
                code = code * 155 + s
            index = code if order == 1 else ((code * 2654435761) & 0xFFFFFFFF) >> (32 - language_id.BITS)
            if index:
                entries.append(float(table[row][index]))
        total += sum(entries) / max(len(entries), 1)
    return total


def plain_guess(model, lower):
    def sure(margin):
        return 1 / (1 + math.exp(-2 * margin))

    families = [plain_margin(model, k, lower) for k in range(len(model.families))]
    family = families.index(max(families))
    members = model.languages[family]
    won, margins, least = Counter(), Counter(), dict.fromkeys(range(len(members)), 1.0)
    for i, j, row in model.pairs[family]:
        m = plain_margin(model, row, lower)
        won[i if m >= 0 else j] += 1
        margins[i] += m
        margins[j] -= m
        least[i], least[j] = min(least[i], sure(m)), min(least[j], sure(-m))
    best = max(range(len(members)), key=lambda i: (won[i], margins[i]))
    return members[best], sure(max(families)) * least[best]


def test_languages_equal_a_plain_version(spark, odd_docs):
    model = language_id.train(odd_docs.select("text", "lang"))
    texts = [r.text.lower() for r in odd_docs.filter("doc_id < 12").collect()] + ["oui", "ja und nein", "ñandú über"]
    names, scores = language_id.predict(model, pa.array(texts))
    for text, name, score in zip(texts, names, scores):
        want, certain = plain_guess(model, text)
        assert name == want and score == pytest.approx(certain, abs=1e-4)


def test_families():
    assert language_id.family_of("en-US") == language_id.family_of("EN_gb") == "germanic"
    assert language_id.family_of("zh") != language_id.family_of("ja")
    codes = [c for own in language_id.FAMILIES.values() for c in own]
    assert len(codes) == len(set(codes))


def test_linear_machine_reaches_the_dual_optimum():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 6)).astype(np.float32)
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=40) > 0, 1.0, -1.0)
    w, b = language_id.linear_svm(x, y, cost=1.0, sweeps=400)
    each = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + (each * np.maximum(0, 1 - y * (x @ w + b))).sum()

    best = loss(w, b)
    for _ in range(200):
        assert loss(w + rng.normal(0, 0.05, 6), b + rng.normal(0, 0.05)) >= best - 1e-3


# --- language model ------------------------------------------------------------


def plain_log10(net, voc, words, kinds):
    """log10 probability of one document, one word at a time."""
    size, p, x, total = lm_scoring.HIDDEN, net.p, lm_scoring.END, 0.0
    h = np.zeros(size)
    for word in [*words, None]:
        if word is None:
            symbol, c = lm_scoring.END, None
        else:
            at = np.searchsorted(voc.common, word)
            known = at < len(voc.common) and voc.common[at] == word
            symbol = int(voc.symbols[at]) if known else lm_scoring.HEAD + int(kinds[word])
            c = float(voc.counts[at]) if known else 0.0
        a, u = p["x"][x] + p["b"], h @ p["u"]
        z, r = ((1 + np.tanh(a[k * size:(k + 1) * size] + u[k * size:(k + 1) * size])) / 2 for k in (0, 1))
        n = np.tanh(a[2 * size:] + r * u[2 * size:])
        h = z * h + (1 - z) * n
        classes = h @ p["wc"] + p["bc"]
        heads = lm_scoring.HEAD_CLASSES
        kind = symbol // lm_scoring.CLASS_WORDS if symbol < lm_scoring.HEAD else heads + symbol - lm_scoring.HEAD
        total += (classes[kind] - np.log(np.exp(classes).sum())) / math.log(10)
        if symbol < lm_scoring.HEAD:
            inside = h @ p["wi"][kind] + p["bi"][kind]
            total += (inside[symbol % lm_scoring.CLASS_WORDS] - np.log(np.exp(inside).sum())) / math.log(10)
        elif symbol < lm_scoring.END:  # the smoothed share of the word in its spelling class
            total += math.log10(c + 1) - voc.tail_log[symbol - lm_scoring.HEAD]
        x = symbol
    return total


def test_scores_equal_a_plain_recurrence(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vocabulary = [f"{a}{b}" for a in ("ab", "cde", "x", "long") for b in range(150)]
    texts = [" ".join(rng.choice(vocabulary, int(n), p=np.arange(600, 0, -1) / 180300)) for n in rng.integers(0, 300, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    seen = {}

    def fixed(learning, v, rounds=None):
        weights = lm_scoring.Network.fresh(v).flat + np.random.default_rng(1).normal(0, 0.3, lm_scoring.Network.SIZE)
        seen.update(v=v, net=lm_scoring.Network(weights))
        return seen["net"].flat

    monkeypatch.setattr(lm_scoring, "train", fixed)
    got = {r.doc_id: r.score for r in lm_scoring.score_documents(docs, F.col("doc_id") % 3 == 0).collect()}
    for i, text in enumerate(texts):
        words, kinds = [], {}
        for w in split(text):
            data = np.frombuffer(w.encode(), np.uint8)
            ends = np.array([len(data)])
            h = arrays.span_hashes(data, np.array([0]), ends)[0]
            words.append(h)
            kinds[h] = lm_scoring._spelling(data, np.array([0]), ends)[0]
        assert got[i] == pytest.approx(plain_log10(seen["net"], seen["v"], words, kinds), rel=1e-4, abs=1e-3)


def test_few_words_train_as_well(spark):
    docs = spark.createDataFrame([(f"some few words {i % 3}",) for i in range(30)], "text string").coalesce(1)
    counts = lm_scoring.word_counts(docs)
    v, _ = lm_scoring.vocabulary(counts, 30)
    assert np.abs(lm_scoring.train(docs, v) - lm_scoring.Network.fresh(v).flat).max() > 0


# --- licences ------------------------------------------------------------------


def test_band_probability():
    scanner = license_scan.Scanner()
    for words, pairs in zip(scanner.length, scanner.sets):
        assert license_scan.band_probability(words, len(pairs)) > 0.999


@pytest.mark.parametrize("between", [" ", "\n", " . ", " something else entirely "])
def test_stacked_licences(between):
    scanner = license_scan.Scanner()
    for name, note in license_scan.TEMPLATES:
        for copies in range(1, 6):
            for before in ("", "filler ", "more filler text here "):
                text = before + between.join([note] * copies) + " and what follows"
                found = scanner.scan(pa.array([text]))[0]
                step = len(note) + len(between)
                want = [(name, len(before) + i * step, len(before) + i * step + len(note.rstrip("."))) for i in range(copies)]
                assert [(m["license"], m["start"], m["end"]) for m in found] == want
                assert all(m["containment"] == 1.0 for m in found)


def test_damaged_note_beside_a_whole_one():
    note = license_scan.TEMPLATES[3][1]
    text = note.replace("General ", "") + " " + note
    found = license_scan.Scanner().scan(pa.array([text]))[0]
    assert [m["license"] for m in found] == ["GPL-3.0"] * 2
    assert found[0]["start"] == 0 and found[0]["containment"] < 1 and found[1]["containment"] == 1.0


# --- Jaccard join --------------------------------------------------------------


def bucket(word):
    data = np.frombuffer(word.encode(), np.uint8)
    return int(arrays.span_hashes(data, np.array([0]), np.array([len(data)]))[0] >> np.uint64(48))


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_group_of_one_prefix_is_not_paired_throughout(spark, monkeypatch, k, percent):
    """Hundreds of texts of one prefix and size; few link, and few are paired."""
    rng = np.random.default_rng(6)
    passage = [f"rare{i}" for i in range(20 if percent == 80 else 14)]
    tail = [f"frequent{i}" for i in range(k - 1)]
    sizes = [n for n in range(30, 200) if n - -(-percent * n // 100) + 1 == len(passage)]
    n = sizes[0] + k - 1 - len(passage) - len(tail)
    rare = {bucket(w) for w in passage}
    words = iter([w for w in (f"w{v}" for v in rng.integers(0, 1 << 40, 401 * n)) if bucket(w) not in rare])
    texts = [" ".join(passage + tail + [next(words) for _ in range(n)]) for _ in range(400)]
    texts += [t.rsplit(" ", 1)[0] + f" other{i}" for i, t in enumerate(texts[:5])]

    def order(texts, k):  # shingles with words of the passage first
        by_word = np.full(jaccard_join.BUCKETS, 7, np.uint64)
        by_word[list(rare)] = 0
        return by_word, np.zeros(jaccard_join.BUCKETS, np.uint64)

    asked = []
    verified = jaccard_join._verified

    def counted(docs, classes, pairs, *args, **kwargs):
        asked.append(pairs.count())
        return verified(docs, classes, pairs, *args, **kwargs)

    monkeypatch.setattr(jaccard_join, "shingle_order", order)
    monkeypatch.setattr(jaccard_join, "_verified", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in jaccard_join.jaccard_components(df, k, percent).collect()}
    sets, want = brute(texts, k, percent)
    assert [got[i].component_id for i in range(len(texts))] == want
    assert sum(asked) < 2 * len(texts)  # all pairs would be some 80,000


def test_hub_with_many_pairs(spark, monkeypatch):
    """Pairs of one hub are spread over copies of its set."""
    monkeypatch.setattr(jaccard_join, "HUB_PAIRS", 4)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1:]) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 4, 85)[1]


# --- queries as registered -----------------------------------------------------

CONTRACTS = {
    "op1_sentencepiece": "doc_id n_tokens ids_hash round_trip",
    "op2_language_id": "doc_id held_out:boolean lang_pred:string score:double",
    "op4_jaccard_join": "doc_id n_shingles:bigint component_id",
    "op5_lm_scoring": "doc_id held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
    "op7_license_scan": "doc_id n_matches:bigint",
    "op8_ann_forest": "query_id:bigint rank:int vec_id:bigint score:double",
    "op9_embedding_dedup": "vec_id n_links:bigint component_id:bigint kept:boolean",
    "op10_quality": "doc_id held_out:boolean score:double predicted:int",
}
HELD_OUT = {"op2_language_id": (5, 0), "op5_lm_scoring": (7, 2), "op10_quality": (3, 1)}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", list(CONTRACTS))
def test_registered_query(spark, name):
    result = entry.queries()[name](spark, SF_DIR)
    types = dict(result.dtypes)
    for column in CONTRACTS[name].split():
        column, _, kind = column.partition(":")
        assert types[column] == (kind or types[column])
    rows = result.toPandas()
    if name.startswith("op8"):
        vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
        assert rows.query_id.nunique() == vectors.filter("vec_id % 100 = 0").count()
        return
    table = "embeddings" if name.startswith("op9") else "documents"
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    if name in HELD_OUT:
        divisor, rest = HELD_OUT[name]
        assert all((zlib.crc32(str(i).encode()) % divisor == rest) == h for i, h in zip(rows.doc_id, rows.held_out))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_pipeline_as_registered(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert 0 < rows.count() <= 3 * spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
