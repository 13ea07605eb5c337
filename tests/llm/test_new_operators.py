"""Fill-in-middle, centroid clusters and line dedup, each against a slow version."""

import hashlib
import os
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cardlens.llm import centroid_clusters, fill_in_middle, line_dedup
from checks.compare import difference, sql_connection

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def random_mask(rng, n):
    """Stretches of scattered, dense, empty and full places."""
    parts = [rng.random(n // 4) < p for p in (0.01, 0.5, 0.0, 1.0)]
    rng.shuffle(parts)
    return np.concatenate(parts)


@pytest.mark.parametrize("n", [8, 400, 70_000, 400_000])
def test_boundary_set_selects(n):
    rng = np.random.default_rng(n)
    mask = random_mask(rng, n)
    mask[-1] = True
    places = fill_in_middle.BoundarySet(mask)
    members = np.flatnonzero(mask)
    assert len(places) == len(members)
    picked = range(len(members)) if n < 1_000 else [0, len(members) - 1, *rng.integers(0, len(members), 3_000).tolist()]
    assert all(places.select(k) == members[k] for k in picked)
    with pytest.raises(IndexError):
        places.select(len(members))


def test_boundary_set_uses_each_container():
    size = fill_in_middle.CHUNK
    sparse, dense, full = np.zeros(size, bool), np.arange(size) % 3 == 0, np.ones(size, bool)
    sparse[[5, 77, 1000]] = True
    places = fill_in_middle.BoundarySet(np.concatenate([sparse, dense, np.zeros(size, bool), full]))
    kinds = [type(c) for c in places.containers]
    assert kinds == [fill_in_middle.ArrayContainer, fill_in_middle.BitmapContainer, fill_in_middle.RunContainer]
    assert places.keys == [0, 1, 3] and places.select(len(places) - 1) == 4 * size - 1


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abZ <>PSM\nñ漢😀1", max_size=60))
def test_boundaries_are_units(text):
    places = fill_in_middle.boundaries(text)
    units = UNIT.findall(text)
    ends = np.cumsum([0] + [len(u) for u in units]).tolist()
    assert [places.select(k) for k in range(len(places))] == ends


def slow_fim(doc_id, text):
    """One row as the contract says it."""
    text = text or ""
    digest = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    rng = random.Random(3)
    texts = ["", None, " ", "\n", "a", "漢字 and 😀 words", "has <P> a sign", "<S>", "<M> <", "<", "<P", "<S <M", "x<", "1" * 70_000,
             "word " * 30_000, "é" * 200_000 + "<"]
    texts += ["".join(rng.choice("abcXYZ <>PSM.,\n😀") for _ in range(rng.randrange(200))) for _ in range(400)]
    rows = [(None if i % 97 == 50 else i - 3, t, i) for i, t in enumerate(texts)]
    rows += rows[5:9]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, at int").selectExpr("*", "'mine' AS form", "1 AS n")
    cut = df.select("at", "doc_id", "text", fill_in_middle.fill_in_middle(F.col("text"), F.col("doc_id")).alias("fim"))
    cut = cut.withColumn("back", fill_in_middle.restore(F.col("fim.output"), F.col("fim.form")))
    got = cut.collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r.fim) == slow_fim(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.fim.form for r in got} == {"plain", "psm", "spm"}
    empty = df.limit(0).select(fill_in_middle.fill_in_middle(F.col("text"), F.col("doc_id")).alias("fim"))
    assert empty.count() == 0


def slow_clusters(rows, clusters=16, rounds=3):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(64 * np.float64(np.float32(x)))) for x in v]))
    order = sorted(kept, key=lambda r: (sha("1:" + ("" if r[0] is None else str(r[0]))), r[1]))
    centroids = [list(q) for _, q in order[:clusters]]

    def assign():
        out = []
        for _, q in kept:
            far = [sum((a - b) ** 2 for a, b in zip(q, c)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        members = defaultdict(list)
        for (_, q), (c, _) in zip(kept, assign()):
            members[c].append(q)
        for c, m in members.items():
            centroids[c] = [sum(col) // len(m) for col in zip(*m)]
    last = assign()
    own = defaultdict(int)
    for c, d in last:
        own[c] += d
    return sorted(
        [(v, c, d, own[c], sum(own.values()), sha(",".join(map(str, centroids[c])))) for (v, _), (c, d) in zip(kept, last)],
        key=str,
    )


def odd_vectors(n=300, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, 64))
    x = centres[rng.integers(0, 9, n)] + rng.normal(scale=0.3, size=(n, 64))
    rows = [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, []), (1002, [1.0] * 63), (1003, [None] + [1.0] * 63), (1004, [float("nan")] * 64),
             (1005, [float("inf")] + [0.0] * 63), (1006, [0.0] * 64), (None, rows[0][1]), (None, rows[1][1]),
             (7, rows[0][1]), (7, rows[7][1]), (7, rows[7][1]), (1007, [-30_000.0] * 64), (1008, [1000.0, -1000.0] * 32)]
    return rows


def test_centroid_clusters(spark):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "'mine' AS cluster", "0 AS q")
    got = sorted(map(tuple, centroid_clusters.cluster_vectors(df).collect()), key=str)
    assert got == slow_clusters(rows)
    assert centroid_clusters.cluster_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [
    [(1, [0.5] * 64)] * 40,
    [(i, [float(i % 3)] * 64) for i in range(30)],
    [(i, [0.0] * 63 + [float(i)]) for i in range(5)],
])
def test_centroid_clusters_of_copies_and_few(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, centroid_clusters.cluster_vectors(df).collect()), key=str) == slow_clusters(rows)


def test_centroid_clusters_refuse_what_fits_no_long(spark):
    rows = [(1, [1e30] * 64), (2, [3e6] + [0.0] * 63), (3, [2e6] * 64), (4, [-2e6] * 64)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert [r.vec_id for r in centroid_clusters.cluster_vectors(df).orderBy("vec_id").collect()] == [3, 4]


def test_bounds_are_below_and_rule_out():
    rng = np.random.default_rng(1)
    x = (64 * (rng.normal(size=(16, 64)) * 3)[rng.integers(0, 16, 2_000)]).astype(np.int64)
    x += rng.integers(-20, 20, x.shape)
    centroids = x[rng.choice(2_000, 16, replace=False)]
    pivots = centroid_clusters.choose_pivots(centroids)
    cached = centroid_clusters.to_points(x, pivots.points)
    true = np.stack([centroid_clusters.squared(x, c) for c in centroids], axis=1)
    bounds = centroid_clusters.lower_bounds(cached, centroid_clusters.to_points(centroids, pivots.points), pivots)
    assert (bounds <= np.sqrt(true.astype(float))).all()
    cluster, best, visits = centroid_clusters.nearest(x, cached, centroids, pivots)
    assert (cluster == true.argmin(axis=1)).all() and (best == true.min(axis=1)).all()
    assert visits < x.shape[0] * 12


def slow_lines(rows, least_docs=3, least_chars=20):
    blanks = " \t\n\x0b\x0c\r"

    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(blanks))

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= least_chars:
                holders[key(line)].add(doc_id)
    common = {k: max(ids) for k, ids in holders.items() if len(ids) >= least_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or key(x) not in common or common[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def odd_lines():
    rng = random.Random(2)
    common = ["This line is in very many of the documents", "  Another COMMON line, padded with blanks\t\r", "short", "",
              "Ünïcode line that öccurs often enough", "exactly twenty chars", "only nineteen chars"]
    rows = []
    for i in range(120):
        lines = [rng.choice(common) if rng.random() < 0.6 else f"line {rng.randrange(90)} of some documents here" for _ in range(rng.randrange(9))]
        rows.append((i, "\n".join(x.upper() if rng.random() < 0.2 else x for x in lines)))
    rows += [(200, None), (201, ""), (202, "\n"), (203, "\n\n" + common[0] + "\n"), (204, (common[0] + "\n") * 5_000),
             (None, common[0]), (None, "\n".join(common)), (205, common[0]), (205, common[0]), (205, "x\n" + common[0]), rows[3], rows[3],
             (206, "x" * 300_000 + "\n" + common[0])]
    return rows


def test_line_dedup(spark):
    rows = odd_lines()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    clash = df.selectExpr("*", "'mine' AS n_lines", "'mine' AS lines", "'mine' AS t1", "'mine' AS positions", "'mine' AS keeper")
    got = line_dedup.drop_repeated_lines(clash)
    assert set(clash.columns) < set(got.columns) and got.filter("n_lines <> 'mine' OR positions <> 'mine'").count() == 0
    assert sorted(map(tuple, got.select("doc_id", "_n_lines", "n_dropped", "kept").collect()), key=str) == slow_lines(rows)
    assert line_dedup.drop_repeated_lines(df.limit(0)).count() == 0


def test_line_dedup_other_limits(spark):
    rows = odd_lines()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = line_dedup.drop_repeated_lines(df, least_docs=2, least_chars=5)
    assert sorted(map(tuple, got.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=str) == slow_lines(rows, 2, 5)


def test_texts_meet_dropped_lines_by_shuffle_of_plain_tables(spark):
    """No aggregate lies directly under the join that moves the texts."""
    df = spark.createDataFrame(odd_lines(), "doc_id bigint, text string")
    plan = line_dedup.drop_repeated_lines(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Join") == 1


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_centroid_clusters", "op13_line_dedup"])
def test_against_sql(spark, name):
    result = entry.queries()[name](spark, SF_DIR).toPandas()
    assert len(result) and difference(result, sql_connection(SF_DIR).sql(entry.oracle_sql()[name]).df()) is None
