"""Jaccard join, components, vectors, conversations and the pipeline."""

import os
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cardlens.llm import ann_forest, chat_format, embedding_dedup, jaccard_join
from cardlens.llm.tables import union_find
from checks.compare import difference, sql_connection
from tests.llm.test_documents import split

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


def components(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_union_find(spark):
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(60)] + [tuple(map(int, e)) for e in rng.integers(100, 200, (60, 2))] + [(300, 300)]
    got = {r.node: r.component for r in union_find(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = components(301, edges)
    assert all(want[k] == v for k, v in got.items())
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}
    assert union_find(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute(texts, k, percent):
    sets = []
    for t in texts:
        w = split(t)
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    edges = [
        (i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
        and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return sets, components(len(sets), edges)


def near_copies():
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(6):
        base = list(rng.choice(vocabulary, 120))
        texts.append(" ".join(base))
        for _ in range(7):  # a family of near copies, some links only over others
            copy = list(base if rng.random() < 0.5 else texts[-1].split())
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(len(copy)))] = f"x{rng.integers(1000)}"
            texts.append(" ".join(copy))
    passage = " ".join(rng.choice(vocabulary, 60))
    texts += [" ".join(rng.choice(vocabulary, 70)) + " " + passage for _ in range(6)]
    texts += ["one two", "One two", "one two three", "", None, " \n", "a b c d", "A B C D", texts[0], texts[0].upper().lower()]
    return texts


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_jaccard(spark, k, percent):
    texts = near_copies()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets, want = brute(texts, k, percent)
    got = {r.doc_id: r for r in jaccard_join.jaccard_components(df, k, percent).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == want


def test_jaccard_stage(spark, odd_docs, no_docs):
    kept = jaccard_join.jaccard_stage(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = odd_docs.collect()
    _, own = brute([r.text for r in rows], 5, 80)
    groups = defaultdict(list)
    for r, c in zip(rows, own):
        groups[c if split(r.text) else ("empty", id(r))].append(r)
    got = kept.collect()
    assert len(got) == len(groups)
    ids = sorted(str(min((r.doc_id for r in g if r.doc_id is not None), default=None)) for g in groups.values())
    assert sorted(str(r.doc_id) for r in got) == ids
    assert jaccard_join.jaccard_stage(no_docs).count() == 0
    assert jaccard_join.jaccard_components(no_docs).count() == 0


def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 16))
    near = base[:40] + rng.normal(scale=0.03, size=(40, 16))
    x = [list(map(float, v)) for v in np.vstack([base, near, base[:1], base[:1]])]
    rows = list(enumerate(x))
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [float("inf")] + [1.0] * 15),
           (904, [None] + [1.0] * 15), (905, [1.0, 2.0]), (906, [])]
    schema = "vec_id bigint, embedding array<double>, label string, copies string, v string"
    full = [(i, v, "same", "mine", "mine") for i, v in rows + odd]
    return spark.createDataFrame(full, schema), rows, odd


def test_nearest(spark):
    df, rows, _ = vectors(spark)
    got = defaultdict(list)
    result = ann_forest.nearest(df, F.col("vec_id") % 10 == 0)
    for r in result.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    x, found = np.array([v for _, v in rows]), 0
    asked = [i for i, _ in rows if i % 10 == 0]
    assert sorted(got) == asked
    for i in asked:
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((np.arange(len(d)), d)) if j != i][:10]
        assert [r for r, _, _ in got[i]] == list(range(1, 11))
        assert all(s == pytest.approx(d[j], abs=1e-12) for _, j, s in got[i])
        found += len(set(order) & {j for _, j, _ in got[i]})
    assert found >= 0.9 * 10 * len(asked)
    assert [j for _, j, _ in got[0]][:2] == [340, 341]  # exact copies first, the smaller id before
    few = ann_forest.nearest(df.filter("vec_id in (0, 1, 2, 900)"), F.col("vec_id") == 0).collect()
    assert len(few) == 2
    assert ann_forest.nearest(df.limit(0), F.lit(True)).count() == 0
    # small shards and blocks give the same contract
    small = ann_forest.nearest(df, F.col("vec_id") % 10 == 0, shard_rows=50)
    assert small.count() == 10 * len(asked)


def test_near_vectors(spark):
    df, rows, odd = vectors(spark)
    result = embedding_dedup.near_duplicates(df)
    got = {r.vec_id: r for r in result.collect()}
    assert len(got) == len(rows) + len(odd)
    x = np.array([v for _, v in rows])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = u @ u.T >= 0.95
    np.fill_diagonal(close, False)
    want = components(len(rows), np.argwhere(close))
    true = close.sum()
    assert all(got[i].n_links <= close[i].sum() for i in range(len(rows)))
    assert sum(got[i].n_links for i in range(len(rows))) >= 0.9 * true
    assert sum(got[i].component_id == want[i] for i in range(len(rows))) >= 0.98 * len(rows)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in odd)
    assert embedding_dedup.recall(df.filter(F.size("embedding") == 16), result) >= 0.9
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_shared_and_missing_ids(spark):
    """Vectors of one id are vectors of their own, and rows without id link with nothing."""
    near = [0.999, 0.01]
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, near), (3, [-1.0, 0.2]), (4, [0.01, 0.999]), (4, [0.01, 0.999]),
            (5, [0.7, 0.71]), (5, [0.71, 0.7]), (None, [1.0, 0.0]), (None, None), (6, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df.filter("vec_id IS NOT NULL")).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 1, 1, False), (4, 1, 1, False),
                   (5, 1, 5, True), (5, 1, 5, True), (6, 2, 1, False)]
    lone = [tuple(r) for r in embedding_dedup.near_duplicates(df).filter("vec_id IS NULL").collect()]
    assert lone == [(None, 0, None, True)] * 2
    found = defaultdict(list)
    for r in ann_forest.nearest(df, F.col("vec_id") <= 5, k=3).orderBy("score", "vec_id").collect():
        found[r.query_id].append((r.vec_id, round(r.score, 6)))
    assert found[1].count((6, 0.0)) == 1 and (4, round(float(np.hypot(0.01, 0.001)), 6)) in found[1]
    assert len(found[1]) == len(found[5]) == 6 and len(found[4]) == 3  # two vectors ask for 1 and 5, one for 4
    assert (5, round(float(np.hypot(0.01, 0.01)), 6)) in found[5]
    missing = df.filter("vec_id IS NULL")
    assert embedding_dedup.near_duplicates(missing).count() == 2
    assert ann_forest.nearest(missing, F.lit(True)).count() == 0


def test_margin_is_widened_until_the_audit_is_content(spark, monkeypatch):
    """A margin that is far too narrow costs another search, not links."""
    monkeypatch.setattr(embedding_dedup, "CLUSTER_ROWS", 12)
    monkeypatch.setattr(embedding_dedup, "OVERLAP", 1)
    monkeypatch.setattr(embedding_dedup, "MARGIN", 0.0)
    tried = []
    monkeypatch.setattr(embedding_dedup, "_margins", lambda size: tried.append(1) or [(0.0, False), (1.0, False), (1.0, True)])
    rng = np.random.default_rng(3)
    one, shift = rng.normal(size=(2, 200, 24))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    shift -= (shift * one).sum(axis=1, keepdims=True) * one
    shift /= np.linalg.norm(shift, axis=1, keepdims=True)
    x = np.vstack([one, 0.951 * one + np.sqrt(1 - 0.951**2) * shift])
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    close = x @ x.T >= 0.95
    np.fill_diagonal(close, False)
    assert [got[i] for i in range(400)] == close.sum(axis=1).tolist() and tried


def test_large_part_is_cut(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PART_ROWS", 40)
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(1, 16)) + rng.normal(scale=0.02, size=(150, 16)), rng.normal(size=(50, 16))])
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert all(got[i].n_links >= 0.9 * 149 and got[i].component_id == 0 for i in range(150))


def test_links_found_once_count_for_both(spark):
    found = spark.createDataFrame(
        [(1, [2, 3], 1), (2, [], 1), (3, [], 1), (1, [2], 1), (2, [5], 2)],  # of three tasks
        "node bigint, larger array<bigint>, root bigint",
    )
    placed = spark.createDataFrame([(1, 1), (2, 1), (3, 4), (5, 1)], "node bigint, copies bigint")
    got = {r.node: r.links for r in embedding_dedup._links(found, placed).collect()}
    assert got == {1: 1 + 4, 2: 2, 3: 1, 5: 1}


def test_chain_in_one_batch_stays_connected():
    at = np.deg2rad([0.0, 24.0, 12.0])  # the third links the first two
    v = pa.array([[np.cos(a), np.sin(a)] for a in at], pa.list_(pa.float64()))
    near = pa.array([[1, 2], [0, 2], [0, 1]], pa.list_(pa.int64()))
    column = {"cluster": [0] * 3, "node": [0, 1, 2], "v": v, "copies": [1] * 3, "homes": [[0]] * 3}
    got = embedding_dedup._find(pa.table(column | {"near": near}), pa.table(column), 0.95)
    got = {r["node"]: r for r in got.to_pylist()}
    assert {k: r["larger"] for k, r in got.items()} == {0: [2], 1: [2], 2: []}
    assert {r["root"] for r in got.values()} == {0}


def test_neighbours_meet_whatever_the_number_of_clusters(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CLUSTER_ROWS", 12)
    rng = np.random.default_rng(3)
    one, shift = rng.normal(size=(2, 300, 32))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    shift -= (shift * one).sum(axis=1, keepdims=True) * one
    shift /= np.linalg.norm(shift, axis=1, keepdims=True)
    x = np.vstack([one, 0.951 * one + np.sqrt(1 - 0.951**2) * shift])
    centers = embedding_dedup.centroids(x, 50)
    met = embedding_dedup.reach(x[:300], centers, 0.95)[np.arange(300), (x[300:] @ centers.T).argmax(axis=1)]
    assert met.all()
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    close = x @ x.T >= 0.95
    np.fill_diagonal(close, False)
    assert [got[i].n_links for i in range(600)] == close.sum(axis=1).tolist()
    missing = spark.createDataFrame([(i, 0) for i in range(600)], "vec_id bigint, n_links bigint")
    assert embedding_dedup.recall(df, missing) == 0


def test_preferences(spark):
    turns = [(0, 0, "system", "be nice"), (0, 1, "user", "hi"), (0, 2, "assistant", "hello"),
             (1, 0, "system", "be nice"), (1, 1, "user", "hi"), (1, 2, "assistant", "go"), (1, 3, "user", "away"),
             (2, 0, "user", None), (5, 1, "assistant", "b"), (5, 0, None, "a"), (None, 0, "user", "x"),
             (6, 0, "user", "q"), (7, 0, "user", "q"), (7, 1, "assistant", "r"), (7, 1, "assistant", "r")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    pairs = chat_format.preference_pairs(chat_format.neighbouring_pairs(df))
    got = {r.pair_id: r for r in pairs.collect()}
    assert sorted(got) == [0, 1, 2, 3]
    r = got[0]
    assert r.prompt_turns == 2 and r.prompt == "<|im_start|>system\nbe nice<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n"
    assert [r.chosen[s.start:s.end] for s in r.chosen_spans] == ["hello<|im_end|>"]
    assert [r.rejected[s.start:s.end] for s in r.rejected_spans] == ["go<|im_end|>"]
    assert got[1].rejected is None and got[1].prompt == "" and got[1].chosen == "<|im_start|>user\n<|im_end|>\n"
    assert got[2].chosen is None and got[2].rejected.startswith("<|im_start|>\na")
    assert got[3].prompt_turns == 1 and got[3].chosen == "" and len(got[3].rejected_spans) == 2
    assert chat_format.preference_pairs(chat_format.neighbouring_pairs(df.limit(0))).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", ["op3_mixing", "op6_chat_format"])
def test_against_sql(spark, name):
    result = entry.queries()[name](spark, SF_DIR).toPandas()
    assert difference(result, sql_connection(SF_DIR).sql(entry.oracle_sql()[name]).df()) is None


def test_pipeline_on_odd_documents(spark, odd_docs, no_docs, tmp_path):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        columns, kept = docs.columns, docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, str(tmp_path))
            assert kept.columns == columns, name
        ids = corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path))
        assert ids.count() == kept.count()
