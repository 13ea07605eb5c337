"""Approximate nearest neighbours with a forest of hash prefixes.

Vectors are dealt to shards of bounded size. A shard has trees; each tree is a sorted
array of long hash strings, one bit for the side of each of its own hyperplanes through
the mean. A query descends every tree to its longest matching prefix, then all trees
ascend together, one bit at a time, until enough different candidates share a prefix
with the query in some tree. These are ranked by exact distance, and the lists of all
shards are merged.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.vectors import distinct_vectors, matrix, usable
from cardlens.sources.scratch import store

SHARD_ROWS = 16_384  # vectors in one shard: some 8 MB of 64 doubles
BLOCK_ROWS = 2_048  # queries that meet a shard at once
TREES = 48
BITS = 32  # length of a hash string
SHARE = 0.4  # least part of a shard that the trees ascend to; see the README for recall
LEAST = 200  # and at least so many candidates


class Forest:
    def __init__(self, vectors: np.ndarray, mean: np.ndarray, seed: int = 11):
        self.vectors, self.mean = vectors, mean
        rng = np.random.default_rng(seed)
        self.planes = rng.normal(size=(TREES, vectors.shape[1], BITS))
        self.codes, self.order = [], []
        for tree in range(TREES):
            code = self._code(vectors, tree)
            order = np.argsort(code, kind="stable")
            self.codes.append(code[order])
            self.order.append(order)

    def _code(self, x: np.ndarray, tree: int) -> np.ndarray:
        bits = (x - self.mean) @ self.planes[tree] > 0
        return bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))

    def candidates(self, queries: np.ndarray, least: int) -> list[np.ndarray]:
        """For each query the positions of at least ``least`` vectors, or of all."""
        n, q = len(self.vectors), len(queries)
        own = [self._code(queries, t) for t in range(TREES)]
        # descend: the longest prefix that query and a neighbour in the sorted array share
        longest = np.zeros(q, np.int64)
        for t in range(TREES):
            at = np.searchsorted(self.codes[t], own[t])
            for beside in (np.maximum(at - 1, 0), np.minimum(at, n - 1)):
                differ = self.codes[t][beside] ^ own[t]
                shared = BITS - np.where(differ > 0, np.floor(np.log2(np.maximum(differ, 1))) + 1, 0)
                longest = np.maximum(longest, shared.astype(np.int64))
        found: list[np.ndarray | None] = [None] * q
        seen = np.zeros((q, n), bool)
        open_ = np.arange(q)
        for level in range(int(longest.max()) if q else 0, -1, -1):
            active = open_[longest[open_] >= level]
            if not len(active):
                continue
            for t in range(TREES):
                low = (own[t][active] >> (BITS - level)) << (BITS - level)
                first = np.searchsorted(self.codes[t], low)
                last = np.searchsorted(self.codes[t], low + (1 << (BITS - level)))
                for i, a, b in zip(active.tolist(), first.tolist(), last.tolist()):
                    seen[i, self.order[t][a:b]] = True
            done = active[seen[active].sum(axis=1) >= min(least, n)]
            for i in done.tolist():
                found[i] = np.flatnonzero(seen[i])
            open_ = np.setdiff1d(open_, done, assume_unique=True)
            if not len(open_):
                break
        return found


def _search(key, left: pa.Table, right: pa.Table, k: int, mean: np.ndarray, share: float) -> pa.Table:
    """One shard (left) and one block of queries (right) to the shard's nearest vectors."""
    queries, asks, scores, ids = [], [], [], []
    if left.num_rows and right.num_rows:
        vectors, asked = matrix(left.column("v")), matrix(right.column("v"))
        names, lists = np.asarray(left.column("vec_id")), left.column("ids").combine_chunks()
        query_ids, ask_ids = np.asarray(right.column("query_id")), np.asarray(right.column("ask"))
        least = max(LEAST, int(np.ceil(share * len(vectors))))
        forest = Forest(vectors, mean)
        for a in range(0, len(asked), 256):
            for i, some in enumerate(forest.candidates(asked[a : a + 256], least), a):
                d = vectors[some] - asked[i]
                distance = np.sqrt((d * d).sum(axis=1))
                best = np.lexsort((names[some], distance))[: k + 1]
                queries += [query_ids[i]] * len(best)
                asks += [ask_ids[i]] * len(best)
                scores += distance[best].tolist()
                ids += some[best].tolist()
        lists = lists.take(pa.array(ids, pa.int64()))
    else:
        lists = pa.array([], pa.list_(pa.int64()))
    return pa.table({
        "query_id": pa.array(queries, pa.int64()), "ask": pa.array(asks, pa.int64()), "score": pa.array(scores, pa.float64()),
        "ids": lists.cast(pa.list_(pa.int64())),
    })


def nearest(rows: DataFrame, is_query: Column, k: int = 10, share: float = SHARE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found, by Euclidean distance.

    Every row where ``is_query`` holds is asked against all other rows; ties go to the
    smaller id. Vectors that are null, zero, or hold null or non-finite components, or
    whose length is not that of most vectors, take no part, nor do rows without id. Equal
    vectors are searched once and listed by id; rows of one id and one vector are one row.
    Different vectors of one id are rows of their own: each asks for itself, and finds the
    others. With fewer candidates all are returned; an empty table gives none.
    """
    rows = rows.select("vec_id", "embedding", is_query.alias("asks")).filter(
        usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    )
    sizes = rows.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    spark = rows.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("embedding") == common["size"])
    vectors = store(distinct_vectors(rows, k + 1), "vectors")
    count = vectors.count()
    shards = -(-count // shard_rows)
    mean = np.array(vectors.agg(*[F.avg(F.get("v", F.lit(i))) for i in range(common["size"])]).first(), float)
    asking = rows.filter("asks").select(
        F.col("vec_id").cast("bigint").alias("query_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    # copies of a query ask once; ``ask`` tells different vectors of one id apart
    asking = asking.distinct().withColumn("ask", F.xxhash64("v"))
    asked = asking.count()
    blocks = max(1, -(-asked // BLOCK_ROWS))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("block", every(blocks))
    to_all = asking.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    to_all = to_all.withColumn("shard", every(shards))
    found = dealt.groupBy("shard", "block").cogroup(to_all.groupBy("shard", "block")).applyInArrow(
        partial(_search, k=k, mean=mean, share=share), "query_id bigint, ask bigint, score double, ids array<bigint>"
    )
    each = found.select("query_id", "ask", "score", F.explode("ids").alias("vec_id"))
    # the query's own row: its id at no distance
    others = each.filter((F.col("vec_id") != F.col("query_id")) | (F.col("score") > 0))
    order = Window.partitionBy("query_id", "ask").orderBy("score", "vec_id")
    ranked = others.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
