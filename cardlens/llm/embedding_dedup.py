"""Near-duplicate vectors by search in robust-pruned flat graphs.

1. Different vectors are clustered around centroids learnt from a bounded sample. Each
   goes to its two nearest clusters. Clusters of more than ``PART_ROWS`` vectors are cut
   into parts by hash.
2. Each part gets a graph: vectors are inserted in batches, each batch searches the graph
   so far, and what a search visits is pruned to a few neighbours in all directions. The
   adjacency lists of a vector from all its parts are united.
3. Every vector is searched in every part of every cluster that is likely to be the nearest one
   of a vector in range (``reach``), whatever the number of clusters: greedily from the medoid, and
   from what is found in range on along the edges, in both directions, for as long as there
   is more in range. A vector that is itself in the part also sets out from there.
   Found pairs are verified by cosine in double precision on the original vectors.
4. A task gives, by vector, the larger ids it found and the smallest id of its local
   component. A pair counts once for both of its vectors, whichever search, direction or
   cluster found it.

5. The stored pairs are audited against brute force on a fixed number of vectors. Below
   ``LEAST_RECALL`` all is searched again with a wider margin, then in every cluster that can
   at all be the nearest, and in the end each vector against the whole parts.

Vectors are told apart by numbers of their own, not by their ids, which rows may share.

``recall`` makes the same audit of a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cardlens.llm.tables import joinable, union_find
from cardlens.llm.vectors import distinct_vectors, matrix, usable
from cardlens.sources.scratch import store

CLUSTER_ROWS = 2_000  # aimed at
MAX_CENTROIDS = 1_024
SAMPLE_ROWS = 20_000  # vectors that centroids are learnt from
OVERLAP = 2
PART_ROWS = 4_096
DEGREE = 20
BEAM = 24
STRETCH = 1.2  # slack of pruning
EDGES = OVERLAP * DEGREE
LEAST_RECALL = 0.995
MARGIN = 3.0  # in standard deviations of how far a random neighbour moves along one direction


class Graph:
    """Unit vectors with padded adjacency lists (-1)."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None):
        self.x = x
        self.medoid = int((x @ x.mean(axis=0)).argmax()) if len(x) else 0
        self.edges = np.full((len(x), DEGREE), -1, np.int64) if edges is None else edges
        self.both: tuple[np.ndarray, np.ndarray] | None = None

    def search(self, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Greedy best-first search of all queries together: ids and similarities, best first."""
        q, line = len(queries), np.arange(len(queries))[:, None]
        ids = np.full((q, beam), -1, np.int64)
        sims = np.full((q, beam), -np.inf)
        ids[:, 0] = self.medoid
        sims[:, 0] = queries @ self.x[self.medoid]
        visited = np.zeros((q, beam), bool)
        while True:
            waiting = np.where(visited | (ids < 0), -np.inf, sims)
            best = waiting.argmax(axis=1)
            go = np.flatnonzero(np.isfinite(waiting[np.arange(q), best]))
            if not len(go):
                return ids, sims
            visited[go, best[go]] = True
            near = self.edges[ids[go, best[go]]]
            known = (near[:, :, None] == ids[go][:, None, :]).any(axis=2) | (near < 0)
            s = np.einsum("qrd,qd->qr", self.x[np.maximum(near, 0)], queries[go])
            s[known] = -np.inf
            all_ids = np.concatenate([ids[go], np.where(known, -1, near)], axis=1)
            all_sims = np.concatenate([sims[go], s], axis=1)
            all_seen = np.concatenate([visited[go], np.zeros(near.shape, bool)], axis=1)
            top = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            row = line[: len(go)]
            ids[go], sims[go], visited[go] = all_ids[row, top], all_sims[row, top], all_seen[row, top]

    def prune(self, point: int, others: np.ndarray) -> np.ndarray:
        """Neighbours nearest first, leaving out those that a chosen one is closer to."""
        others = np.unique(others[(others >= 0) & (others != point)])
        near = self.x[others]
        to_point = 1 - near @ self.x[point]
        order = np.argsort(to_point, kind="stable")
        others, near, to_point = others[order], near[order], to_point[order]
        between = 1 - near @ near.T
        alive = np.ones(len(others), bool)
        chosen = []
        for i in range(len(others)):
            if not alive[i]:
                continue
            chosen.append(i)
            if len(chosen) == DEGREE:
                break
            alive &= STRETCH * between[i] > to_point
        return others[chosen]

    def build(self, seed: int = 5) -> Graph:
        """Insert all vectors in batches that double, the medoid first."""
        n = len(self.x)
        order = np.random.default_rng(seed).permutation(n)
        order = np.concatenate([[self.medoid], order[order != self.medoid]]) if n else order
        at = 1
        while at < n:
            batch = order[at : at + min(max(at, 8), 256)]
            found, _ = self.search(self.x[batch])
            incoming: dict[int, list[int]] = {}
            for point, candidates in zip(batch.tolist(), found):
                kept = self.prune(point, np.concatenate([candidates, batch[:8]]) if at < 64 else candidates)
                self.edges[point] = -1
                self.edges[point, : len(kept)] = kept
                for other in kept.tolist():
                    incoming.setdefault(other, []).append(point)
            for other, points in incoming.items():
                both = np.union1d(self.edges[other], np.array(points))
                both = both[both >= 0]
                kept = both if len(both) <= DEGREE else self.prune(other, both)
                self.edges[other] = -1
                self.edges[other, : len(kept)] = kept
            at += len(batch)
        return self

    def in_range(self, queries: np.ndarray, least: float, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, vector) with similarity of at least ``least``.

        ``own`` is a query's place in the graph, or -1.
        """
        if self.both is None:
            a, nth = np.nonzero(self.edges >= 0)
            b = self.edges[a, nth]
            key = np.unique(np.concatenate([a * len(self.x) + b, b * len(self.x) + a]))
            self.both = key % len(self.x), np.searchsorted(key // len(self.x), np.arange(len(self.x) + 1))
        near_of, starts = self.both
        ids, sims = self.search(queries)
        there = own >= 0
        ids = np.concatenate([ids, own[:, None]], axis=1)
        sims = np.concatenate([sims, np.where(there, 1.0, -np.inf)[:, None]], axis=1)
        again = (ids[:, :-1] == own[:, None]) & there[:, None]  # found by the search as well
        ids[:, :-1][again] = -1
        seen = np.zeros((len(queries), len(self.x)), bool)
        line = np.repeat(np.arange(len(queries)), ids.shape[1]).reshape(ids.shape)
        real = ids >= 0
        seen[line[real], ids[real]] = True
        hit = real & (sims >= least)
        q, v = [line[hit]], [ids[hit]]
        new_q, new_v = q[0], v[0]
        while len(new_q):
            next_q, next_v = [], []
            for a in range(0, len(new_q), 8_192):
                some = new_v[a : a + 8_192]
                sizes = starts[some + 1] - starts[some]
                whose = np.repeat(new_q[a : a + 8_192], sizes)
                ends = np.cumsum(sizes)
                near = near_of[np.arange(len(whose)) + np.repeat(starts[some] - ends + sizes, sizes)]
                fresh = ~seen[whose, near]
                key = np.unique(whose[fresh] * len(self.x) + near[fresh])
                whose, near = key // len(self.x), key % len(self.x)
                seen[whose, near] = True
                s = np.einsum("nd,nd->n", self.x[near], queries[whose])
                next_q.append(whose[s >= least])
                next_v.append(near[s >= least])
            new_q, new_v = np.concatenate(next_q), np.concatenate(next_v)
            q.append(new_q)
            v.append(new_v)
        return np.concatenate(q), np.concatenate(v)


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that squares of very large or small components do not overflow
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(sample: np.ndarray, k: int, sweeps: int = 8, seed: int = 2) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    rng = np.random.default_rng(seed)
    centers = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(sweeps):
        owner = (sample @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, owner, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norm > 0, sums / np.maximum(norm, 1e-300), centers)
    return centers


def reach(x: np.ndarray, centers: np.ndarray, least: float, margin: float = 1.0) -> np.ndarray:
    """(vectors, clusters): whether a vector within ``least`` may have the cluster as its nearest.

    A neighbour is at least as near to its own center c as to this vector's nearest one d,
    so its angle to c - d is at most a right one, and the vector's at most larger by the
    angle between the two vectors. That is the worst case; ``margin`` is the share of it
    that is allowed for.
    """
    sims = x @ centers.T
    if least <= 0:
        return np.ones(sims.shape, bool)
    squares = (centers * centers).sum(axis=1)
    apart = np.sqrt(np.maximum(squares[:, None] + squares - 2 * centers @ centers.T, 0))
    best = sims.argmax(axis=1)
    behind = sims[np.arange(len(x)), best][:, None] - sims
    return behind <= margin * np.sqrt(max(1 - least * least, 0)) * apart[best] + 1e-6


def _build(table: pa.Table) -> pa.Table:
    names = np.asarray(table.column("node"))
    edges = Graph(_unit(matrix(table.column("v")))).build().edges
    return pa.table({
        "node": table.column("node"),
        "near": pa.array([names[e[e >= 0]] for e in edges], pa.list_(pa.int64())),
    })


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of the component of each of ``n`` nodes with links (a, b)."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        low, new = np.minimum(ra, rb), root.copy()
        np.minimum.at(new, ra, low)
        np.minimum.at(new, rb, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _find(left: pa.Table, right: pa.Table, least: float, whole: bool = False) -> pa.Table:
    """A part's graph (left) and queries of its cluster (right).

    Gives for each vector with a link the larger ids linked to it and the smallest id of
    its component in this task. ``whole``: without the graph, against all vectors.
    """
    some = np.zeros(0, np.int64)
    lists, root = pa.array([], pa.list_(pa.int64())), some
    if left.num_rows and right.num_rows:
        names = np.asarray(left.column("node"))
        order = np.argsort(names)
        lists = left.column("near").combine_chunks()
        flat, sizes = np.asarray(lists.flatten()), np.diff(np.asarray(lists.offsets))
        at = np.minimum(np.searchsorted(names[order], flat), len(names) - 1)
        local = np.where(names[order][at] == flat, order[at], -1)  # neighbours in other parts
        edges = np.full((len(names), EDGES), -1, np.int64)
        owner = np.repeat(np.arange(len(names)), sizes)
        nth = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        fits = nth < EDGES
        edges[owner[fits], nth[fits]] = local[fits]
        x = _unit(matrix(left.column("v")))
        graph = Graph(x, edges)
        asked, ids = _unit(matrix(right.column("v"))), np.asarray(right.column("node"))
        at = np.minimum(np.searchsorted(names[order], ids), len(names) - 1)
        own = np.where(names[order][at] == ids, order[at], -1)
        everyone = np.unique(np.concatenate([names, ids]))
        name_at, id_at = np.searchsorted(everyone, names), np.searchsorted(everyone, ids)
        keys = []
        for a in range(0, len(asked), 512):
            if whole:
                q, v = np.nonzero(asked[a : a + 512] @ x.T >= least)
            else:
                q, v = graph.in_range(asked[a : a + 512], least, own[a : a + 512])
            one, two = id_at[a + q], name_at[v]
            keys.append(np.unique(np.minimum(one, two) * len(everyone) + np.maximum(one, two)))
        key = np.unique(np.concatenate(keys))
        low, high = key // len(everyone), key % len(everyone)
        low, high = low[low != high], high[low != high]
        touched = np.unique(np.concatenate([low, high]))
        cuts = np.append(np.searchsorted(low, touched), len(low)).astype(np.int32)
        some, root = everyone[touched], everyone[_roots(len(everyone), low, high)[touched]]
        lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(everyone[high], pa.int64()))
    return pa.table({"node": pa.array(some, pa.int64()), "larger": lists, "root": pa.array(root, pa.int64())})


def _links(found: DataFrame, placed: DataFrame) -> DataFrame:
    """(node, links): how many rows link to each vector by the pairs of ``found``.

    Pairs are made distinct and then counted for both vectors; only vectors with copies
    are looked up.
    """
    pairs = store(found.select(F.col("node").alias("a"), F.explode("larger").alias("b")).distinct(), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copied = store(placed.filter("copies > 1").select(F.col("node").alias("b"), "copies"), "copied")
    return both.join(joinable(copied), "b", "left").groupBy(F.col("a").alias("node")).agg(
        F.sum(F.coalesce("copies", F.lit(1))).alias("links")
    )


def near_duplicates(rows: DataFrame, least: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) by row of ``rows``.

    Vectors link when their cosine is at least ``least``. Those that are null, zero, hold
    null or non-finite components, or are not as long as most, link with nothing. Equal
    vectors are searched once; each is a link of the others. Rows of one id and one
    vector are one vector: they get equal answers, and not a link for each other. Different
    vectors of one id are vectors of their own; a component is named by the smallest id in it.
    A row without id links with nothing, has no component and is kept.
    """
    base = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").withColumn(
        "fine", usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    )
    sizes = base.filter("fine").groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()

    def unlinked(rows: DataFrame) -> DataFrame:
        return rows.select(
            "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )

    if common is None:
        return unlinked(base)
    fine = base.filter(F.col("fine") & (F.size("embedding") == common["size"])).select("vec_id", "embedding")
    rest = base.filter(~(F.col("fine") & (F.size("embedding") == common["size"])))
    # every different vector gets a number: ids may be shared by vectors that are not alike
    numbered = distinct_vectors(fine.dropDuplicates(["vec_id", "embedding"]), 1).drop("ids").withColumn(
        "node", F.monotonically_increasing_id()
    )
    different = store(numbered, "different")
    count = different.count()

    hashed = F.xxhash64("v")
    cells = different.groupBy(F.pmod(hashed, F.lit(SAMPLE_ROWS)).alias("cell"))
    sample = cells.agg(F.min_by("v", F.struct(hashed, "v")).alias("v")).select("v").toArrow()
    centers = centroids(_unit(matrix(sample.column("v"))), int(np.clip(-(-count // CLUSTER_ROWS), 1, MAX_CENTROIDS)))

    def units(v: pa.Array) -> Iterator[np.ndarray]:
        flat = v.flatten()
        size = len(flat) // max(len(v), 1)
        for a in range(0, len(v), 2_048):
            yield _unit(np.asarray(flat[a * size : (a + 2_048) * size], np.float64).reshape(-1, size))

    @arrow_udf("array<int>")
    def homes(v: pa.Array) -> pa.Array:
        near = [n for x in units(v) for n in np.argsort(-(x @ centers.T), axis=1, kind="stable")[:, :OVERLAP]]
        return pa.array(near, pa.list_(pa.int32()))

    placed = store(different.withColumn("homes", homes("v")), "placed-vectors")

    def in_parts(rows: DataFrame, name: str) -> DataFrame:
        # at most MAX_CENTROIDS rows
        parts = rows.groupBy("cluster").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias(f"{name}s"))
        return rows.join(F.broadcast(parts), "cluster").withColumn(
            name, F.pmod(F.xxhash64("node"), F.col(f"{name}s")).cast("int")
        )

    members = store(in_parts(placed.select(F.explode("homes").alias("cluster"), "node", "v"), "part"), "members")
    built = members.select("cluster", "part", "node", "v").groupBy("cluster", "part").applyInArrow(
        _build, "node bigint, near array<bigint>"
    )
    united = store(
        built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "adjacency"
    )
    graph = store(members.join(united, "node"), "graph-members")
    part_counts = F.broadcast(members.select("cluster", "parts").distinct())  # at most MAX_CENTROIDS rows

    def reached(margin: float) -> Column:
        @arrow_udf("array<int>")
        def clusters(v: pa.Array) -> pa.Array:
            near = [np.flatnonzero(r) for x in units(v) for r in reach(x, centers, least, margin)]
            return pa.array(near, pa.list_(pa.int32()))

        return clusters("v")

    for margin, whole in _margins(common["size"]):
        asking = placed.select("node", "v", reached(margin).alias("reach"))
        asking = store(asking.select(F.explode("reach").alias("cluster"), "node", "v"), "asking")
        found = store(_searched(graph, in_parts(asking, "asker").join(part_counts, "cluster"), least, whole), "found")
        links = store(_links(found, placed), "links")
        counted = placed.select("node").join(links, "node", "left").select(
            "node", F.coalesce("links", F.lit(0)).alias("n_links")
        )
        if whole or _share(placed.select("node", "v", "copies"), counted, least) >= LEAST_RECALL:
            break
    linked = placed.join(links, "node", "left").join(
        union_find(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "node", "left"
    )
    linked = store(linked.withColumn("component", F.coalesce("component", "node")), "linked-vectors")
    named = store(linked.groupBy("component").agg(F.min("vec_id").alias("component_id")), "component-ids")
    facts = store(
        linked.join(joinable(named), "component").select(
            "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
        ),
        "vector-facts",
    )
    own = fine.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    known = own.join(facts, "v").select("vec_id", "n_links", "component_id").withColumn(
        "kept", F.col("vec_id") == F.col("component_id")
    )
    return known.unionByName(unlinked(rest))


def _margins(size: int) -> list[tuple[float, bool]]:
    """Margins to search with, one after another, until the audit is content; last the whole parts.

    Along a fixed direction a random neighbour moves by a share of 1 / sqrt(size) of what it
    can move at most.
    """
    spread = 1 / np.sqrt(size)
    return [*[(m, False) for m in (MARGIN * spread, 2 * MARGIN * spread) if m < 1], (1.0, False), (1.0, True)]


def _searched(graph: DataFrame, asking: DataFrame, least: float, whole: bool) -> DataFrame:
    """What ``_find`` gives for every part of the graph and the vectors that ask its cluster."""
    # at most MAX_CENTROIDS rows
    asker_counts = F.broadcast(asking.groupBy("cluster").agg(F.max("askers").alias("askers")))
    parts = graph.join(asker_counts, "cluster").select(
        "cluster", "part", F.explode(F.sequence(F.lit(0), F.col("askers") - 1)).alias("asker"), "node", "v", "near",
    )
    # aliases make columns of their own, which the cogroup needs to tell both sides apart
    askers = asking.select(*[F.col(c).alias(c) for c in asking.columns]).select(
        "cluster", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "asker", "node", "v",
    )
    key = ("cluster", "part", "asker")
    return parts.groupBy(*key).cogroup(askers.groupBy(*key)).applyInArrow(
        partial(_find, least=least, whole=whole), "node bigint, larger array<bigint>, root bigint"
    )


def _share(points: DataFrame, counted: DataFrame, least: float, cells: int = 64) -> float:
    """Part of the true links of some of ``points`` (node, v, copies) that ``counted`` holds.

    One linked and one unlinked vector of each cell by hash, by brute force in blocks.
    """
    cell = F.pmod(F.xxhash64("node"), F.lit(cells))
    asked = points.join(counted, "node").groupBy(cell.alias("cell"), (F.col("n_links") > 0).alias("linked")).agg(
        F.min_by(F.struct("node", "v", "n_links"), F.struct(F.xxhash64("node"), "node")).alias("r")
    ).select("r.*").toPandas()
    if not len(asked):
        return 1.0
    queries, ids = _unit(np.stack(asked.v.to_list())), asked.node.to_numpy()

    def count(batches):
        for b in batches:
            x = _unit(matrix(b.column("v"))) if b.num_rows else np.zeros((0, queries.shape[1]))
            hit = (x @ queries.T >= least) & (np.asarray(b.column("node"))[:, None] != ids)
            n = (hit * np.asarray(b.column("copies"))[:, None]).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n, pa.int64())], ["node", "n"])

    true = points.mapInArrow(count, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n")).toPandas()
    true = true.set_index("node").n.reindex(ids).to_numpy()
    return float(np.minimum(asked.n_links.to_numpy(), true).sum() / true.sum()) if true.sum() else 1.0


def recall(rows: DataFrame, result: DataFrame, least: float = 0.95, cells: int = 64) -> float:
    """Part of the true links that the counts of some vectors hold, linked and unlinked ones.

    Brute force of at most ``2 * cells`` vectors against all rows, in blocks. Ids are taken to
    be of one vector each.
    """
    fine = rows.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("node"), F.col("embedding").cast("array<double>").alias("v"),
        F.lit(1).alias("copies"),
    )
    return _share(fine, result.select(F.col("vec_id").alias("node"), "n_links"), least, cells)
