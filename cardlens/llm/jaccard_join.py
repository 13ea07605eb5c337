"""Jaccard join of documents over word n-grams, as a grouped prefix join.

Two sets of sizes m <= n can only reach similarity t if m >= t n, and if they share one
of their first ``size - ceil(t size) + 1`` shingles under one order of all shingles. The
order puts shingles with a rare word first and those of passages that many documents
share last, so that prefixes hardly meet by chance.

1. Count words and shingles in two tables of fixed size by hash; they define the order.
2. Make each document's set and prefix. Documents with equal sets form a class, and
   classes of equal size and prefix a group; from here on only groups and classes
   meet, so copies cost nothing.
3. Each prefix shingle is a list of groups. In a list every group is paired with the
   hub, the group that shares most overall. Pairs are expanded to their classes and
   verified on whole sets; links so found give components.
4. What is left are pairs of different components: the minority of each list against
   the rest, filtered by size and position, and classes of one group, by a prefix of
   what follows the one that they share. They are expanded and verified too. Pairs
   inside one component need no check, as they cannot change it. No pair is dropped.

Shingles are told apart by 58 bits of hash beside their order; sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from cardlens.llm.arrays import (
    fold_case, mixed, pieces, row_slices, span_hashes, text_bytes, words,
)
from cardlens.llm.tables import BROADCAST_ROWS, arrow_rows, fresh, joinable, union_find
from cardlens.sources.scratch import release, store

HASHED_BYTES = 1 << 18  # texts whose words are hashed at once
BUCKETS = 1 << 16  # size of each count table, whatever the corpus has
HUB_PAIRS = 256  # pairs that meet one copy of their hub's set
_SHIFT = np.uint64(48)


def _hashes(text: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of rows: first row, word hashes, and offsets of the words by row."""
    data, offsets = text_bytes(text)
    for first, last in row_slices(offsets, HASHED_BYTES):
        piece = fold_case(data[offsets[first] : offsets[last]])
        starts, ends, at = words(piece, offsets[first : last + 1] - offsets[first])
        yield first, span_hashes(piece, starts, ends), at


def _chain(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return out


def _row_shingles(h: np.ndarray, at: np.ndarray, k: int, chained: np.ndarray, i: int) -> np.ndarray:
    a, b = at[i], at[i + 1]
    if b - a >= k:
        return chained[a : b - k + 1]
    return _chain(h[a:b], int(b - a)) if b > a else h[:0]


def _counts(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    by_word = np.zeros(BUCKETS, np.int64)
    by_shingle = np.zeros(BUCKETS, np.int64)
    for batch in pieces(batches):
        for _, h, at in _hashes(batch.column(0), k):
            by_word += np.bincount((h >> _SHIFT).astype(np.int64), minlength=BUCKETS)
            chained = _chain(h, k)
            for i in range(len(at) - 1):
                own = np.unique(_row_shingles(h, at, k, chained, i))
                np.add.at(by_shingle, (own >> _SHIFT).astype(np.int64), 1)
    both = np.concatenate([by_word, by_shingle])
    some = np.flatnonzero(both)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(both[some])], ["bucket", "n"])


def shingle_order(texts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes 0 to 7 by word bucket and by shingle bucket: how far above the usual count."""
    counted = texts.mapInArrow(partial(_counts, k=k), "bucket int, n bigint")
    got = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most 2 * BUCKETS
    both = np.zeros(2 * BUCKETS)
    both[got.bucket.to_numpy(np.int64)] = got.n.to_numpy(float)
    by_word, by_shingle = both[:BUCKETS], both[BUCKETS:]
    usual = np.median(by_shingle)
    word = np.floor(2 * np.log2(1 + by_word / max(np.median(by_word), 1)))
    excess = np.maximum(by_shingle - usual, 0) / (4 * np.sqrt(usual) + 1)
    shingle = np.floor(np.log2(1 + excess))
    return np.minimum(word, 7).astype(np.uint64), np.minimum(shingle, 7).astype(np.uint64)


def _ordered_sets(text: pa.Array, k: int, order) -> Iterator[np.ndarray]:
    """The set of each text as sorted numbers: order class first, then hash."""
    by_word, by_shingle = order
    for _, h, at in _hashes(text, k):
        chained = _chain(h, k)
        rarity = by_word[(h >> _SHIFT).astype(np.int64)]
        least = rarity[: len(chained)].copy()
        for i in range(1, k):
            np.minimum(least, rarity[i : i + len(chained)], out=least)
        keys = (by_shingle[(chained >> _SHIFT).astype(np.int64)] << np.uint64(3)) | least
        keys = (keys << np.uint64(58)) | (chained >> np.uint64(6))
        for i in range(len(at) - 1):
            a, b = at[i], at[i + 1]
            if b - a >= k:
                yield np.unique(keys[a : b - k + 1])
            elif b > a:  # the whole sequence as one
                yield _chain(h[a:b], int(b - a)) >> np.uint64(6)
            else:
                yield h[:0]


def _least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _signatures(batches, k: int, percent: int, order) -> Iterator[pa.RecordBatch]:
    """(tk, doc_id, text) to one row of set size, set hashes, group hash, prefix and histogram.

    ``row`` numbers the rows; the table is stored, so a number stays with its row.
    """
    row = TaskContext.get().partitionId() << 40
    for batch in pieces(batches):
        n, s1, s2, g, prefixes, histograms = [], [], [], [], [], []
        for keys in _ordered_sets(batch.column("text"), k, order):
            size = len(keys)
            prefix = keys[: size - _least_overlap(size, percent) + 1] if size else keys
            n.append(size)
            s1.append(mixed(keys ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
            s2.append(mixed(keys * np.uint64(0x2545F4914F6CDD1D) + np.uint64(size)).sum(dtype=np.uint64))
            spread = mixed(prefix + np.uint64(0x94D049BB133111EB) * np.arange(len(prefix), dtype=np.uint64))
            g.append(mixed(np.array([spread.sum(dtype=np.uint64) + np.uint64(size)], np.uint64))[0])
            prefixes.append(prefix.astype(np.int64))
            counts = np.bincount(((keys >> np.uint64(20)) & np.uint64(255)).astype(np.int64), minlength=256)
            histograms.append(np.minimum(counts, 65535).astype(np.uint16).tobytes())
        longs = [pa.array(np.array(v, np.uint64).view(np.int64)) for v in (s1, s2, g)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tk"), pa.array(n, pa.int32()), *longs,
             pa.array(prefixes, pa.list_(pa.int64())), pa.array(histograms, pa.binary()),
             pa.array(row + np.arange(len(n)))],
            ["doc_id", "tk", "n", "s1", "s2", "g", "prefix", "histogram", "row"],
        )
        row += len(n)


def _sets(batches, k: int, order) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # classes a task has met, for copies of one text
    for batch in pieces(batches):
        classes = batch.column("c").to_pylist()
        new = [i for i, c in enumerate(classes) if not (c in seen or seen.add(c))]
        text = batch.column("text").take(pa.array(new, pa.int64()))
        got = [s.astype(np.int64) for s in _ordered_sets(text, k, order)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([classes[i] for i in new], pa.int64()), pa.array(got, pa.list_(pa.int64()))], ["c", "keys"]
        )


def _further(batches, k: int, percent: int, order) -> Iterator[pa.RecordBatch]:
    """(c, text) to the shingles behind the prefix of which two sets of this size that link share one."""
    seen: set[int] = set()
    for batch in pieces(batches):
        c, further = [], []
        for number, keys in zip(batch.column("c").to_pylist(), _ordered_sets(batch.column("text"), k, order)):
            if number in seen:
                continue
            seen.add(number)
            size = len(keys)
            prefix = size - _least_overlap(size, percent) + 1
            missing = -(-2 * percent * size // (100 + percent)) - prefix  # what two such sets share elsewhere
            c.append(number)
            further.append(keys[prefix : size - missing + 1].astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(further, pa.list_(pa.int64()))], ["c", "further"])


@arrow_udf(LongType())
def _overlap_bound(x: pa.Array, y: pa.Array) -> pa.Array:
    """No two sets share more than the smaller counts of their histograms together."""
    if not len(x):
        return pa.array([], pa.int64())
    a = np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(len(x), 256)
    b = np.frombuffer(b"".join(y.to_pylist()), np.uint16).reshape(len(x), 256)
    full = (a == 65535) & (b == 65535)  # counts that did not fit
    return pa.array(np.minimum(a, b).sum(axis=1, dtype=np.int64) + full.sum(axis=1) * (1 << 40))


def _texts(docs: DataFrame, involved: DataFrame) -> DataFrame:
    """(c, text) for the stored classes (c, tk, doc_id)."""
    named = joinable(involved).select("c", F.col("tk").alias("_tk"), F.col("doc_id").alias("_id"))
    return docs.join(
        named, (F.xxhash64("text") == F.col("_tk")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    ).select("c", "text")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int, order) -> DataFrame:
    """Pairs of classes (a, b) whose whole sets are similar enough, stored.

    Histograms first rule out most pairs. For the rest sets are made anew from one text
    of each class, and each pair moves one set, that of ``b``.
    """
    side = classes.select("c", "n", "histogram")
    x = side.select(F.col("c").alias("a"), F.col("n").alias("a_n"), F.col("histogram").alias("a_h"))
    y = side.select(F.col("c").alias("b"), F.col("n").alias("b_n"), F.col("histogram").alias("b_h"))
    bounded = pairs.join(y, "b").join(x, "a").withColumn("bound", _overlap_bound("a_h", "b_h"))
    possible = F.lit(100 + percent) * F.col("bound") >= F.lit(percent) * (F.col("a_n") + F.col("b_n"))
    pairs = store(bounded.filter(possible).select("a", "b"), "pairs")
    # a hub with many pairs has as many copies of its set, so that no task gets them all
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_PAIRS).cast("int").alias("parts"))
    hubs = joinable(store(parts, "hub-parts"))
    own = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    wanted = store(
        pairs.join(hubs, "a").select(
            F.col("b").alias("c"), F.col("a").alias("to"), F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part")
        ).unionByName(hubs.select(F.col("a").alias("c"), F.col("a").alias("to"), own.alias("part"))), "wanted",
    )
    involved = store(wanted.select("c").distinct().join(classes.select("c", "tk", "doc_id"), "c"), "involved")
    sets = _texts(docs, involved).mapInArrow(partial(_sets, k=k, order=order), "c bigint, keys array<bigint>")
    sent = store(sets.join(joinable(wanted), "c"), "sent-sets")
    hub_sets = sent.filter("c = to").select("to", "part", F.col("keys").alias("hub_keys"))
    common = F.size(F.array_intersect("keys", "hub_keys"))
    union = F.size("keys") + F.size("hub_keys") - common
    met = sent.filter("c != to").join(hub_sets, ["to", "part"]).filter(100 * common >= percent * union)
    links = store(met.select(F.col("to").alias("a"), F.col("c").alias("b")).distinct(), "links")
    release(sent)  # whole sets, by far the widest rows
    return links


def classes_of(docs: DataFrame, k: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, tk, n, s1, s2) for all documents, and (n, s1, s2, component_id).

    ``tk`` is the hash of the text. Rows with the same set are one class whatever their
    ids. Null and empty texts have n = 0 and no class. ``component_id`` is the smallest
    non-null id in the component, null where it has none.
    """
    with arrow_rows(docs.sparkSession):
        return _classes_of(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), k, percent)


def _classes_of(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    order = shingle_order(docs.select("text"), k)
    signed = store(
        docs.select("doc_id", F.xxhash64("text").alias("tk"), "text").mapInArrow(
            partial(_signatures, k=k, percent=percent, order=order),
            "doc_id bigint, tk bigint, n int, s1 bigint, s2 bigint, g bigint, prefix array<bigint>, "
            "histogram binary, row bigint",
        ),
        "signatures",
    )
    filled = signed.filter("n > 0")
    # a class is known by its smallest row, a group by its smallest class
    firsts = store(
        filled.groupBy("n", "s1", "s2").agg(F.min("row").alias("c"), F.min("g").alias("g")), "classes"
    )
    reps = firsts.groupBy("n", "g").agg(F.min("c").alias("rep"))
    ranked = joinable(store(firsts.join(reps, ["n", "g"]).select("c", "rep"), "ranked"))
    grouped = store(
        filled.join(ranked, F.col("row") == F.col("c")).select("c", "rep", "n", "tk", "doc_id", "histogram"),
        "grouped",
    )
    only = joinable(store(ranked.filter("c = rep").select("rep"), "groups"))
    prefixes = filled.join(only, F.col("row") == F.col("rep")).select("rep", "n", "prefix")
    postings = prefixes.select("rep", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = store(
        postings.groupBy("token").agg(F.count("*").alias("length")).filter("length > 1"),
        "shared-tokens",
    )
    # every row knows its list's length, which is all of the postings that share its token
    lists = store(postings.join(joinable(shared, 2 * BROADCAST_ROWS), "token"), "lists")
    # prefixes and histograms of all rows are by far the widest columns; from here on few are wanted
    rows = store(signed.select("doc_id", "tk", "n", "s1", "s2", "row"), "rows")
    release(signed)
    filled = rows.filter("n > 0")

    # the hub of a list: the member whose lists are longest altogether
    mass = store(lists.groupBy("rep").agg(F.sum("length").alias("mass")), "mass")
    hubs = store(
        lists.join(joinable(mass), "rep").groupBy("token")
        .agg(F.max(F.struct("mass", "rep", "n")).alias("hub"))
        .select("token", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n")),
        "hubs",
    )
    near = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    stars = (
        lists.join(joinable(hubs), "token").filter((F.col("rep") != F.col("hub")) & near)
        .select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    )
    inside = grouped.filter("c != rep").select(F.col("rep").alias("a"), F.col("c").alias("b"))
    verify = partial(_verified, docs, grouped, k=k, percent=percent, order=order)
    tried = store(stars.unionByName(inside), "stars")
    links = verify(tried)
    first = store(union_find(links), "first-components")

    placed = store(
        grouped.join(first.withColumnRenamed("node", "c"), "c", "left")
        .select("c", "rep", "n", F.coalesce("component", "c").alias("component")),
        "placed",
    )
    rest, helpers = _rest(lists, hubs, placed, percent)
    rest = rest.unionByName(_same_prefix(docs, grouped, placed, k, percent, order)).distinct()
    both_ways = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = store(rest.join(both_ways, ["a", "b"], "left_anti"), "rest")
    for used in (lists, hubs, mass, *helpers):
        release(used)
    links = links.unionByName(verify(rest))
    final = store(union_find(links), "components")
    ids = filled.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("c"))
    named = store(
        ids.join(final.withColumnRenamed("node", "c"), "c", "left")
        .withColumn("component", F.coalesce("component", "c")), "named",
    )
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    result = named.join(smallest, "component").select("n", "s1", "s2", "component_id", "component")
    return rows.select("doc_id", "tk", "n", "s1", "s2"), store(result, "class-components")


def _rest(
    lists: DataFrame, hubs: DataFrame, placed: DataFrame, percent: int
) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs of classes of different groups and components that size and position leave possible.

    Also the tables stored for that.
    """
    rows = store(
        lists.join(placed.select("rep", "c", "component"), "rep")
        .select("token", "rep", "c", "n", "pos", "component"), "placed-lists",
    )
    main = hubs.join(
        placed.filter("c = rep").select(F.col("c").alias("hub"), F.col("component").alias("main")), "hub"
    )
    minor = store(
        rows.join(joinable(store(main.select("token", "main"), "main")), "token")
        .filter("component != main").select("token", "rep", "c", "n", "pos", "component"), "minor",
    )
    both = minor.alias("x").join(rows.alias("y"), "token")
    least = F.ceil(F.lit(percent) * (F.col("x.n") + F.col("y.n")) / F.lit(100 + percent))
    possible = (
        (F.col("x.rep") != F.col("y.rep"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= least)
    )
    x, y = F.col("x.c"), F.col("y.c")
    met = both.filter(possible).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    return met, [rows, minor]


def _same_prefix(docs: DataFrame, grouped: DataFrame, placed: DataFrame, k: int, percent: int, order) -> DataFrame:
    """Pairs of classes of one group in different components that can link.

    They share the prefix, so they have no list in common if no other group has it too.
    Of what two linked sets share beyond it, one shingle is among the next few.
    """
    several = placed.groupBy("rep").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    apart = joinable(store(several.filter("least != most").select("rep"), "split-groups"))
    members = store(
        placed.join(apart, "rep").join(grouped.select("c", "tk", "doc_id"), "c")
        .select("rep", "c", "component", "tk", "doc_id"), "members",
    )
    further = _texts(docs, members.select("c", "tk", "doc_id")).mapInArrow(
        partial(_further, k=k, percent=percent, order=order), "c bigint, further array<bigint>"
    )
    lists = store(
        further.dropDuplicates(["c"]).join(members, "c").select("rep", "c", "component", F.explode("further").alias("token")),
        "further-lists",
    )
    x, y = F.col("x.c"), F.col("y.c")
    both = lists.alias("x").join(lists.alias("y"), ["rep", "token"])
    return both.filter((x < y) & (F.col("x.component") != F.col("y.component"))).select(x.alias("a"), y.alias("b"))


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Sets of distinct ``k``-word shingles link when 100 * intersection >= percent *
    union; a text of fewer words is one shingle; without words it has none, links with
    nothing and is its own component. Case of A-Z is ignored. Repeated rows keep a row
    each. Null ids take part; they name a component only where it has no other id.
    """
    rows, components = classes_of(docs, k, percent)
    joined = rows.filter("n > 0").join(components, ["n", "s1", "s2"])
    empty = rows.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")
    return joined.select(*columns).unionByName(empty.select(*columns))


def jaccard_stage(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Keep one row of each component, that with the smallest id (then text hash).

    Columns are those of ``docs``. Rows without words all stay.
    """
    rows, components = classes_of(docs, k, percent)
    joined = rows.filter("n > 0").join(components, ["n", "s1", "s2"])
    # one row for each (id, text) and how often it occurs; nulls sort last
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tk")
    units = joined.groupBy("component", "doc_id", "tk").agg(F.count("*").alias("times"))
    best = units.groupBy("component").agg(F.min(key).alias("best"))
    marked = units.join(best, "component").withColumn("stays", key.eqNullSafe(F.col("best")))
    changed = store(
        marked.filter(~F.col("stays") | (F.col("times") > 1)).select("doc_id", "tk", "stays"), "changed"
    )
    columns = docs.columns
    tk, stays = fresh("tk", columns), fresh("stays", columns)
    other = fresh("other_id", columns)
    flags = joinable(changed).select(F.col("doc_id").alias(other), F.col("tk").alias(tk), F.col("stays").alias(stays))
    text_key = F.xxhash64("text")
    met = docs.join(
        flags, (F.col("doc_id").eqNullSafe(F.col(other))) & (text_key == F.col(tk)), "left"
    )
    alone = met.filter(F.col(stays).isNull()).select(*columns)
    repeated = met.filter(F.col(stays)).select(*columns, tk).dropDuplicates(["doc_id", tk])
    return alone.unionByName(repeated.select(*columns))
