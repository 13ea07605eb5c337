"""Small helpers for tables of documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.sources.scratch import store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, columns: Iterable[str]) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


# Stored tables of narrow rows (a few numbers) up to so many rows are broadcast: some 100 MB hashed.
BROADCAST_ROWS = 1_000_000


def joinable(stored: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``stored``, marked for broadcast only where counting shows that it is small.

    Beyond that Spark joins by shuffle, and as both sides are plain exchanges it can
    split the rows of a heavy key.
    """
    return F.broadcast(stored) if stored.count() <= rows else stored


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """Within this, queries that run send so many rows at once to Python.

    A batch of long texts is held by the executor and by the worker at the same time.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def union_find(
    edges: DataFrame, name: str = "components", max_rounds: int = 60
) -> DataFrame:
    """(node, component) for all nodes of the links (a, b); the smallest node names it.

    Alternates two steps on the table of links: every node's larger neighbours are
    hung on its smallest neighbour, then every node and its smaller neighbours on the
    smallest of them. Rounds grow with the logarithm of the longest chain. The table of
    each round is stored, so a lost executor costs one round. A node's links are only
    aggregated and joined, never gathered. There are at most two nodes a link, so the
    count of the links shows whether the smallest neighbours can be broadcast. Beyond
    that they are stored: a join of two plain exchanges, where a node with very many
    links, such as the root of a large component, can be split.
    """
    a, b = F.col("a"), F.col("b")
    links = store(
        edges.filter(a != b)
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), name,
    )
    before = None
    count = links.count()

    def meeting(lowest: DataFrame) -> DataFrame:
        return F.broadcast(lowest) if 2 * count <= BROADCAST_ROWS else store(lowest, name)

    for _ in range(max_rounds):
        both = links.unionByName(links.select(b.alias("a"), a.alias("b")))
        lowest = meeting(both.groupBy("a").agg(F.least(F.min("b"), a).alias("m")))
        hung = both.filter(b > a).join(lowest, "a").select(b.alias("a"), F.col("m").alias("b"))
        hung = hung.unionByName(lowest.select("a", F.col("m").alias("b")))
        large = store(hung.filter(a != b).distinct(), name)
        lowest = meeting(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(lowest, "a")
        small = small.select(b.alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select("a", F.col("m").alias("b"))
        )
        links = store(small.filter(a != b).distinct(), name)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, count = now, now[0]
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    nodes = links.select(a.alias("node"), b.alias("component"))
    roots = links.select(b.alias("node"), b.alias("component")).distinct()
    return nodes.unionByName(roots)
