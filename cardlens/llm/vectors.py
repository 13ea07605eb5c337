"""Tables of vectors for searches and joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is non-null, not zero, and without null or non-finite components."""
    v = vector.cast("array<double>")
    infinite = F.lit(float("inf"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame, keep_ids: int) -> DataFrame:
    """(v, vec_id, copies, ids): every different vector once, of rows that have an id.

    ``vec_id`` is the smallest id, ``copies`` the number of rows, ``ids`` the
    ``keep_ids`` smallest different ids. Copies are counted before the shuffle, and only lists of
    bounded length are merged, so a vector with many copies is no hot spot.
    """
    numbered = rows.select(
        F.col("embedding").cast("array<double>").alias("v"), F.col("vec_id").cast("bigint").alias("vec_id")
    ).filter(F.col("vec_id").isNotNull())

    def smallest(ids: Column) -> Column:
        return F.slice(F.array_sort(ids), 1, keep_ids)

    # first within slices of the ids, so that no list holds all copies of a vector
    piece = F.pmod(F.xxhash64("vec_id"), F.lit(4096))
    part = numbered.groupBy("v", piece.alias("piece")).agg(
        F.count("*").alias("copies"), smallest(F.collect_set("vec_id")).alias("ids")
    )
    whole = part.groupBy("v").agg(
        F.sum("copies").alias("copies"), smallest(F.flatten(F.collect_list("ids"))).alias("ids")
    )
    return whole.select("v", F.element_at("ids", 1).alias("vec_id"), "copies", "ids")


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equally long vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def blocks(n: int, size: int) -> Iterator[slice]:
    for a in range(0, n, size):
        yield slice(a, min(n, a + size))
