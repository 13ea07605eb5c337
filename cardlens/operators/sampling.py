"""Samples that keep every fraud: of exact size, or in one pass of about the size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.sources.scratch import store

CELL_BITS = 20
RANK_BITS = 60
EDGE_ROWS = 100_000  # so many rows one task orders
COPIES_PER_CHUNK = 1 << 16


def sample_keep_fraud(
    df: DataFrame, target: int = 200_000, seed: int = 42, rank_by: Column | None = None
) -> DataFrame:
    """All rows with ``is_fraud = 1`` plus legitimate rows up to ``target`` in total.

    Legitimate rows are taken in the order of a hash of the row and the seed, so
    the same data gives the same sample however it is split. ``rank_by`` replaces
    the hash by another BIGINT in [0, 2**60), ideally evenly spread; rows that agree
    in it follow a hash of the row.

    Counting rows per cell of the order finds the cell in which the target is reached;
    rows of lower cells pass by a filter alone, and the cell is stored and counted in
    finer cells, until it is small enough to be ordered in one task. Equal rows are
    first merged into a count, so copies cannot pile up there.
    """
    columns = df.columns
    own = F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit((1 << RANK_BITS) - 1))
    ranks = df.withColumns({"_rank": own if rank_by is None else rank_by, "_row_rank": own})
    # frauds come first, in a cell of their own that is never cut
    fraud = F.coalesce(F.col("is_fraud") == 1, F.lit(False))
    cells = [
        F.shiftright(F.col(rank), low).bitwiseAND(F.lit((1 << CELL_BITS) - 1))
        for rank in ("_rank", "_row_rank")
        for low in range(RANK_BITS - CELL_BITS, -1, -CELL_BITS)
    ]
    cells[0] = F.when(fraud, F.lit(-1)).otherwise(cells[0])

    room, edge, parts = target, ranks, []
    for cell in cells:
        found = _cut(edge, cell, room)
        if found is None:  # everything fits
            return reduce(DataFrame.unionByName, [*parts, edge.select(columns)])
        cut, before = found
        parts.append(edge.where(cell < cut).select(columns))
        room, edge = room - before, store(edge.where(cell == cut), "sample-edge")
        if room <= 0 or edge.count() <= EDGE_ROWS:
            break
    if room > 0:
        parts.append(_first_rows(edge, columns, room))
    return reduce(DataFrame.unionByName, parts)


def sample_keep_fraud_approx(
    df: DataFrame,
    target: int = 200_000,
    counts: DataFrame | None = None,
    seed: int = 42,
    rank_by: Column | None = None,
) -> DataFrame:
    """All rows with ``is_fraud = 1`` plus about as many legitimate ones as fill up ``target``.

    One filter over the rows: a legitimate row stays where its hash lies below a limit that
    follows from the number of rows and frauds. ``counts`` holds these in one row (``n_rows``,
    ``n_frauds``), as ``prepared_summary`` gives them or as they are known from day profiles;
    without it a narrow scan inside the plan counts them. Nothing is run or stored here.

    Rows that differ pass independently, so the legitimate part misses its size by more than
    ``sample_error_bound`` only once in a million samples. Copies of one row share its hash and
    stay or go together. The same data gives the same sample however it is split. ``rank_by``
    replaces the hash by another BIGINT in [0, 2**60), evenly spread.
    """
    fraud = F.coalesce(F.col("is_fraud") == 1, F.lit(False))
    if counts is None:
        counts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(fraud).alias("n_frauds"))
    frauds = F.coalesce("n_frauds", F.lit(0))
    legitimate = (F.col("n_rows") - frauds).cast("double")
    rate = F.greatest(F.lit(float(target)) - frauds, F.lit(0.0)) / F.nullif(legitimate, F.lit(0.0))
    limit = counts.select(F.floor(F.least(rate, F.lit(1.0)) * float(1 << RANK_BITS)).cast("bigint").alias("n"))
    own = F.xxhash64(F.lit(seed), *df.columns).bitwiseAND(F.lit((1 << RANK_BITS) - 1))
    return df.where(fraud | (F.coalesce((own if rank_by is None else rank_by) < limit.scalar(), F.lit(False))))


def sample_error_bound(room: int, legitimate: int) -> float:
    """How far the legitimate part of an approximate sample strays from ``room`` rows of ``legitimate``.

    Five standard deviations of a binomial draw: about one sample in a million strays further.
    """
    rate = min(max(room, 0) / legitimate, 1.0) if legitimate else 0.0
    return 5 * (legitimate * rate * (1 - rate)) ** 0.5


def _cut(rows: DataFrame, cell: Column, room: int) -> tuple[int, int] | None:
    """The cell in which ``room`` is passed, and the number of rows in lower ones."""
    counts = rows.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(running), F.lit(0))  # at most 2**CELL_BITS + 1 rows
    passed = counts.withColumn("_before", before).where(
        (F.col("_cell") >= 0) & (F.col("_before") + F.col("_n") > room)
    )
    first = passed.agg(F.min(F.struct("_cell", "_before")).alias("cut")).first()["cut"]
    return None if first is None else (first["_cell"], first["_before"])


def _first_rows(edge: DataFrame, columns: list[str], room: int) -> DataFrame:
    """The first ``room`` rows by rank, counting copies of one row as separate rows."""
    merged = edge.groupBy("_rank", "_row_rank", *columns).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_rank", "_row_rank", *columns).rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("_n").over(running), F.lit(0))
    taken = (
        merged.withColumn("_take", F.least(F.col("_n"), F.lit(room) - before))
        .where(F.col("_take") > 0)
    )
    # repeat merged copies in chunks, so that no single array gets long
    chunks = taken.withColumn(
        "_chunk",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("_take") - 1) / COPIES_PER_CHUNK))),
    )
    size = F.least(F.lit(COPIES_PER_CHUNK), F.col("_take") - F.col("_chunk") * COPIES_PER_CHUNK)
    return chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1), size))).select(columns)
