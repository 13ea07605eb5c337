"""Row order within a card: previous rows and trailing totals.

A window over a card puts all its rows into one task, and a card may hold a large
share of all rows. Cards above ``1 / HEAVY_SHARE`` of the rows are therefore cut into
slices along their order: windows run per slice, and what a slice must know about
earlier ones is computed from one row per slice and joined back.

Slices are cut by time, and again where a burst leaves one heavy, down to a single
instant, which is cut by the tiebreaker, for as long as a heavy one can be cut. Only
rows that agree in time and tiebreaker stay together. Cuts are found in the few columns
that define the order, stored once.

No more than HEAVY_SHARE groups can be heavy at a time, so the lists of groups to cut
are broadcast. What is carried between slices is broadcast only if a count allows it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions.timeparts import epoch_us
from cardlens.sources.scratch import joinable, store

HEAVY_SHARE = 20_000
SLICES_PER_SHARE = 2
MIN_PARTS = 16
MAX_PARTS = 1 << 15
KEYLESS_SPREAD = 4096
WHOLE_NUMBERS = ("bigint", "int", "smallint", "tinyint")


@dataclass(frozen=True)
class Slicing:
    """Groups of more than ``heavy_rows`` rows are sliced (more in tables above 20 billion)."""

    heavy_rows: int = 1_000_000


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    carry: Sequence[str],
    tiebreak: Sequence[str] = (),
    slicing: Slicing = Slicing(),
    before: DataFrame | None = None,
) -> DataFrame:
    """Add ``prev_<column>`` for each carried column: its value one row earlier.

    Rows of one key are ordered by the timestamp ``at``, NULL last. Rows of one
    instant follow ``tiebreak`` if that is one whole number, otherwise a hash of
    the tiebreak columns, or of the whole row if there are none. Rows without a
    key belong to no sequence and get NULL.

    ``before`` holds one earlier row a key (``last_rows``), from which its first row here
    goes on. They take part in the order as rows of their own, so no join is needed.
    """
    keys, ties = list(keys), list(tiebreak)
    rows = df.withColumns({"_at": epoch_us(F.col(at)), "_tie": _tie(df, ties)})
    if before is not None:
        if not ties:
            raise ValueError("rows can only go on from earlier ones by a tiebreak that both have")
        names = dict.fromkeys([*keys, at, *ties, *carry])
        old = before.select(*names).withColumns({"_at": epoch_us(F.col(at)), "_tie": _tie(before, ties)})
        rows = rows.withColumn("_old", F.lit(False)).unionByName(
            old.withColumn("_old", F.lit(True)), allowMissingColumns=True
        )
    order = [F.col("_at").asc_nulls_last(), "_tie", *ties]
    payload = F.struct(*carry)

    names = dict.fromkeys([*keys, "_at", "_tie", *ties, *carry])
    narrow, cuts = rows.select(*names), []
    if _any_heavy(narrow, keys, slicing):
        narrow = store(narrow, "row-order")
        cuts = _cuts(narrow, keys, slicing)
    rows = _placed(rows, keys, cuts)
    prev = F.lag(payload).over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    rows = rows.withColumn("_prev", prev)
    if cuts:
        last_first = F.struct(F.col("_at").isNull(), "_at", "_tie", *ties)
        last = (
            _placed(narrow, keys, cuts)
            .where("_heavy")
            .groupBy(*keys, "_slice")
            .agg(F.max_by(payload, last_first).alias("_last"))
        )
        across = Window.partitionBy(*keys).orderBy("_slice")
        carried = last.select(*keys, "_slice", F.lag("_last").over(across).alias("_carried"))
        rows = rows.join(joinable(carried), [*keys, "_slice"], "left").withColumn(
            "_prev", F.coalesce("_prev", "_carried")
        )
    prev = F.when(_has_key(keys), F.col("_prev"))
    if before is not None:
        rows = rows.where(~F.col("_old"))
    return rows.select(*df.columns, *[prev.getField(c).alias(f"prev_{c}") for c in carry])


def last_rows(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    carry: Sequence[str],
    tiebreak: Sequence[str] = (),
    before: DataFrame | None = None,
) -> DataFrame:
    """The last row of each key in the order of ``previous_row``: keys, ``at``, tiebreak, ``carry``.

    Keys that only ``before`` has keep its row. Rows without a key or a time are left out.
    Every task keeps one row a key before anything is shuffled.
    """
    keys, ties = list(keys), list(tiebreak)
    names = list(dict.fromkeys([*keys, at, *ties, *carry]))
    rows = df.select(*names)
    if before is not None:
        rows = rows.unionByName(before.select(*names))
    rows = rows.where(_has_key(keys) & F.col(at).isNotNull())
    last_first = F.struct(epoch_us(F.col(at)), _tie(rows, ties), *ties)
    payload = F.struct(*[name for name in names if name not in keys])
    last = rows.groupBy(*keys).agg(F.max_by(payload, last_first).alias("_last"))
    return last.select(*keys, "_last.*").select(*names)


def _tie(df: DataFrame, ties: list[str]) -> Column:
    if len(ties) == 1 and dict(df.dtypes)[ties[0]] in WHOLE_NUMBERS:
        return F.col(ties[0]).cast("bigint")
    return F.xxhash64(*(ties or df.columns))


def trailing_totals(
    df: DataFrame,
    keys: Sequence[str],
    second: Column,
    amount: Column,
    span_seconds: int,
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """Add ``trailing_sum`` and ``trailing_count`` of ``amount`` over the
    ``span_seconds`` before each row's second, that second itself left out.

    Amounts are summed up by key and second first; everything else happens in that
    narrow table, whose totals are joined back. Sums are exact decimals, so they depend
    neither on the order of addition nor on how the rows are split. An amount that is
    not finite or above 10**18 counts as unknown, like NULL. Rows without a key or a
    time get NULL.
    """
    keys = list(keys)
    rows = df.withColumn("_second", second)
    exact = amount.try_cast("decimal(24,6)")
    usable = _has_key(keys) & F.col("_second").isNotNull()
    moments = (
        rows.where(usable)
        .groupBy(*keys, "_second")
        .agg(
            F.coalesce(F.sum(exact), F.lit(0)).cast("decimal(34,6)").alias("_sum"),
            F.count(exact).alias("_count"),
        )
    )
    # a moment makes three changes
    if _any_heavy(rows.where(usable), keys, slicing, each=3):
        moments = store(moments, "moments")
        # stored as well: the join can then split the rows of one second
        totals = store(_swept(moments, keys, span_seconds, slicing, True), "trailing")
    else:
        totals = _swept(moments, keys, span_seconds, slicing, False)
    return rows.join(totals, [*keys, "_second"], "left").select(
        *df.columns,
        F.col("_trailing_sum").cast("double").alias("trailing_sum"),
        F.col("_trailing_count").cast("bigint").alias("trailing_count"),
    )


def _swept(
    moments: DataFrame, keys: list[str], span: int, slicing: Slicing, heavy: bool
) -> DataFrame:
    """A sweep over changes: every moment adds its amount one second later and takes it
    away once the span has passed. A running sum of the changes, read at the moment
    itself, is its trailing total. Running sums, unlike range frames, can be cut
    into slices."""

    def event(at: Column, sign: int) -> Column:
        return F.struct(
            at.alias("_at"),
            # at one second, changes come before the moment that reads them
            F.lit(0 if sign else 1).cast("bigint").alias("_tie"),
            (F.col("_sum") * sign).cast("decimal(34,6)").alias("_sum"),
            (F.col("_count") * F.lit(sign).cast("bigint")).alias("_count"),
        )

    second = F.col("_second")
    events = F.array(event(second + 1, 1), event(second + 1 + span, -1), event(second, 0))
    changes = moments.select(*keys, F.explode(events).alias("_e")).select(*keys, "_e.*")
    cuts = _cuts(changes, keys, slicing) if heavy else []
    changes = _placed(changes, keys, cuts)
    so_far = (
        Window.partitionBy(*keys, "_slice")
        .orderBy("_at", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    read = changes.withColumns(
        {"_in_sum": F.sum("_sum").over(so_far), "_in_count": F.sum("_count").over(so_far)}
    ).where("_tie = 1")
    old_sum = old_count = F.lit(0)
    if cuts:
        slices = (
            changes.where("_heavy")
            .groupBy(*keys, "_slice")
            .agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"))
        )
        before = (
            Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = slices.select(
            *keys,
            "_slice",
            F.sum("_sum").over(before).alias("_old_sum"),
            F.sum("_count").over(before).alias("_old_count"),
        )
        read = read.join(joinable(carried), [*keys, "_slice"], "left")
        old_sum, old_count = (F.coalesce(c, F.lit(0)) for c in ("_old_sum", "_old_count"))
    return read.select(
        *keys,
        F.col("_at").alias("_second"),
        (F.col("_in_sum") + old_sum).alias("_trailing_sum"),
        (F.col("_in_count") + old_count).alias("_trailing_count"),
    )


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _placed(rows: DataFrame, keys: list[str], cuts: Sequence[DataFrame]) -> DataFrame:
    """Add ``_slice``, never decreasing in (``_at``, ``_tie``) within a key, and
    ``_heavy``, whether the key was cut at all. A slice is the list of its parts, round
    by round. Rows without a key are spread freely."""
    keyless = F.when(~_has_key(keys), F.pmod("_tie", F.lit(KEYLESS_SPREAD)))
    start = F.array(F.coalesce(keyless, F.lit(0)).cast("int"))
    rows = rows.withColumns({"_slice": start, "_heavy": F.lit(False)})
    for heavy in cuts:
        rows = _cut(rows, heavy, [*keys, "_slice"])
    return rows


def _any_heavy(rows: DataFrame, keys: list[str], slicing: Slicing, each: int = 1) -> bool:
    """Whether some key has more than ``heavy_rows`` rows, of which each counts ``each`` times.

    One aggregate over the keys; where it finds none, nothing has to be cut or stored.
    """
    counts = rows.where(_has_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return not counts.where(F.col("_rows") * each > slicing.heavy_rows).isEmpty()


def _cuts(rows: DataFrame, keys: list[str], slicing: Slicing) -> list[DataFrame]:
    """Round by round the short list of groups that are too large and how to cut them.

    Cuts depend on exact counts and extremes only, so rows fall into the same slices
    whenever Spark computes them again. A round cuts a group into at least two parts, and
    groups that cannot be cut are not listed, so the rounds end.
    """
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.greatest(F.lit(slicing.heavy_rows), F.ceil(total / HEAVY_SHARE))
    cuts: list[DataFrame] = []
    while True:
        placed = _placed(rows, keys, cuts)
        candidates = placed.where(F.col("_heavy") if cuts else _has_key(keys))
        heavy = store(_heavy_groups(candidates, [*keys, "_slice"], share), "heavy-groups")
        if heavy.isEmpty():
            return cuts
        cuts.append(heavy)


def _sliced(rows: DataFrame, keys: list[str], slicing: Slicing) -> DataFrame:
    return _placed(rows, keys, _cuts(rows, keys, slicing))


def _heavy_groups(rows: DataFrame, group: list[str], share: Column) -> DataFrame:
    """Groups above their share, the range they span, and the number of slices."""
    measured = (
        rows.groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count("_at").alias("_timed"),
            F.min("_at").alias("_from"),
            F.max("_at").alias("_to"),
            F.min("_tie").alias("_first_tie"),
            F.max("_tie").alias("_last_tie"),
        )
        .where(F.col("_rows") > share)
    )
    one_instant = (F.col("_timed") == 0) | (
        (F.col("_timed") == F.col("_rows")) & (F.col("_from") == F.col("_to"))
    )
    pick = lambda tie, at: F.when(F.col("_by_tie"), F.col(tie)).otherwise(F.col(at)).cast("double")
    listed = measured.withColumn("_by_tie", one_instant).select(
        *group,
        "_by_tie",
        pick("_first_tie", "_from").alias("_low"),
        pick("_last_tie", "_to").alias("_high"),
        F.least(
            F.greatest(F.lit(MIN_PARTS), F.ceil(F.col("_rows") * SLICES_PER_SHARE / share)),
            F.lit(MAX_PARTS),
        ).alias("_parts"),
        (F.col("_timed") < F.col("_rows")).alias("_some_untimed"),
    )
    # by time, untimed rows part from timed ones even where the range has no width
    divisible = (F.col("_low") < F.col("_high")) | (~F.col("_by_tie") & F.col("_some_untimed"))
    return listed.where(divisible).drop("_some_untimed")


def _cut(rows: DataFrame, heavy: DataFrame, group: list[str]) -> DataFrame:
    """Cut the listed groups into equal steps of time, or of the tiebreaker."""
    place = F.when(F.col("_by_tie"), F.col("_tie")).otherwise(F.col("_at")).cast("double")
    width = F.nullif((F.col("_high") - F.col("_low")) / F.col("_parts"), F.lit(0.0))
    step = F.least(F.floor((place - F.col("_low")) / width), F.col("_parts") - 1)
    # untimed rows come after all timed ones; a group without width stays whole
    untimed = F.when(~F.col("_by_tie") & F.col("_at").isNull(), F.col("_parts"))
    part = F.coalesce(untimed, step, F.lit(0))
    # all slices of a card that was ever cut move together, and stay in order
    moved = F.col("_heavy") | F.col("_parts").isNotNull()
    finer = F.when(moved, F.concat("_slice", F.array(part.cast("int")))).otherwise(F.col("_slice"))
    return (
        rows.join(F.broadcast(heavy), group, "left")
        .withColumns({"_slice": finer, "_heavy": moved})
        .drop("_by_tie", "_low", "_high", "_parts")
    )
