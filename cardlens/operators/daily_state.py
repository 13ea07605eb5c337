"""What a day leaves behind, so that a later day need not read it again.

Per card and day the moments of the amounts, per day a sketch of them, and after a day the
last transaction of every card. Moments and sketches of many days merge into what a scan of all
rows gives: moments up to rounding, sketches up to their stated rank error. Each is far smaller
than the day's rows, and a day that is learnt again simply replaces its own part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.operators.history import last_rows
from cardlens.sources.schema import DAY_COLUMNS

SKETCH_K = 800  # rank error 0.35 % with 99 % confidence; some 10 KB a day


# --- moments ---------------------------------------------------------------------


def card_day_moments(df: DataFrame, card_keys: Sequence[str] = ("card_id",)) -> DataFrame:
    """Per card and day: count, mean and sum of squared deviations (``m2``) of the amounts.

    Rows without a card are left out, unknown amounts do not count. A card without any
    known amount on a day has count 0. Rows without a day are a day of their own.
    """
    known = [F.col(key).isNotNull() for key in card_keys]
    rows = df.where(F.forall(F.array(*known), lambda k: k))
    return rows.groupBy(*card_keys, *DAY_COLUMNS).agg(
        F.count("amount").alias("n"),
        F.avg("amount").alias("mean"),
        (F.var_pop("amount") * F.count("amount")).alias("m2"),
    )


def merged_card_stats(moments: DataFrame, card_keys: Sequence[str] = ("card_id",)) -> DataFrame:
    """``card_stats`` from the moments of any days: the same figures as from all their rows.

    A card's days are combined one after another in the order of the calendar, each by the
    exact formula for two sets. A list holds one entry a day of one card.
    """
    day = F.struct(*DAY_COLUMNS, "n", "mean", "m2")
    days = moments.groupBy(*card_keys).agg(F.array_sort(F.collect_list(day)).alias("days"))
    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def combined(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        away = b["mean"] - a["mean"]
        both = F.struct(
            n.alias("n"),
            (a["mean"] + away * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + away * away * a["n"] * b["n"] / n).alias("m2"),
        )
        return F.when(b["n"] > 0, both).otherwise(a)

    total = days.select(*card_keys, F.aggregate("days", nothing, combined).alias("t"))
    n, m2 = F.col("t.n"), F.col("t.m2")
    spread = F.when(n > 1, F.sqrt(m2 / F.nullif(n - 1, F.lit(0)))).otherwise(0.0)
    return total.select(
        *card_keys, F.when(n > 0, F.col("t.mean")).alias("card_mean"), spread.alias("card_std")
    )


# --- sketches --------------------------------------------------------------------


def amount_sketches(df: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Per day: a sketch of the amounts and how many there are."""
    return df.groupBy(*DAY_COLUMNS).agg(
        F.kll_sketch_agg_double("amount", k).alias("sketch"), F.count("amount").alias("n")
    )


def merged_quantile(sketches: DataFrame, q: float) -> DataFrame:
    """One row, ``amount_quantile``, from the sketches of any days; NULL without amounts.

    It is an amount that occurs, and its rank is wrong by no more than the sketches' error,
    which merging does not add to.
    """
    merged = sketches.where(F.col("n") > 0).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))
    # an empty sketch has no quantile and raises if asked
    value = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))
    return merged.select(value.alias("amount_quantile"))


def rank_bounds(df: DataFrame, value: DataFrame) -> DataFrame:
    """One row: the shares of amounts below and up to a one-row ``value``, counted exactly."""
    amount, cut = F.col("amount"), value.scalar()
    return df.where(amount.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((amount < cut).cast("double")).alias("below"),
        F.avg((amount <= cut).cast("double")).alias("up_to"),
    )


# --- last transactions -------------------------------------------------------------


def last_txns(
    df: DataFrame,
    card_keys: Sequence[str] = ("card_id",),
    tiebreak: Sequence[str] = (),
    before: DataFrame | None = None,
) -> DataFrame:
    """The last transaction of each card: keys, ``event_ts``, ``merchant_state``, tiebreak.

    ``before`` holds those of earlier days; cards that ``df`` lacks keep theirs. Rows without
    card or time are no card's last. ``card_previous_txn(..., before=...)`` goes on from it.
    """
    return last_rows(df, card_keys, "event_ts", ["event_ts", "merchant_state"], tiebreak, before)
