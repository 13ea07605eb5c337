"""Profiles of the source and distributions used to set thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.functions.cleaning import trim_flag
from cardlens.operators.history import Slicing
from cardlens.operators.rules import card_hour_counts, card_previous_txn, is_state_change
from cardlens.operators.selection import summaries

# Percentiles and limits of the distribution reports.
CARD_HOUR_PERCENTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
CARD_HOUR_LIMITS = (5, 20, 50)
GAP_PERCENTILES = {"p10": 0.1, "p25": 0.25, "p50": 0.5}
GAP_LIMITS_MINUTES = (5, 10, 15, 30)
AMOUNT_PERCENTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``100 * part / whole`` as DOUBLE, NULL for an empty whole."""
    share = F.lit(100.0) * part / F.nullif(whole, F.lit(0))
    return share if digits is None else F.round(share, digits)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


# --- source --------------------------------------------------------------------


def filter_years(df: DataFrame, years: Sequence[int]) -> DataFrame:
    return df.where(F.col("year").isin(list(years)))


def year_fraud_profile(df: DataFrame, total: bool = False) -> DataFrame:
    """Rows, frauds and fraud share per year; ``total=True`` adds a row with year NULL."""
    counts = df.groupBy("year").agg(
        F.count(F.lit(1)).alias("total"), F.sum("is_fraud").cast("bigint").alias("fraud")
    )
    if total:
        # rolling up the few yearly rows instead of expanding every input row
        known = counts.where(F.col("year").isNotNull())
        counts = known.rollup("year").agg(
            F.sum("total").alias("total"), F.sum("fraud").alias("fraud")
        )
    pct = percent(F.col("fraud"), F.col("total"), 4)
    return counts.withColumn("fraud_pct", pct).orderBy(F.col("year").asc_nulls_last())


def fraud_flag_values(source: DataFrame, flag: str = "Is Fraud?") -> DataFrame:
    """The distinct values of the source flag, trimmed and sorted."""
    value = trim_flag(F.col(f"`{flag}`")).alias("flag_value")
    return source.select(value).distinct().orderBy(F.col("flag_value").asc_nulls_last())


def top_fraud_years(profile: DataFrame, n: int = 5) -> DataFrame:
    """The years with most frauds from a ``year_fraud_profile``; none without fraud."""
    return (
        profile.where(F.col("year").isNotNull() & (F.col("fraud") > 0))
        .select("year", "fraud")
        .orderBy(F.desc("fraud"), "year")
        .limit(n)
    )


def day_fraud_profile(df: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Rows and frauds per day, for the candidate years if given."""
    rows = df if years is None else filter_years(df, years)
    return rows.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("total"), F.sum("is_fraud").cast("bigint").alias("fraud")
    )


def prepared_summary(df: DataFrame) -> DataFrame:
    """One row: rows, frauds and fraud share of a prepared data set."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("is_fraud"), F.lit(0)).alias("n_frauds"),
    )
    return counts.withColumn("fraud_pct", percent(F.col("n_frauds"), F.col("n_rows"), 3))


# --- distributions ---------------------------------------------------------------


def card_hour_distribution(
    df: DataFrame, card_keys: Sequence[str] = ("card_id",)
) -> DataFrame:
    """One row describing the number of transactions per card and clock hour."""
    n = F.col("txn_in_hour").cast("double")
    return describe(card_hour_counts(df, card_keys), n, CARD_HOUR_PERCENTILES)


def card_hour_exceedance(
    df: DataFrame,
    card_keys: Sequence[str] = ("card_id",),
    limits: Sequence[int] = CARD_HOUR_LIMITS,
) -> DataFrame:
    """Per limit, the share of card-hours with more transactions."""
    above = {f"> {k}": F.col("txn_in_hour") > k for k in limits}
    return _shares(card_hour_counts(df, card_keys), above, limits, "more_than", "pct_of_card_hours")


def previous_states(
    df: DataFrame,
    card_keys: Sequence[str] = ("card_id",),
    tiebreak: Sequence[str] = (),
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """Only what reports on state changes need: key, time and state, and those before.

    Without ``tiebreak`` ties are broken by a hash of the row, made once.
    """
    ties = list(tiebreak)
    if not ties:
        df, ties = df.withColumn("_row_hash", F.xxhash64(*df.columns)), ["_row_hash"]
    wanted = [*card_keys, "event_ts", "merchant_state", *ties]
    return card_previous_txn(df.select(*dict.fromkeys(wanted)), card_keys, ties, slicing)


def state_changes(
    df: DataFrame,
    card_keys: Sequence[str] = ("card_id",),
    tiebreak: Sequence[str] = (),
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """Transactions in another state than the card's previous one, with the gap."""
    return card_previous_txn(df, card_keys, tiebreak, slicing).where(is_state_change())


def state_change_gap_distribution(
    df: DataFrame,
    card_keys: Sequence[str] = ("card_id",),
    tiebreak: Sequence[str] = (),
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """One row describing the minutes between transactions that change state."""
    rows = previous_states(df, card_keys, tiebreak, slicing)
    return gap_distribution(rows)


def gap_distribution(rows: DataFrame) -> DataFrame:
    """``state_change_gap_distribution`` of ``previous_states``."""
    return describe(rows.where(is_state_change()), F.col("gap_min"), GAP_PERCENTILES)


def state_change_share(
    df: DataFrame,
    card_keys: Sequence[str] = ("card_id",),
    tiebreak: Sequence[str] = (),
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """One row: number of state changes and their share of all transactions."""
    return change_share(previous_states(df, card_keys, tiebreak, slicing))


def change_share(rows: DataFrame) -> DataFrame:
    """``state_change_share`` of ``previous_states``."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("n_transactions"),
        count_where(is_state_change()).alias("n_state_changes"),
    )
    pct = percent(F.col("n_state_changes"), F.col("n_transactions"), 4)
    return counts.withColumn("pct_of_transactions", pct)


def state_change_within(
    df: DataFrame,
    card_keys: Sequence[str] = ("card_id",),
    tiebreak: Sequence[str] = (),
    limits: Sequence[int] = GAP_LIMITS_MINUTES,
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """Per limit, the share of state changes within that many minutes."""
    return changes_within(previous_states(df, card_keys, tiebreak, slicing), limits)


def changes_within(rows: DataFrame, limits: Sequence[int] = GAP_LIMITS_MINUTES) -> DataFrame:
    """``state_change_within`` of ``previous_states``."""
    changes = rows.where(is_state_change())
    within = {f"<= {k}": F.col("gap_min") <= k for k in limits}
    return _shares(changes, within, limits, "within_minutes", "pct_of_changes")


def amount_by_label(df: DataFrame) -> DataFrame:
    """Amounts of legitimate and of fraudulent transactions, one row each."""
    return describe(df, F.col("amount"), AMOUNT_PERCENTILES, ["is_fraud"])


def describe(
    df: DataFrame, value: Column, percentiles: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact percentiles of ``value``.

    NULL, NaN and infinities are left out. ``by`` may name one label column with few
    distinct values; a label with no value left has count 0 and NULLs, and rows without
    a label are left out.
    """
    rows = df.dropna(subset=list(by)) if by else df
    found = summaries(rows, value, percentiles, by)
    return found.select(
        *by,
        "count",
        *[F.round(name, 6).alias(name) for name in ("mean", "std")],
        "min",
        *[F.round(name, 6).alias(name) for name in percentiles],
        "max",
    )


def _shares(
    df: DataFrame, tests: Mapping[str, Column], limits: Sequence[int], label: str, share: str
) -> DataFrame:
    """One pass over ``df``, then one row per limit with the share that passes."""
    sums = df.agg(
        F.count(F.lit(1)).alias("_all"),
        *[count_where(test).alias(f"_n{i}") for i, test in enumerate(tests.values())],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(limit).alias(label),
                percent(F.col(f"_n{i}"), F.col("_all"), 4).alias(share),
            )
            for i, limit in enumerate(limits)
        ]
    )
    return sums.select(F.inline(rows))
