"""The scoring rules. Each flag is 0 or 1; missing input gives 0.

Per-card figures come from an aggregate that is joined back, not from a window
over the card: partial aggregation shrinks even a card that holds a third of all
rows before anything is shuffled. See ``joinable`` for how the join is planned.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.config import RuleConfig
from cardlens.functions.geo import haversine_km
from cardlens.functions.timeparts import epoch_hour, epoch_second, minutes_between
from cardlens.operators.history import Slicing, previous_row, trailing_totals
from cardlens.operators.selection import exact_quantiles
from cardlens.sources.scratch import joinable

DEFAULTS = RuleConfig()
SECONDS_PER_DAY = 86_400
# Columns that only serve the rules and are not kept.
HELPER_COLUMNS = ("card_mean", "card_std", "hour_bucket", "txn_in_hour")


def flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


# --- amount against the card's own history -----------------------------------


def card_stats(df: DataFrame, card_keys: Sequence[str] = ("card_id",)) -> DataFrame:
    """Mean and sample standard deviation of amount per card; a lone row has 0."""
    return (
        df.where(_known(card_keys))
        .groupBy(*card_keys)
        .agg(
            F.avg("amount").alias("card_mean"),
            F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("card_std"),
        )
    )


def with_card_stats(df: DataFrame, config: RuleConfig = DEFAULTS) -> DataFrame:
    """Every transaction with the mean and deviation of its card."""
    stats = _joinable(card_stats(df, config.card_keys), config)
    return _attach(df, stats, config.card_keys, ["card_mean", "card_std"])


def amount_ceilings(df: DataFrame, config: RuleConfig = DEFAULTS) -> DataFrame:
    """Per card, the amount above which a transaction is unusual, if below the limit."""
    return ceilings_of(card_stats(df, config.card_keys), config)


def ceilings_of(stats: DataFrame, config: RuleConfig = DEFAULTS) -> DataFrame:
    """``amount_ceilings`` of known ``card_stats``, of whatever days they are.

    Rounded to a millionth: the last bits of a mean depend on summation order,
    and must not decide over a card that always pays the same amount.
    """
    ceiling = F.col("card_mean") + config.amount_std_factor * F.col("card_std")
    ceilings = stats.select(
        *config.card_keys, F.round(ceiling, 6).alias("amount_ceiling")
    )
    # from the limit upwards a ceiling changes nothing, so such cards are left out
    return ceilings.where(F.col("amount_ceiling") < config.amount_limit)


def rule_amount_anomaly(
    df: DataFrame, config: RuleConfig = DEFAULTS, ceilings: DataFrame | None = None
) -> DataFrame:
    """R1: far above the card's mean, or above a fixed limit."""
    if ceilings is None:
        ceilings = _joinable(amount_ceilings(df, config), config)
    amount = F.col("amount")
    unusual = amount > F.col("amount_ceiling")
    rows = _attach(df, ceilings, config.card_keys, ["amount_ceiling"])
    return rows.withColumn(
        "r1_amount_anomaly", flag(unusual | (amount > config.amount_limit))
    ).drop("amount_ceiling")


# --- number of transactions in the same clock hour ----------------------------


def card_hour_counts(df: DataFrame, card_keys: Sequence[str] = ("card_id",)) -> DataFrame:
    """Transactions per card and clock hour (``hour_bucket``: hours since 1970)."""
    return (
        df.where(_known(card_keys) & F.col("event_ts").isNotNull())
        .groupBy(*card_keys, epoch_hour(F.col("event_ts")).alias("hour_bucket"))
        .agg(F.count(F.lit(1)).alias("txn_in_hour"))
    )


def txns_per_card_hour(df: DataFrame, config: RuleConfig = DEFAULTS) -> DataFrame:
    """Every transaction with the number its card made in that hour."""
    rows = df.withColumn("hour_bucket", epoch_hour(F.col("event_ts")))
    counts = _joinable(card_hour_counts(df, config.card_keys), config)
    return _attach(rows, counts, [*config.card_keys, "hour_bucket"], ["txn_in_hour"])


def busy_hours(df: DataFrame, config: RuleConfig = DEFAULTS) -> DataFrame:
    """Only the card-hours above the velocity limit, the few that can set a flag."""
    counts = card_hour_counts(df, config.card_keys)
    return counts.where(F.col("txn_in_hour") > config.velocity_max)


def rule_velocity(
    df: DataFrame, config: RuleConfig = DEFAULTS, busy: DataFrame | None = None
) -> DataFrame:
    """R2: more than ``velocity_max`` transactions of the card in one clock hour."""
    if busy is None:
        busy = _joinable(busy_hours(df, config), config)
    rows = df.withColumn("hour_bucket", epoch_hour(F.col("event_ts")))
    rows = _attach(rows, busy, [*config.card_keys, "hour_bucket"], ["txn_in_hour"])
    return rows.withColumn("r2_velocity", F.col("txn_in_hour").isNotNull().cast("int")).drop(
        "hour_bucket", "txn_in_hour"
    )


# --- high amounts at night -----------------------------------------------------


def amount_quantile(df: DataFrame, config: RuleConfig = DEFAULTS) -> DataFrame:
    """One row, ``amount_quantile``: the amount that starts the top share."""
    q = config.odd_hour_quantile
    if config.quantile_mode == "approx":
        sketch = F.percentile_approx("amount", q, config.quantile_accuracy)
        return df.agg(sketch.alias("amount_quantile"))
    return exact_quantiles(
        df, F.col("amount"), {"amount_quantile": q}, one_task=config.lazy
    )


def rule_odd_hour(
    df: DataFrame, config: RuleConfig = DEFAULTS, quantile: DataFrame | None = None
) -> DataFrame:
    """R4: at night and in the top share of all amounts."""
    quantile = amount_quantile(df, config) if quantile is None else quantile
    hour = F.hour("event_ts")
    night = (hour >= config.odd_hour_start) & (hour < config.odd_hour_end)
    high = F.col("amount") >= quantile.scalar()
    return df.withColumn("r4_odd_hour", flag(night & high))


# --- score ---------------------------------------------------------------------


def risk_score(df: DataFrame, config: RuleConfig = DEFAULTS) -> DataFrame:
    """Weighted sum of the three flags."""
    score = (
        config.weight_amount * F.col("r1_amount_anomaly")
        + config.weight_velocity * F.col("r2_velocity")
        + config.weight_odd_hour * F.col("r4_odd_hour")
    )
    return df.withColumn("risk_score", score)


def risk_level(df: DataFrame, config: RuleConfig = DEFAULTS) -> DataFrame:
    score = F.col("risk_score")
    level = (
        F.when(score >= config.high_cut, "HIGH")
        .when(score >= config.medium_cut, "MEDIUM")
        .otherwise("LOW")
    )
    return df.withColumn("risk_level", level)


def flagged_only(df: DataFrame) -> DataFrame:
    """Transactions that at least one rule flagged."""
    return df.where(F.col("risk_score") > 0)


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*HELPER_COLUMNS)


# --- rules outside the default score -------------------------------------------


def rule_amount_rolling(
    df: DataFrame,
    customer_keys: Sequence[str] = ("user_id",),
    factor: float = 3.0,
    days: int = 30,
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """Amount above ``factor`` times the customer's mean of the preceding days."""
    rows = trailing_totals(
        df, customer_keys, epoch_second(F.col("event_ts")), F.col("amount"),
        days * SECONDS_PER_DAY, slicing,
    )
    # dividing by NULL instead of 0: nothing before means no flag
    mean = F.col("trailing_sum") / F.nullif(F.col("trailing_count"), F.lit(0))
    return rows.withColumn("r_amount_rolling", flag(F.col("amount") > factor * mean)).drop(
        "trailing_sum", "trailing_count"
    )


def rule_state_change(
    df: DataFrame,
    card_keys: Sequence[str] = ("card_id",),
    max_minutes: float = 60.0,
    tiebreak: Sequence[str] = (),
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """Another state than the card's previous transaction, less than an hour later."""
    rows = card_previous_txn(df, card_keys, tiebreak, slicing)
    hit = is_state_change() & (F.col("gap_min") < max_minutes)
    return rows.withColumn("r3_state_change", flag(hit)).drop("prev_ts", "prev_state", "gap_min")


def rule_geo_impossible(
    df: DataFrame,
    lat: str,
    lon: str,
    card_keys: Sequence[str] = ("card_id",),
    max_km: float = 500.0,
    max_minutes: float = 60.0,
    tiebreak: Sequence[str] = (),
    slicing: Slicing = Slicing(),
) -> DataFrame:
    """Further from the card's previous transaction than one can travel in the time."""
    rows = previous_row(df, card_keys, "event_ts", ["event_ts", lat, lon], tiebreak, slicing)
    distance = haversine_km(
        F.col(f"prev_{lat}"), F.col(f"prev_{lon}"), F.col(lat), F.col(lon)
    )
    gap = minutes_between(F.col("prev_event_ts"), F.col("event_ts"))
    hit = (distance > max_km) & (gap <= max_minutes)
    return rows.withColumn("r3_geo_impossible", flag(hit)).select(*df.columns, "r3_geo_impossible")


def card_previous_txn(
    df: DataFrame,
    card_keys: Sequence[str] = ("card_id",),
    tiebreak: Sequence[str] = (),
    slicing: Slicing = Slicing(),
    before: DataFrame | None = None,
) -> DataFrame:
    """Time and state of the card's previous transaction, and minutes since then.

    ``before`` holds the last transactions of the days before (``last_txns``); then ``df`` is
    only what came after them.
    """
    rows = previous_row(
        df, card_keys, "event_ts", ["event_ts", "merchant_state"], tiebreak, slicing, before
    )
    return rows.withColumnsRenamed(
        {"prev_event_ts": "prev_ts", "prev_merchant_state": "prev_state"}
    ).withColumn("gap_min", minutes_between(F.col("prev_ts"), F.col("event_ts")))


def is_state_change() -> Column:
    """The previous state is known and differs; a missing current state differs too."""
    same = F.col("merchant_state").eqNullSafe(F.col("prev_state"))
    return F.col("prev_state").isNotNull() & ~same


# --- shared --------------------------------------------------------------------


def _known(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _joinable(facts: DataFrame, config: RuleConfig) -> DataFrame:
    return joinable(facts, config.lazy, config.broadcast_rows)


def _attach(
    df: DataFrame, facts: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Left join that keeps the column order of ``df`` and appends ``columns``."""
    return df.join(facts, list(keys), "left").select(*df.columns, *columns)
