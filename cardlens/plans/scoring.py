"""Score transactions in two steps: learn the rule inputs, then apply them.

The inputs are three small tables learnt from a few narrow columns. Applying
them touches every row once. Where all three fit a broadcast, the wide rows are
never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cardlens.config import RuleConfig
from cardlens.operators import rules
from cardlens.sources.scratch import joinable, store


@dataclass(frozen=True)
class RuleInputs:
    """What the rules need to know about the whole data before looking at a row."""

    ceilings: DataFrame
    busy: DataFrame
    quantile: DataFrame


def rule_inputs(df: DataFrame, config: RuleConfig = rules.DEFAULTS) -> RuleInputs:
    """Learn the inputs: computed now and stored, or with ``config.lazy`` inside the query."""

    def ready(facts: DataFrame) -> DataFrame:
        return joinable(facts, config.lazy, config.broadcast_rows)

    quantile = rules.amount_quantile(df, config)
    if config.quantile_mode == "approx" and not config.lazy:
        quantile = store(quantile, "quantile")
    return RuleInputs(
        ready(rules.amount_ceilings(df, config)), ready(rules.busy_hours(df, config)), quantile
    )


def score_transactions(
    df: DataFrame, config: RuleConfig = rules.DEFAULTS, inputs: RuleInputs | None = None
) -> DataFrame:
    """Add the three flags, ``risk_score`` and ``risk_level``.

    ``inputs`` may come from other data, for example from a longer history. If
    left out they are learnt from ``df``.
    """
    inputs = inputs or rule_inputs(df, config)
    return (
        df.transform(rules.rule_amount_anomaly, config, inputs.ceilings)
        .transform(rules.rule_velocity, config, inputs.busy)
        .transform(rules.rule_odd_hour, config, inputs.quantile)
        .transform(rules.risk_score, config)
        .transform(rules.risk_level, config)
    )
