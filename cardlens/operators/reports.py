"""Reports over the scored table.

Each reads the table once; ``operators.cells`` reads it once for all of them. Either way
aggregates of the same meaning go through the functions whose names begin with ``finish_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.operators.profiling import count_where, percent
from cardlens.sources.schema import DAY_COLUMNS, RISK_LEVELS, RULE_COLUMNS


def _level_order():
    order = F.when(F.lit(False), F.lit(0))
    for position, level in enumerate(RISK_LEVELS, start=1):
        order = order.when(F.col("risk_level") == level, F.lit(position))
    return order


def risk_level_counts(df: DataFrame) -> DataFrame:
    """Transactions per level, most frequent first."""
    return finish_level_counts(df.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n_transactions")))


def finish_level_counts(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("n_transactions"), "risk_level")


def risk_level_distribution(df: DataFrame) -> DataFrame:
    """Transactions, frauds and fraud rate per level, from HIGH to LOW."""
    return finish_levels(
        df.groupBy("risk_level").agg(
            F.count(F.lit(1)).alias("n_transactions"),
            F.sum("is_fraud").alias("n_real_frauds"),
        )
    )


def finish_levels(counts: DataFrame) -> DataFrame:
    pct = percent(F.col("n_real_frauds"), F.col("n_transactions"), 3)
    return counts.withColumn("fraud_rate_pct", pct).orderBy(_level_order())


def rule_totals(df: DataFrame) -> DataFrame:
    """One row per rule: flagged, correctly flagged, and the totals of the table."""
    marked = (F.col("is_fraud") == 1).cast("int")
    return weighted_rule_totals(df, F.lit(1), F.col("is_fraud"), marked)


def weighted_rule_totals(df: DataFrame, n: Column, frauds: Column, marked: Column) -> DataFrame:
    """``rule_totals`` where a row stands for ``n`` transactions with the same flags.

    Of these ``marked`` are known frauds, and ``frauds`` is the sum of their labels.
    """
    sums = [F.sum(n).cast("bigint").alias("_rows"), F.sum(frauds).cast("bigint").alias("_frauds")]
    for rule in RULE_COLUMNS:
        hits = F.when(F.col(rule) == 1, F.coalesce(marked, F.lit(0))).otherwise(0)
        sums += [
            F.sum(F.col(rule) * n).cast("bigint").alias(f"{rule}_flagged"),
            F.sum(hits).cast("bigint").alias(f"{rule}_correct"),
        ]
    per_rule = [
        F.struct(
            F.lit(rule).alias("rule_name"),
            F.col(f"{rule}_flagged").alias("n_flagged"),
            F.col(f"{rule}_correct").alias("n_correct"),
            F.col("_frauds").alias("total_real_frauds"),
            F.col("_rows").alias("n_transactions"),
        )
        for rule in RULE_COLUMNS
    ]
    # a global aggregate has one row even without input, so all rules always show
    return df.agg(*sums).select(F.inline(F.array(*per_rule)))


def rule_precision(df: DataFrame) -> DataFrame:
    """Per rule: flagged, correct, precision, all frauds, recall; best precision first."""
    return finish_precision(rule_totals(df))


def finish_precision(totals: DataFrame) -> DataFrame:
    def rate(part: str, whole: str):
        return F.when(F.col(whole) == 0, F.lit(0.0)).otherwise(
            percent(F.col(part), F.col(whole), 2)
        )

    return (
        totals.select(
            "rule_name",
            "n_flagged",
            "n_correct",
            rate("n_correct", "n_flagged").alias("precision_pct"),
            "total_real_frauds",
            rate("n_correct", "total_real_frauds").alias("recall_pct"),
        )
        .orderBy(F.desc("precision_pct"), "rule_name")
    )


def rule_precision_simple(df: DataFrame) -> DataFrame:
    """Precision of the rules that flagged anything."""
    return finish_precision_simple(rule_totals(df))


def finish_precision_simple(totals: DataFrame) -> DataFrame:
    pct = percent(F.col("n_correct"), F.col("n_flagged"), 2)
    return totals.where(F.col("n_flagged") > 0).select(
        "rule_name", pct.alias("precision_pct"), "n_correct", "n_flagged"
    )


def rule_firing_counts(df: DataFrame) -> DataFrame:
    """Flagged transactions per rule and their share of the traffic."""
    return finish_firing(rule_totals(df))


def finish_firing(totals: DataFrame) -> DataFrame:
    pct = percent(F.col("n_flagged"), F.col("n_transactions"), 4)
    return totals.select("rule_name", "n_flagged", pct.alias("pct_of_traffic"))


def overall_alignment(df: DataFrame) -> DataFrame:
    """One row: how the flagged transactions cover the real frauds."""
    flagged = F.col("risk_score") > 0
    totals = df.agg(
        F.count(F.lit(1)).alias("n_transactions"),
        F.coalesce(F.sum("is_fraud"), F.lit(0)).alias("real_frauds"),
        count_where(flagged & (F.col("is_fraud") == 1)).alias("frauds_caught"),
        count_where(flagged).alias("n_flagged"),
    )
    return finish_alignment(totals)


def finish_alignment(totals: DataFrame) -> DataFrame:
    return totals.select(
        "real_frauds",
        "frauds_caught",
        percent(F.col("frauds_caught"), F.col("real_frauds"), 4).alias("recall_pct"),
        "n_flagged",
        percent(F.col("n_flagged"), F.col("n_transactions"), 4).alias("flagged_pct"),
        percent(F.col("frauds_caught"), F.col("n_flagged"), 4).alias("precision_pct"),
    )


def risk_fraud_crosstab(df: DataFrame) -> DataFrame:
    """Levels by label; a combination that does not occur counts 0."""
    return df.groupBy("risk_level").agg(
        count_where(F.col("is_fraud") == 0).alias("legit"),
        count_where(F.col("is_fraud") == 1).alias("fraud"),
    )


def daily_fraud_breakdown(df: DataFrame) -> DataFrame:
    """Per day: transactions, frauds, frauds caught by any rule, all flagged."""
    flagged = F.col("risk_score") > 0
    return (
        df.groupBy(*DAY_COLUMNS)
        .agg(
            F.count(F.lit(1)).alias("total_txns"),
            F.sum("is_fraud").alias("real_frauds"),
            count_where(flagged & (F.col("is_fraud") == 1)).alias("frauds_caught"),
            count_where(flagged).alias("total_flagged"),
        )
        .orderBy(*DAY_COLUMNS)
    )


def fraud_hotspots(df: DataFrame, all_txns: bool = False, top: int = 10) -> DataFrame:
    """The merchant cities with most frauds.

    By default only fraudulent rows are counted, so the rate is 100 throughout.
    ``all_txns=True`` counts all rows of a city, which makes the rate telling.
    """
    rows = df if all_txns else df.where(F.col("is_fraud") == 1)
    places = rows.groupBy("merchant_city", "merchant_state").agg(
        F.count(F.lit(1)).alias("total_txns"), F.sum("is_fraud").alias("real_frauds")
    )
    return finish_hotspots(places, top)


def finish_hotspots(places: DataFrame, top: int) -> DataFrame:
    return (
        places.withColumn("fraud_rate_pct", percent(F.col("real_frauds"), F.col("total_txns"), 3))
        .orderBy(
            F.desc("real_frauds"),
            F.col("merchant_city").asc_nulls_last(),
            F.col("merchant_state").asc_nulls_last(),
        )
        .limit(top)
    )
