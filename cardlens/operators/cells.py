"""All standard reports from one scan of the scored table.

The table is grouped once by several sets of columns: by risk level, by the flags, by day and
by place. What remains is one row per level, combination of flags, day and place. It is
stored, and every report is a small query on it. Sums that a report needs are added up before
anything is shuffled, so a level or a city with most rows is no hot spot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.operators import reports
from cardlens.operators.profiling import count_where
from cardlens.sources.schema import DAY_COLUMNS, RULE_COLUMNS
from cardlens.sources.scratch import store

PLACE_COLUMNS = ("merchant_city", "merchant_state")
GROUPS = {
    "level": ("risk_level",),
    "flags": RULE_COLUMNS,
    "day": DAY_COLUMNS,
    "place": PLACE_COLUMNS,
}
KEYS = tuple(column for columns in GROUPS.values() for column in columns)


def report_cells(scored: DataFrame) -> DataFrame:
    """One row per level, combination of flags, day and place (``kind`` says which).

    ``n`` counts transactions, ``marked`` and ``unmarked`` those with label 1 and 0, ``frauds``
    adds up the labels, ``flagged`` counts those that a rule flagged and ``caught`` the marked
    ones among them. Columns that do not belong to a row's kind are NULL.
    """
    fraud = F.col("is_fraud") == 1
    flagged = F.col("risk_score") > 0
    cells = scored.groupingSets([list(columns) for columns in GROUPS.values()], *KEYS).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("n"),
        F.sum("is_fraud").cast("bigint").alias("frauds"),
        count_where(fraud).alias("marked"),
        count_where(F.col("is_fraud") == 0).alias("unmarked"),
        count_where(flagged).alias("flagged"),
        count_where(flagged & fraud).alias("caught"),
    )
    kind = F.lit(None).cast("string")
    for name, columns in GROUPS.items():
        # one bit a key column, set where the column is not in the group
        number = sum(1 << i for i, key in enumerate(reversed(KEYS)) if key not in columns)
        kind = F.when(F.col("_set") == number, name).otherwise(kind)
    return cells.withColumn("kind", kind).drop("_set")


class ReportCells:
    """The standard reports of one scored table; methods are named like the functions in ``reports``."""

    def __init__(self, scored: DataFrame):
        """Reads ``scored`` once and stores its cells."""
        self.cells = store(report_cells(scored), "report-cells")

    def _kind(self, kind: str) -> DataFrame:
        return self.cells.where(F.col("kind") == kind)

    def _levels(self, **sums: str) -> DataFrame:
        return self._kind("level").select("risk_level", *[F.col(c).alias(name) for name, c in sums.items()])

    def _rule_totals(self) -> DataFrame:
        return reports.weighted_rule_totals(self._kind("flags"), F.col("n"), F.col("frauds"), F.col("marked"))

    def risk_level_counts(self) -> DataFrame:
        return reports.finish_level_counts(self._levels(n_transactions="n"))

    def risk_level_distribution(self) -> DataFrame:
        return reports.finish_levels(self._levels(n_transactions="n", n_real_frauds="frauds"))

    def risk_fraud_crosstab(self) -> DataFrame:
        return self._levels(legit="unmarked", fraud="marked")

    def rule_precision(self) -> DataFrame:
        return reports.finish_precision(self._rule_totals())

    def rule_precision_simple(self) -> DataFrame:
        return reports.finish_precision_simple(self._rule_totals())

    def rule_firing_counts(self) -> DataFrame:
        return reports.finish_firing(self._rule_totals())

    def overall_alignment(self) -> DataFrame:
        def total(column: str) -> Column:
            return F.coalesce(F.sum(column), F.lit(0))

        totals = self._kind("flags").agg(
            total("n").alias("n_transactions"), total("frauds").alias("real_frauds"),
            total("caught").alias("frauds_caught"), total("flagged").alias("n_flagged"),
        )
        return reports.finish_alignment(totals)

    def daily_fraud_breakdown(self) -> DataFrame:
        days = self._kind("day").select(
            *DAY_COLUMNS, F.col("n").alias("total_txns"), F.col("frauds").alias("real_frauds"),
            F.col("caught").alias("frauds_caught"), F.col("flagged").alias("total_flagged"),
        )
        return days.orderBy(*DAY_COLUMNS)

    def fraud_hotspots(self, all_txns: bool = False, top: int = 10) -> DataFrame:
        n, frauds = ("n", "frauds") if all_txns else ("marked", "marked")
        places = self._kind("place") if all_txns else self._kind("place").where(F.col("marked") > 0)
        places = places.select(
            *PLACE_COLUMNS, F.col(n).alias("total_txns"), F.col(frauds).alias("real_frauds")
        )
        return reports.finish_hotspots(places, top)


# The reports that are kept as tables.
GOLD_REPORTS: dict[str, Callable[[ReportCells], DataFrame]] = {
    "risk_level_distribution": ReportCells.risk_level_distribution,
    "rule_precision": ReportCells.rule_precision,
    "daily_fraud_breakdown": ReportCells.daily_fraud_breakdown,
    "fraud_hotspots": ReportCells.fraud_hotspots,
}
