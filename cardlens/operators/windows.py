"""Find and extract the run of days richest in fraud."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlens.sources.schema import DAY_COLUMNS


class NoWindow(ValueError):
    """No month has a gap-free run of the wanted length."""


def pick_fraud_window(profile: DataFrame, days: int = 7) -> DataFrame:
    """At most one row: the gap-free run of ``days`` within a month with most frauds.

    ``profile`` is a ``day_fraud_profile``: one row per day, so a month is at most
    31 rows. Equal runs are decided for the earlier one.
    """
    run = Window.partitionBy("year", "month").orderBy("day").rangeBetween(0, days - 1)
    return (
        profile.select(
            "year",
            "month",
            F.col("day").alias("first_day"),
            (F.col("day") + days - 1).alias("last_day"),
            F.sum("fraud").over(run).alias("frauds"),
            F.sum("total").over(run).alias("total"),
            F.count(F.lit(1)).over(run).alias("_days"),
        )
        .where(F.col("_days") == days)
        .drop("_days")
        .orderBy(F.desc("frauds"), "year", "month", "first_day")
        .limit(1)
    )


def checked_window(window: DataFrame):
    """The picked window as a row; an error if there is none, a warning without fraud."""
    row = window.first()
    if row is None:
        raise NoWindow("no gap-free run of days found; add more candidate years")
    if not row["frauds"]:
        warnings.warn("the best run of days has no fraud; try other years", stacklevel=2)
    return row


def extract_window(df: DataFrame, year: int, month: int, days: Sequence[int]) -> DataFrame:
    """The rows of the given days; on partitioned data only these folders are read."""
    return df.where(
        (F.col("year") == year) & (F.col("month") == month) & F.col("day").isin(list(days))
    )


def extract_picked(df: DataFrame, window: DataFrame) -> DataFrame:
    """The rows of a picked window, in the same query that picks it.

    The window is spread to one row per day (31 at most), so an equality join on
    the partition columns can prune folders at run time.
    """
    day = F.explode(F.sequence("first_day", "last_day")).alias("day")
    return df.join(F.broadcast(window.select("year", "month", day)), list(DAY_COLUMNS), "left_semi")
