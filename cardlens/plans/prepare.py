"""From one large source file to a raw zone of daily files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.operators.cleaning import clean_source
from cardlens.operators.profiling import day_fraud_profile
from cardlens.operators.sampling import sample_keep_fraud, sample_keep_fraud_approx
from cardlens.operators.windows import checked_window, extract_window, pick_fraud_window
from cardlens.sources.readers import NoInput, read_raw_transactions, read_source
from cardlens.sources.scratch import store
from cardlens.sources.writers import write_raw_partitions

# Defaults of the preparation step.
CANDIDATE_YEARS = (2010, 2008, 2016, 2015, 2018)
TARGET_ROWS = 200_000
WINDOW_DAYS = 7
SAMPLE_SEED = 42


def prepare_dataset(
    spark: SparkSession,
    source: str,
    raw_root: str,
    years: Sequence[int] = CANDIDATE_YEARS,
    target: int = TARGET_ROWS,
    days: int = WINDOW_DAYS,
    seed: int = SAMPLE_SEED,
    approximate: bool = False,
) -> DataFrame:
    """Pick the richest days, keep all their frauds, fill up to ``target``, write by day.

    Two passes over the source: one to pick the days, one to extract them. The
    picked window is a single row, and knowing it turns the second pass into plain
    filters. The extract is stored, since sampling looks at it several times.
    ``approximate`` samples in the same pass instead: the window's counts are known from
    the profile, so the extract is filtered and written without being stored, and has the
    target's size but for chance (``sample_keep_fraud_approx``).
    Returns the raw zone as it can be read back.
    """
    rows = clean_source(read_source(spark, source))
    window = checked_window(pick_fraud_window(day_fraud_profile(rows, years), days))
    if not window["frauds"] and target < 1:
        raise NoInput("nothing to keep: the picked days have no fraud and the target is 0")
    picked = range(window["first_day"], window["last_day"] + 1)
    chosen = extract_window(rows, window["year"], window["month"], picked)
    if approximate:
        counts = spark.range(1).select(
            F.lit(window["total"]).alias("n_rows"), F.lit(window["frauds"]).alias("n_frauds")
        )
        sample = sample_keep_fraud_approx(chosen, target, counts, seed)
    else:
        sample = sample_keep_fraud(store(chosen, "picked-days"), target, seed)
    write_raw_partitions(sample, raw_root)
    return read_raw_transactions(spark, raw_root)
