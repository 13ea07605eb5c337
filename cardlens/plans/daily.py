"""The daily batch: raw zone to scored, registered and reported data."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cardlens.config import RuleConfig
from cardlens.operators.cells import GOLD_REPORTS, ReportCells
from cardlens.operators.cleaning import with_event_ts
from cardlens.plans.scoring import rule_inputs, score_transactions
from cardlens.sources.catalog import register_curated_table, register_days
from cardlens.sources.readers import read_raw_transactions
from cardlens.sources.scratch import discard, new_path
from cardlens.sources.writers import write_curated

RUNS = "_runs"  # hidden from readers of the folder itself


def run_daily_batch(
    spark: SparkSession,
    raw_root: str,
    curated_root: str,
    table: str,
    config: RuleConfig | None = None,
    dynamic: bool = False,
    extra_types: dict[str, str] | None = None,
    staged: bool = True,
) -> DataFrame:
    """Score the raw zone, write the result, then publish it as ``table``.

    A failing step raises and later steps do not run. The raw text is parsed once:
    the rules look at the data several times, and typed columns are far cheaper to
    read again than CSV; the typed copy is freed once the result is written. Rows
    are regrouped by day for the write, whatever files they came from.

    Each run writes below a folder of its own, ``<curated_root>/_runs/<run>``. Only when that
    is complete are the table's days pointed to it, so a run that fails leaves the old
    result as it was, and running again completes. The table then holds this run's days
    alone, or with ``dynamic=True`` these and all other days as before. New columns are added
    to the table. Folders of earlier runs are left for the storage's own retention.

    ``staged=False`` writes ``curated_root`` itself, for readers of the folder: its days are
    replaced in place, and a failed write leaves none.
    """
    config = config or RuleConfig()
    raw = read_raw_transactions(spark, raw_root, extra_types=extra_types)
    path = new_path(spark, "typed-transactions")
    with_event_ts(raw).write.parquet(path)
    typed = spark.read.parquet(path)
    scored = score_transactions(typed, config, rule_inputs(typed, config))
    if not staged:
        write_curated(scored, curated_root, dynamic)
        discard(typed, path)
        return register_curated_table(spark, table, curated_root)
    run = f"{curated_root.rstrip('/')}/{RUNS}/{uuid.uuid4().hex}"
    days = write_curated(scored, run)
    discard(typed, path)
    return register_days(spark, table, curated_root, days, run, evolve=True, only=not dynamic)


def gold_tables(curated: DataFrame, analytics_root: str) -> dict[str, str]:
    """Write the standard reports as Parquet, from one scan, and return their paths."""
    cells = ReportCells(curated)
    paths = {}
    for name, report in GOLD_REPORTS.items():
        paths[name] = f"{analytics_root.rstrip('/')}/{name}"
        report(cells).write.mode("overwrite").parquet(paths[name])
    return paths
