"""Command line: ``spark-submit -m cardlens <command> ...`` or ``python -m cardlens``.

    diagnose  fraud per year of a source file
    prepare   pick the days richest in fraud and write them as a raw zone
    analyze   distributions of a raw zone, to choose thresholds
    score     score a raw zone and report how the rules meet the label
    daily     raw zone to curated table, with optional report tables
    report    the standard reports of a curated table
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from cardlens.config import RuleConfig
from cardlens.operators import profiling, reports
from cardlens.operators.cells import ReportCells
from cardlens.operators.cleaning import clean_source, with_event_ts
from cardlens.plans.daily import gold_tables, run_daily_batch
from cardlens.plans.prepare import CANDIDATE_YEARS, TARGET_ROWS, WINDOW_DAYS, prepare_dataset
from cardlens.plans.scoring import score_transactions
from cardlens.session import session_builder
from cardlens.sources.readers import read_raw_transactions, read_source
from cardlens.sources.scratch import store
from cardlens.sources.writers import write_scored_csv


def show(title: str, df: DataFrame) -> None:
    """Print all rows of a report; none has more rows than there are days."""
    print(title)
    kept = store(df, "report")
    kept.show(max(kept.count(), 1), truncate=False)


def diagnose(spark: SparkSession, args: argparse.Namespace) -> None:
    source = read_source(spark, args.input, ["Year", "Is Fraud?"])
    show("Values of the fraud flag", profiling.fraud_flag_values(source))
    profile = profiling.year_fraud_profile(clean_source(source), total=True)
    profile = store(profile, "year-profile")  # a few rows, shown twice
    show("Fraud per year", profile.orderBy(profile["year"].asc_nulls_last()))
    show("Years with most frauds", profiling.top_fraud_years(profile))


def prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = prepare_dataset(
        spark, args.input, args.output, args.candidate_years, args.target, args.days,
        approximate=args.approximate,
    )
    show(f"Prepared under {args.output}", profiling.prepared_summary(rows))


def analyze(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = _raw(spark, args.input)
    keys = args.card_keys
    show("Transactions per card and hour", profiling.card_hour_distribution(rows, keys))
    show("Share of busy card-hours", profiling.card_hour_exceedance(rows, keys))
    before = store(profiling.previous_states(rows, keys), "previous-states")
    show("Minutes at a change of state", profiling.gap_distribution(before))
    show("Changes of state", profiling.change_share(before))
    show("Quick changes of state", profiling.changes_within(before))
    show("Amounts by label", profiling.amount_by_label(rows))


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    scored = score_transactions(_raw(spark, args.input), _config(args))
    if args.save:
        scored = store(scored, "scored")
    cells = ReportCells(scored)
    show("Rules", cells.rule_firing_counts())
    show("Risk levels", cells.risk_level_counts())
    show("Against the label", cells.overall_alignment())
    show("Levels by label", cells.risk_fraud_crosstab())
    show("Precision per rule", cells.rule_precision_simple())
    if args.save:
        write_scored_csv(scored, args.save)


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    table = run_daily_batch(
        spark, args.raw, args.curated, args.table, _config(args), dynamic=args.dynamic,
        staged=not args.in_place,
    )
    show("Risk levels", reports.risk_level_counts(table))
    if args.analytics:
        gold_tables(table, args.analytics)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    cells = ReportCells(spark.table(args.table) if args.table else spark.read.parquet(args.curated))
    show("Risk levels", cells.risk_level_distribution())
    show("Rules", cells.rule_precision())
    show("Days", cells.daily_fraud_breakdown())
    show("Places", cells.fraud_hotspots(args.all_txns))


def _raw(spark: SparkSession, root: str) -> DataFrame:
    """Typed transactions, parsed from text once."""
    return store(with_event_ts(read_raw_transactions(spark, root)), "typed-transactions")


def _config(args: argparse.Namespace) -> RuleConfig:
    return RuleConfig(
        card_keys=tuple(args.card_keys),
        velocity_max=args.velocity_max,
        quantile_mode=args.quantile_mode,
    )


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cardlens", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(required=True)

    def command(run, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__)
        sub.set_defaults(run=run)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        return sub

    defaults = RuleConfig()
    command(diagnose, "input")
    sub = command(prepare, "input", "output")
    sub.add_argument("--target", type=int, default=TARGET_ROWS)
    sub.add_argument("--days", type=int, default=WINDOW_DAYS)
    sub.add_argument("--approximate", action="store_true", help="sample in one pass, of about the target's size")
    sub.add_argument("--candidate-years", type=int, nargs="+", default=list(CANDIDATE_YEARS))
    keyed = [command(analyze, "input")]
    sub = command(score, "input")
    sub.add_argument("--save")
    keyed.append(sub)
    sub = command(daily, "raw", "curated", "table")
    sub.add_argument("--analytics")
    sub.add_argument("--dynamic", action="store_true")
    sub.add_argument("--in-place", action="store_true", help="write the curated folder itself, not a folder of the run")
    keyed.append(sub)
    for sub in keyed:
        sub.add_argument("--card-keys", nargs="+", default=list(defaults.card_keys))
    for sub in keyed[1:]:
        sub.add_argument("--velocity-max", type=int, default=defaults.velocity_max)
        sub.add_argument("--quantile-mode", choices=["exact", "approx"], default="exact")
    sub = command(report)
    scored = sub.add_mutually_exclusive_group(required=True)
    scored.add_argument("--table")
    scored.add_argument("--curated", help="a folder of scored days, written in place")
    sub.add_argument("--all-txns", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(session_builder().getOrCreate(), args)


if __name__ == "__main__":
    main()
