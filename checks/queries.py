"""One query per operator, over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.functions.cleaning import parse_amount, parse_fraud_flag
from cardlens.operators import cleaning, daily_state, profiling, reports, rules, windows
from cardlens.operators.cells import GOLD_REPORTS, ReportCells
from cardlens.operators.history import Slicing
from cardlens.operators.sampling import sample_keep_fraud, sample_keep_fraud_approx
from cardlens.operators.selection import exact_quantiles
from cardlens.plans.daily import gold_tables, run_daily_batch
from cardlens.plans.prepare import prepare_dataset
from cardlens.plans.scoring import score_transactions
from cardlens.sources import readers, writers
from cardlens.sources.catalog import register_curated_table, register_days
from cardlens.sources.schema import DAY_COLUMNS
from cardlens.sources.scratch import new_path, store
from checks.adapter import CONFIG, order_days, source_file, source_rows, transactions

Query = Callable[[SparkSession, str], DataFrame]

TIE = ("txn_id",)
ID_TYPE = {"txn_id": "bigint"}
ORDER_YEARS = (1996, 1998, 2000)
# A sketch finer than the test tables have rows, which makes its answer exact.
FINE_SKETCH = replace(CONFIG, quantile_mode="approx", quantile_accuracy=10_000_000)
# Cuts cards that would not be heavy in a large table.
HOT = Slicing(heavy_rows=20)


# --- building blocks ---------------------------------------------------------


def on_transactions(operator, *args, **kwargs) -> Query:
    return lambda spark, sf_dir: operator(transactions(spark, sf_dir), *args, **kwargs)


def on_scored(report, *args, **kwargs) -> Query:
    def run(spark, sf_dir):
        return report(score_transactions(transactions(spark, sf_dir), CONFIG), *args, **kwargs)

    return run


def on_orders(operator, *args, **kwargs) -> Query:
    return lambda spark, sf_dir: operator(order_days(spark, sf_dir), *args, **kwargs)


def new_table() -> str:
    return f"curated_{uuid.uuid4().hex}"


# --- sources and sinks ---------------------------------------------------------


def read_source(spark, sf_dir):
    return readers.read_source(spark, source_file(spark, sf_dir))


def raw_zone(spark, sf_dir) -> str:
    """Daily CSV folders written by this library."""
    root = new_path(spark, "raw")
    writers.write_raw_partitions(transactions(spark, sf_dir).drop("event_ts"), root)
    return root


def read_raw_transactions(spark, sf_dir):
    return readers.read_raw_transactions(spark, raw_zone(spark, sf_dir), extra_types=ID_TYPE)


def write_raw_partitions(spark, sf_dir):
    """Two halves of the month in two calls; then folder names and file contents."""
    root = new_path(spark, "raw")
    rows = transactions(spark, sf_dir).drop("event_ts")
    writers.write_raw_partitions(rows.where("day <= 15"), root)
    writers.write_raw_partitions(rows.where("day > 15"), root)
    files = spark.read.option("header", True).option("recursiveFileLookup", True).csv(root)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(year=[^/]+/month=[^/]+/day=[^/]+)/", 1)
    return files.select(
        folder.alias("folder"), F.col("txn_id").cast("bigint").alias("txn_id"), "time",
        F.col("amount").cast("double").alias("amount"), "merchant_city", "merchant_state",
    )


def read_raw_transactions_own_recursive(spark, sf_dir):
    root = raw_zone(spark, sf_dir)
    return readers.read_raw_transactions(spark, root, recursive=True, extra_types=ID_TYPE)


def quoted_city(rows, name):
    """Cities with quotes, commas and, for one in three, a line break."""
    k = F.col(name)
    end = F.when(F.pmod(k.cast("int"), F.lit(3)) == 0, "\nNorth").otherwise(", North")
    return rows.withColumn(name, F.concat(F.lit('Joe "The Bar"'), k, end))


def read_source_quoted(spark, sf_dir):
    path = new_path(spark, "source")
    rows = quoted_city(source_rows(spark, sf_dir), "Merchant City").drop("Note")
    options = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}
    rows.write.options(**options).csv(path)
    return cleaning.clean_source(readers.read_source(spark, path, multi_line=True))


def read_raw_transactions_quoted(spark, sf_dir):
    root = new_path(spark, "raw")
    rows = quoted_city(transactions(spark, sf_dir).drop("event_ts"), "merchant_city")
    writers.write_raw_partitions(rows, root)
    return readers.read_raw_transactions(spark, root, extra_types=ID_TYPE, multi_line=True)


def read_raw_transactions_recursive(spark, sf_dir):
    """Daily folders whose files hold the calendar columns themselves."""
    root = new_path(spark, "nested")
    rows = transactions(spark, sf_dir).drop("event_ts")
    folder = F.concat(F.lit("d"), F.col("day").cast("string")).alias("folder")
    rows.select("*", folder).write.partitionBy("folder").option("header", True).csv(root)
    return readers.read_raw_transactions(spark, root, recursive=True, extra_types=ID_TYPE)


def write_curated(spark, sf_dir):
    root = new_path(spark, "curated")
    writers.write_curated(score_transactions(transactions(spark, sf_dir), CONFIG), root)
    return readers.read_curated(spark, root)


def write_curated_dynamic(spark, sf_dir):
    """All days, then the last third of the month once more with doubled amounts."""
    root = new_path(spark, "curated")
    rows = transactions(spark, sf_dir)
    writers.write_curated(rows, root)
    late = rows.where(F.col("day") > 20).withColumn("amount", F.col("amount") * 2)
    writers.write_curated(late, root, dynamic=True)
    return readers.read_curated(spark, root)


def write_scored_csv(spark, sf_dir):
    path = new_path(spark, "scored")
    scored = score_transactions(transactions(spark, sf_dir), CONFIG)
    writers.write_scored_csv(scored, path)
    back = spark.read.option("header", True).csv(path)
    return back.select(*[F.col(c).cast(kind).alias(c) for c, kind in scored.dtypes])


def register_curated(spark, sf_dir):
    root = new_path(spark, "curated")
    writers.write_curated(score_transactions(transactions(spark, sf_dir), CONFIG), root)
    return register_curated_table(spark, new_table(), root)


def register_curated_merge_schema(spark, sf_dir):
    """Days up to the 15th lack the risk columns that later days have."""
    root = new_path(spark, "curated")
    table = new_table()
    scored = score_transactions(transactions(spark, sf_dir), CONFIG)
    early = scored.where(F.col("day") <= 15).drop("risk_score", "risk_level")
    writers.write_curated(early, root)
    register_curated_table(spark, table, root)
    writers.write_curated(scored.where(F.col("day") > 15), root, dynamic=True)
    return register_curated_table(spark, table, root, merge_schema=True)


def register_curated_moved(spark, sf_dir):
    """A name that stood for another folder gets the rows of the new one."""
    table = new_table()
    rows = transactions(spark, sf_dir)
    for part in (rows.where("day <= 10"), rows.where("day > 10")):
        root = new_path(spark, "curated")
        writers.write_curated(part, root)
        registered = register_curated_table(spark, table, root)
    return registered


def register_written_days(spark, sf_dir):
    """Two writes, each registered by the days it wrote; a day that no write named stays out."""
    root, table = new_path(spark, "curated"), new_table()
    rows = transactions(spark, sf_dir)
    days = writers.write_curated(rows.where("day <= 20"), root)
    register_days(spark, table, root, days)
    rows.where("day = 1").drop(*DAY_COLUMNS).write.parquet(f"{root}/year=2023/month=1/day=1")
    days = writers.write_curated(rows.where("day > 20"), root, dynamic=True)
    return register_days(spark, table, root, days)


def register_days_evolve(spark, sf_dir):
    """Days up to the 15th lack the risk columns; the later days' files bring them."""
    root, table = new_path(spark, "curated"), new_table()
    scored = score_transactions(transactions(spark, sf_dir), CONFIG)
    early = scored.where(F.col("day") <= 15).drop("risk_score", "risk_level")
    register_days(spark, table, root, writers.write_curated(early, root))
    days = writers.write_curated(scored.where(F.col("day") > 15), root, dynamic=True)
    return register_days(spark, table, root, days, evolve=True)


def daily_batch_again(spark, sf_dir):
    """A run with other weights, then the late days once more with the usual ones."""
    raw, root, table = raw_zone(spark, sf_dir), new_path(spark, "curated"), new_table()
    other = replace(CONFIG, weight_amount=20.0)
    run_daily_batch(spark, raw, root, table, other, extra_types=ID_TYPE)
    run_daily_batch(spark, raw, root, table, CONFIG, dynamic=True, extra_types=ID_TYPE)
    late = new_path(spark, "raw")
    rows = transactions(spark, sf_dir).drop("event_ts").where("day > 20")
    writers.write_raw_partitions(rows.withColumn("amount", F.lit(1.0)), late)
    return run_daily_batch(spark, late, root, table, CONFIG, dynamic=True, extra_types=ID_TYPE)


def daily_batch(spark, sf_dir):
    return run_daily_batch(
        spark, raw_zone(spark, sf_dir), new_path(spark, "curated"), new_table(),
        CONFIG, extra_types=ID_TYPE,
    )


def gold_table(name) -> Query:
    """One report table with all its numbers, read back."""

    def run(spark, sf_dir):
        scored = score_transactions(transactions(spark, sf_dir), CONFIG)
        return spark.read.parquet(gold_tables(scored, new_path(spark, "analytics"))[name])

    return run


def gold(spark, sf_dir):
    """The four report tables, read back as one list of labelled numbers."""
    scored = score_transactions(transactions(spark, sf_dir), CONFIG)
    paths = gold_tables(scored, new_path(spark, "analytics"))
    city = F.concat_ws("/", "merchant_city", "merchant_state")
    shown = {
        "risk_level_distribution": (F.col("risk_level"), "n_real_frauds"),
        "rule_precision": (F.col("rule_name"), "n_correct"),
        "daily_fraud_breakdown": (F.col("day").cast("string"), "frauds_caught"),
        "fraud_hotspots": (city, "real_frauds"),
    }
    parts = [
        spark.read.parquet(paths[name]).select(
            F.lit(name).alias("report"), label.alias("label"), F.col(number).alias("number")
        )
        for name, (label, number) in shown.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def prepare(spark, sf_dir):
    source = source_file(spark, sf_dir)
    return prepare_dataset(spark, source, new_path(spark, "raw"), years=[2024])


def prepare_sampled(spark, sf_dir):
    """A target below the window's rows: how many of each label remain."""
    source = source_file(spark, sf_dir)
    rows = prepare_dataset(spark, source, new_path(spark, "raw"), years=[2024], target=1_000)
    return rows.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("n"))


# --- cleaning ------------------------------------------------------------------


def rename_source_columns(spark, sf_dir):
    return cleaning.rename_source_columns(source_rows(spark, sf_dir)).drop("Note")


def clean_source(spark, sf_dir):
    return cleaning.clean_source(source_rows(spark, sf_dir)).drop("Note")


def parsed_amount(spark, sf_dir):
    amount = parse_amount(F.col("Amount")).alias("amount")
    return source_rows(spark, sf_dir).select(F.col("Note").cast("bigint").alias("txn_id"), amount)


def parsed_flag(spark, sf_dir):
    fraud = parse_fraud_flag(F.col("`Is Fraud?`")).alias("is_fraud")
    return source_rows(spark, sf_dir).select(F.col("Note").cast("bigint").alias("txn_id"), fraud)


def build_event_ts(spark, sf_dir):
    """Signups get month 13, clicks in the first hours an hour past midnight's 24."""
    kind = F.col("use_chip")
    rows = transactions(spark, sf_dir).select(
        "txn_id",
        "year",
        F.when(kind == "signup", F.col("month") + 12).otherwise(F.col("month")).alias("month"),
        "day",
        F.when(
            (kind == "click") & (F.col("time") < "03:00"),
            F.concat(F.lit("25"), F.substr("time", F.lit(3))),
        )
        .otherwise(F.col("time"))
        .alias("time"),
    )
    return cleaning.with_event_ts(rows).select("txn_id", "event_ts")


def drop_helpers(spark, sf_dir):
    """Scoring with its working columns visible, which are then dropped."""
    rows = rules.with_card_stats(transactions(spark, sf_dir))
    return rules.drop_helpers(rules.txns_per_card_hour(rows))


# --- scoring ---------------------------------------------------------------------


def scored_with(**changes) -> Query:
    config = replace(CONFIG, **changes)
    return on_transactions(lambda rows: score_transactions(rows, config))


def card_stats(spark, sf_dir):
    return rules.card_stats(transactions(spark, sf_dir)).select(
        "card_id", F.round("card_mean", 6).alias("card_mean"), F.round("card_std", 6).alias("card_std")
    )


def card_stats_per_row(spark, sf_dir):
    return rules.with_card_stats(transactions(spark, sf_dir)).select(
        "txn_id", F.round("card_mean", 6).alias("card_mean"), F.round("card_std", 6).alias("card_std")
    )


def txns_per_card_hour(spark, sf_dir):
    return rules.txns_per_card_hour(transactions(spark, sf_dir)).select(
        "txn_id", "card_id", "hour_bucket", "txn_in_hour"
    )


def scored_columns(*columns) -> Query:
    return on_scored(lambda scored: scored.select("txn_id", *columns))


def rule_alone(rule, column, *args, **kwargs) -> Query:
    def run(spark, sf_dir):
        return rule(transactions(spark, sf_dir), *args, **kwargs).select("txn_id", column)

    return run


def rule_velocity_5(spark, sf_dir):
    """Five coarse cards, of which hours with more than five transactions are common."""
    rows = transactions(spark, sf_dir).withColumn("coarse", F.pmod("user_id", F.lit(5)))
    config = rules.RuleConfig(velocity_max=5, card_keys=("coarse",))
    return rules.rule_velocity(rows, config).select("txn_id", "r2_velocity")


def rule_amount_rolling_odd(spark, sf_dir):
    """Amounts as text with infinities and numbers beyond any decimal among them."""
    n = F.pmod("txn_id", F.lit(40))
    text = (
        F.when(n == 0, "$Infinity").when(n == 1, "1e19").when(n == 2, "1e400").when(n == 3, "NaN")
        .otherwise(F.col("amount").cast("string"))
    )
    rows = transactions(spark, sf_dir).withColumn("amount", parse_amount(text))
    return rules.rule_amount_rolling(rows, days=3).select("txn_id", "r_amount_rolling")


def rule_geo_impossible(spark, sf_dir):
    """The number in ``props`` stands for a place on a diagonal of the globe."""
    k = F.col("mcc")
    rows = transactions(spark, sf_dir).withColumns({"lat": k * 1.8 - 90, "lon": k * 3.6 - 180})
    return rules.rule_geo_impossible(rows, "lat", "lon", tiebreak=TIE).select(
        "txn_id", "r3_geo_impossible"
    )


# --- profiles, windows, sampling ---------------------------------------------------


def fraud_flag_values(spark, sf_dir):
    return profiling.fraud_flag_values(source_rows(spark, sf_dir))


def top_fraud_years(spark, sf_dir):
    return profiling.top_fraud_years(profiling.year_fraud_profile(order_days(spark, sf_dir)))


def pick_fraud_window(spark, sf_dir):
    return windows.pick_fraud_window(profiling.day_fraud_profile(transactions(spark, sf_dir)))


def pick_fraud_window_years(spark, sf_dir):
    profile = profiling.day_fraud_profile(order_days(spark, sf_dir), ORDER_YEARS)
    return windows.pick_fraud_window(profile)


def extract_window(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return windows.extract_picked(rows, windows.pick_fraud_window(profiling.day_fraud_profile(rows)))


def extract_window_days(spark, sf_dir):
    return windows.extract_window(transactions(spark, sf_dir), 2024, 1, range(8, 15))


def digest_rank():
    """A digest that SQL can repeat, so that row identity is compared."""
    digest = F.md5(F.concat_ws("|", F.lit(42), "txn_id"))
    return F.conv(F.substr(digest, F.lit(1), F.lit(15)), 16, 10).cast("bigint")


def sample(spark, sf_dir):
    return sample_keep_fraud(transactions(spark, sf_dir), target=4000, rank_by=digest_rank())


def sample_approx(spark, sf_dir):
    """Ranked by the same digest; rows and frauds are counted in the plan."""
    return sample_keep_fraud_approx(transactions(spark, sf_dir), target=4000, rank_by=digest_rank())


def sample_sizes(spark, sf_dir):
    """Default ranking: only the sizes are compared."""
    rows = sample_keep_fraud(transactions(spark, sf_dir), target=4000)
    return rows.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("n"))


def card_previous_txn(spark, sf_dir):
    return rules.card_previous_txn(transactions(spark, sf_dir), tiebreak=TIE).select(
        "txn_id", "prev_ts", "prev_state", "gap_min"
    )


def card_previous_txn_sliced(spark, sf_dir):
    rows = rules.card_previous_txn(transactions(spark, sf_dir), tiebreak=TIE, slicing=HOT)
    return rows.select("txn_id", "prev_ts", "prev_state", "gap_min")


# Three parts of the month that are learnt one after another.
PARTS = ("day <= 12", "day BETWEEN 13 AND 20", "day > 20")


def learnt_by_days(spark, sf_dir, name, learn):
    """What ``learn`` keeps of each part, by day; one part is learnt twice."""
    rows, path = transactions(spark, sf_dir), new_path(spark, name)
    for part in (*PARTS, PARTS[1]):
        writers.write_curated(learn(rows.where(part)), path, dynamic=True)
    return readers.read_curated(spark, path)


def card_stats_by_days(spark, sf_dir):
    stats = daily_state.merged_card_stats(learnt_by_days(spark, sf_dir, "moments", daily_state.card_day_moments))
    return stats.select(
        "card_id", F.round("card_mean", 6).alias("card_mean"), F.round("card_std", 6).alias("card_std")
    )


def rule_amount_anomaly_by_days(spark, sf_dir):
    """All rows against ceilings that were learnt day by day."""
    stats = daily_state.merged_card_stats(learnt_by_days(spark, sf_dir, "moments", daily_state.card_day_moments))
    ceilings = rules.ceilings_of(stats, CONFIG)
    rows = rules.rule_amount_anomaly(transactions(spark, sf_dir), CONFIG, ceilings)
    return rows.select("txn_id", "r1_amount_anomaly")


def amount_quantile_by_days(spark, sf_dir):
    """The quantile of merged daily sketches, and whether its exact rank is within 1 % of 0.9."""
    sketches = learnt_by_days(spark, sf_dir, "sketches", daily_state.amount_sketches)
    bounds = daily_state.rank_bounds(transactions(spark, sf_dir), daily_state.merged_quantile(sketches, 0.9))
    near = (F.col("below") <= 0.91) & (F.col("up_to") >= 0.89)
    return bounds.select(F.col("n").alias("n_amounts"), near.alias("within_bound"))


def card_previous_txn_by_days(spark, sf_dir):
    """Each part sees only its own rows and the last transactions that the parts before left."""
    rows, last, found = transactions(spark, sf_dir), None, []
    for part in PARTS:
        own = rows.where(part)
        found.append(rules.card_previous_txn(own, tiebreak=TIE, before=last))
        last = store(daily_state.last_txns(own, tiebreak=TIE, before=last), "last-txns")
    return found[0].unionByName(found[1]).unionByName(found[2]).select("txn_id", "prev_ts", "prev_state", "gap_min")


def card_previous_txn_bucketed(spark, sf_dir):
    path = new_path(spark, "by-card")
    rows = writers.write_by_card(transactions(spark, sf_dir), new_table(), path, order=("event_ts", "txn_id"), buckets=8)
    return rules.card_previous_txn(rows, tiebreak=TIE).select("txn_id", "prev_ts", "prev_state", "gap_min")


def damaged_file(spark, sf_dir) -> str:
    """The source file with a field too many in some records and too few in others."""
    path = new_path(spark, "source")
    rows = source_rows(spark, sf_dir)
    names = [c for c in rows.columns if c != "Note"]
    fields = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names]
    at = F.col("Note").cast("bigint")
    n = F.pmod(at, F.lit(50))
    line = F.when(n == 0, F.concat_ws(",", *fields, F.lit("more"))).when(n == 1, F.concat_ws(",", *fields[:5]))
    lines = rows.select(
        F.pmod(at, F.lit(4)).alias("part"), at.alias("at"), line.otherwise(F.concat_ws(",", *fields)).alias("value")
    )
    # every file begins with the header
    headers = spark.range(4).select(F.col("id").alias("part"), F.lit(-1).alias("at"), F.lit(",".join(names)).alias("value"))
    files = lines.unionByName(headers).repartition(4, "part").sortWithinPartitions("part", "at")
    files.select("part", "value").write.partitionBy("part").text(path)
    return f"{path}/part=*"


def parse_source_good(spark, sf_dir):
    return cleaning.clean_source(readers.parse_source(spark, damaged_file(spark, sf_dir)).good)


def parse_source_quarantine(spark, sf_dir):
    """Bad records in the side folder, and what the writer counted; with the good ones they are all."""
    parsed = readers.parse_source(spark, damaged_file(spark, sf_dir))
    folder = new_path(spark, "quarantine")
    written = writers.write_quarantine(parsed.bad, folder)
    kept = spark.read.parquet(folder).agg(F.count("record").alias("n_bad"))
    return parsed.good.agg(F.count(F.lit(1)).alias("n_good")).crossJoin(kept).select(
        "n_good", "n_bad", F.lit(written).cast("bigint").alias("n_written")
    )


def amount_quantile_by_cells(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return exact_quantiles(rows, F.col("amount"), {"amount_quantile": 0.9})


def amount_by_label_odd(spark, sf_dir):
    """A third label whose amounts are all unknown, and infinities and NaN in the others."""
    label = F.when(F.col("use_chip") == "signup", F.lit(2)).otherwise(F.col("is_fraud"))
    n = F.pmod("txn_id", F.lit(50))
    amount = (
        F.when((label == 2) | (n == 0), None)
        .when(n == 1, float("nan")).when(n == 2, float("inf")).when(n == 3, float("-inf"))
        .otherwise(F.col("amount"))
    )
    rows = transactions(spark, sf_dir).withColumns({"is_fraud": label, "amount": amount})
    return profiling.amount_by_label(rows)


# Reports that no gold table holds, from the shared cells.
CELL_REPORTS = ("risk_level_counts", "risk_fraud_crosstab", "rule_precision_simple", "rule_firing_counts", "overall_alignment")


def from_cells(name) -> Query:
    def run(spark, sf_dir):
        scored = score_transactions(transactions(spark, sf_dir), CONFIG)
        return getattr(ReportCells(scored), name)()

    return run


QUERIES: dict[str, Query] = {
    # sources and sinks
    "read_source": read_source,
    "read_raw_transactions": read_raw_transactions,
    "read_raw_transactions_recursive": read_raw_transactions_recursive,
    "read_raw_transactions_own_recursive": read_raw_transactions_own_recursive,
    "read_raw_transactions_quoted": read_raw_transactions_quoted,
    "read_source_quoted": read_source_quoted,
    "parse_source": parse_source_good,
    "parse_source_quarantine": parse_source_quarantine,
    "write_raw_partitions": write_raw_partitions,
    "write_curated": write_curated,
    "write_curated_dynamic": write_curated_dynamic,
    "write_scored_csv": write_scored_csv,
    "register_curated_table": register_curated,
    "register_curated_table_merge_schema": register_curated_merge_schema,
    "register_curated_table_moved": register_curated_moved,
    "register_days": register_written_days,
    "register_days_evolve": register_days_evolve,
    "run_daily_batch": daily_batch,
    "run_daily_batch_again": daily_batch_again,
    **{f"gold_tables_{name}": gold_table(name) for name in GOLD_REPORTS},
    "gold_tables": gold,
    "prepare_dataset": prepare,
    "prepare_dataset_sampled": prepare_sampled,
    # cleaning and predicates
    "rename_source_columns": rename_source_columns,
    "clean_source": clean_source,
    "parse_amount": parsed_amount,
    "parse_fraud_flag": parsed_flag,
    "build_event_ts": build_event_ts,
    "filter_years": on_orders(profiling.filter_years, ORDER_YEARS),
    "extract_window": extract_window,
    "extract_window_days": extract_window_days,
    "flagged_only": on_scored(rules.flagged_only),
    "drop_helpers": drop_helpers,
    # rules
    "card_stats": card_stats,
    "card_stats_per_row": card_stats_per_row,
    "card_stats_by_days": card_stats_by_days,
    "rule_amount_anomaly_by_days": rule_amount_anomaly_by_days,
    "amount_quantile_by_days": amount_quantile_by_days,
    "rule_amount_anomaly": rule_alone(rules.rule_amount_anomaly, "r1_amount_anomaly", CONFIG),
    "txns_per_card_hour": txns_per_card_hour,
    "rule_velocity": rule_alone(rules.rule_velocity, "r2_velocity", CONFIG),
    "amount_quantile_by_cells": amount_quantile_by_cells,
    "amount_quantile": on_transactions(rules.amount_quantile, CONFIG),
    "amount_quantile_approx": on_transactions(rules.amount_quantile, FINE_SKETCH),
    "rule_odd_hour": rule_alone(rules.rule_odd_hour, "r4_odd_hour", CONFIG),
    "risk_score": scored_columns("risk_score"),
    "risk_level": scored_columns("risk_level"),
    "score_transactions": on_scored(lambda scored: scored),
    "score_transactions_stored_inputs": scored_with(lazy=False),
    "score_transactions_lazy": scored_with(lazy=True),
    "score_transactions_shuffled": scored_with(lazy=False, broadcast_rows=-1),
    # rules outside the default score
    "rule_amount_rolling": rule_alone(rules.rule_amount_rolling, "r_amount_rolling"),
    "rule_amount_rolling_3d": rule_alone(rules.rule_amount_rolling, "r_amount_rolling", days=3),
    "rule_amount_rolling_sliced": rule_alone(
        rules.rule_amount_rolling, "r_amount_rolling", days=3, slicing=HOT
    ),
    "rule_velocity_5": rule_velocity_5,
    "rule_amount_rolling_odd": rule_amount_rolling_odd,
    "rule_state_change": rule_alone(rules.rule_state_change, "r3_state_change", tiebreak=TIE),
    "rule_geo_impossible": rule_geo_impossible,
    "rule_odd_hour_2_5": rule_alone(
        rules.rule_odd_hour, "r4_odd_hour", rules.RuleConfig(odd_hour_start=2)
    ),
    # source profiles
    "year_fraud_profile": on_orders(profiling.year_fraud_profile),
    "year_fraud_profile_total": on_orders(profiling.year_fraud_profile, total=True),
    "fraud_flag_values": fraud_flag_values,
    "top_fraud_years": top_fraud_years,
    "day_fraud_profile": on_orders(profiling.day_fraud_profile, ORDER_YEARS),
    "prepared_summary": on_transactions(profiling.prepared_summary),
    # reports
    "risk_level_counts": on_scored(reports.risk_level_counts),
    "risk_level_distribution": on_scored(reports.risk_level_distribution),
    "rule_precision": on_scored(reports.rule_precision),
    "rule_precision_simple": on_scored(reports.rule_precision_simple),
    "rule_firing_counts": on_scored(reports.rule_firing_counts),
    "overall_alignment": on_scored(reports.overall_alignment),
    "risk_fraud_crosstab": on_scored(reports.risk_fraud_crosstab),
    "daily_fraud_breakdown": on_scored(reports.daily_fraud_breakdown),
    "fraud_hotspots": on_scored(reports.fraud_hotspots),
    "fraud_hotspots_all_txns": on_scored(reports.fraud_hotspots, all_txns=True),
    **{f"{name}_from_cells": from_cells(name) for name in CELL_REPORTS},
    # distributions
    "card_hour_distribution": on_transactions(profiling.card_hour_distribution),
    "card_hour_exceedance": on_transactions(profiling.card_hour_exceedance, limits=(1, 2, 5, 20, 50)),
    "card_previous_txn": card_previous_txn,
    "card_previous_txn_sliced": card_previous_txn_sliced,
    "card_previous_txn_by_days": card_previous_txn_by_days,
    "card_previous_txn_bucketed": card_previous_txn_bucketed,
    "state_change_gap_distribution": on_transactions(
        profiling.state_change_gap_distribution, tiebreak=TIE
    ),
    "state_change_gap_distribution_sliced": on_transactions(
        profiling.state_change_gap_distribution, tiebreak=TIE, slicing=HOT
    ),
    "state_change_share": on_transactions(profiling.state_change_share, tiebreak=TIE),
    "state_change_within": on_transactions(
        profiling.state_change_within, tiebreak=TIE, limits=(5, 10, 15, 30, 600)
    ),
    "state_change_share_sliced": on_transactions(
        profiling.state_change_share, tiebreak=TIE, slicing=HOT
    ),
    "state_change_within_sliced": on_transactions(
        profiling.state_change_within, tiebreak=TIE, limits=(5, 10, 15, 30, 600), slicing=HOT
    ),
    "amount_by_label": on_transactions(profiling.amount_by_label),
    "amount_by_label_by_cells": amount_by_label_odd,
    # windows, order, sampling
    "pick_fraud_window": pick_fraud_window,
    "pick_fraud_window_years": pick_fraud_window_years,
    "order_by_day_time": on_transactions(cleaning.order_by_day_time, tiebreak=TIE),
    "order_by_card_ts": on_transactions(cleaning.order_by_card_ts, tiebreak=TIE),
    "sample_keep_fraud": sample,
    "sample_keep_fraud_sizes": sample_sizes,
    "sample_keep_fraud_approx": sample_approx,
}
