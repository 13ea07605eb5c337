import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardlens.operators import profiling
from cardlens.operators.windows import (
    NoWindow, checked_window, extract_picked, extract_window, pick_fraud_window,
)


def days(spark, rows):
    return spark.createDataFrame(rows, "year int, month int, day int, total bigint, fraud bigint")


def test_year_profile(spark):
    df = spark.createDataFrame([(2015, 0)] * 3 + [(2016, 1)] + [(2016, 0)] * 2, "year int, is_fraud int")
    got = [tuple(r) for r in profiling.year_fraud_profile(df, total=True).collect()]
    assert got == [(2015, 3, 0, 0.0), (2016, 3, 1, 33.3333), (None, 6, 1, 16.6667)]
    top = profiling.top_fraud_years(profiling.year_fraud_profile(df, total=True)).collect()
    assert [tuple(r) for r in top] == [(2016, 1)]


def test_top_years_are_limited_and_ordered(spark):
    df = spark.createDataFrame([(2000 + y, 1) for y in range(8) for _ in range(y % 4)], "year int, is_fraud int")
    top = profiling.top_fraud_years(profiling.year_fraud_profile(df)).collect()
    assert [tuple(r) for r in top] == [(2003, 3), (2007, 3), (2002, 2), (2006, 2), (2001, 1)]


def test_flag_values(spark):
    df = spark.createDataFrame([(" Yes ",), ("No",), ("Yes",), (None,)], "`Is Fraud?` string")
    assert [r[0] for r in profiling.fraud_flag_values(df).collect()] == ["No", "Yes", None]


def test_window_needs_every_day(spark):
    rows = [(2016, 7, d, 10, 1) for d in range(1, 9)]
    rows += [(2016, 8, d, 10, 50) for d in (1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13)]  # the 7th is missing
    rows += [(2016, 9, d, 10, 50) for d in range(25, 31)] + [(2016, 10, d, 10, 50) for d in range(1, 4)]
    row = checked_window(pick_fraud_window(days(spark, rows)))
    assert (row.year, row.month, row.first_day, row.last_day, row.frauds, row.total) == (
        2016, 7, 1, 7, 7, 70,
    )


def test_window_ties_and_best(spark):
    rows = [(y, 3, d, 5, 1) for y in (2018, 2016) for d in range(1, 10)]
    assert tuple(pick_fraud_window(days(spark, rows)).first())[:3] == (2016, 3, 1)
    rows.append((2018, 3, 10, 5, 9))
    assert tuple(pick_fraud_window(days(spark, rows)).first())[:3] == (2018, 3, 4)
    assert tuple(pick_fraud_window(days(spark, rows), days=2).first())[:4] == (2018, 3, 9, 10)


def test_no_window_and_no_fraud(spark):
    short = days(spark, [(2016, 7, d, 1, 1) for d in range(1, 7)])
    with pytest.raises(NoWindow):
        checked_window(pick_fraud_window(short))
    clean = days(spark, [(2016, 7, d, 1, 0) for d in range(1, 8)])
    with pytest.warns(UserWarning):
        checked_window(pick_fraud_window(clean))


def test_extraction(spark):
    df = spark.createDataFrame(
        [(y, m, d) for y in (2015, 2016) for m in (6, 7) for d in range(1, 10)],
        "year int, month int, day int",
    ).withColumn("is_fraud", ((F.col("year") == 2016) & (F.col("month") == 7)).cast("int"))
    expected = {(2016, 7, d) for d in range(1, 8)}
    picked = extract_picked(df, pick_fraud_window(profiling.day_fraud_profile(df)))
    assert {tuple(r)[:3] for r in picked.collect()} == expected
    assert {tuple(r)[:3] for r in extract_window(df, 2016, 7, range(1, 8)).collect()} == expected


def test_picking_prunes_folders_at_run_time(spark, tmp_path):
    df = spark.createDataFrame([(2016, 7, d, int(d > 5)) for d in range(1, 20)],
                               "year int, month int, day int, is_fraud int")
    df.write.partitionBy("year", "month", "day").parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    picked = extract_picked(rows, pick_fraud_window(profiling.day_fraud_profile(rows)))
    assert "dynamicpruning" in picked._jdf.queryExecution().executedPlan().toString()
    assert picked.count() == 7


def random_transactions(n=500, seed=2):
    rng = random.Random(seed)
    return [
        (i, rng.choice([1, 1, 2, 3]),
         f"2016-07-{rng.randrange(1, 3):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}",
         round(rng.expovariate(1 / 60), 2), rng.choice(["A", "B", None]), int(rng.random() < 0.2))
        for i in range(n)
    ]


def test_distributions_match_pandas(make):
    rows = random_transactions()
    df = make(rows)
    frame = pd.DataFrame(rows, columns=["txn_id", "card", "ts", "amount", "state", "fraud"])
    frame["ts"] = pd.to_datetime(frame["ts"])

    per_hour = frame.groupby(["card", frame.ts.dt.floor("h")]).size()
    expected = per_hour.describe(percentiles=[0.5, 0.9, 0.95, 0.99])
    assert list(profiling.card_hour_distribution(df).first()) == pytest.approx(list(expected), abs=1e-5)
    shares = {r[0]: r[1] for r in profiling.card_hour_exceedance(df, limits=(1, 5, 9)).collect()}
    assert shares == pytest.approx({k: 100 * (per_hour > k).mean() for k in (1, 5, 9)}, abs=1e-4)

    expected = frame.groupby("fraud")["amount"].describe(percentiles=[0.5, 0.9, 0.99])
    got = {r["is_fraud"]: list(r)[1:] for r in profiling.amount_by_label(df).collect()}
    for label in (0, 1):
        assert got[label] == pytest.approx(list(expected.loc[label]), abs=1e-5)

    frame = frame.sort_values(["card", "ts", "txn_id"])
    prev = frame.groupby("card")[["ts", "state"]].shift(1)
    gap = (frame.ts - prev.ts).dt.total_seconds() / 60
    same = frame.state.eq(prev.state)
    changed = prev.state.notna() & ~same
    expected = gap[changed].describe(percentiles=[0.1, 0.25, 0.5])
    got = profiling.state_change_gap_distribution(df, tiebreak=["txn_id"]).first()
    assert list(got) == pytest.approx(list(expected), abs=1e-5)
    share = profiling.state_change_share(df, tiebreak=["txn_id"]).first()
    assert share["n_state_changes"] == changed.sum()
    within = {r[0]: r[1] for r in profiling.state_change_within(df, tiebreak=["txn_id"]).collect()}
    assert within == pytest.approx(
        {k: 100 * (gap[changed] <= k).mean() for k in (5, 10, 15, 30)}, abs=1e-4
    )


def test_distributions_without_rows(make):
    df = make([])
    assert profiling.state_change_share(df).first()["pct_of_transactions"] is None
    assert profiling.card_hour_distribution(df).first()["count"] == 0
    assert profiling.amount_by_label(df).count() == 0
    assert profiling.prepared_summary(df).first()["n_rows"] == 0


def test_labels_without_values_stay(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1.0), (0, 2.0), (0, nan), (0, inf), (1, None), (1, None), (None, 5.0)]
    got = {r.is_fraud: r for r in profiling.amount_by_label(spark.createDataFrame(rows, "is_fraud int, amount double")).collect()}
    assert set(got) == {0, 1}
    assert (got[0]["count"], got[0]["mean"], got[0]["max"], got[0]["p50"]) == (2, 1.5, 2.0, 1.5)
    assert got[1]["count"] == 0 and got[1]["mean"] is None and got[1]["p50"] is None
