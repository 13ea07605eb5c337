import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.operators import daily_state, rules
from cardlens.operators.history import Slicing

TIE = ("txn_id",)


def many(make, n=600, seed=4):
    """Transactions of a month, some without card, time or amount; one card always pays the same."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        card = None if i % 50 == 7 else int(rng.integers(0, 9))
        day, minute = int(rng.integers(1, 29)), int(rng.integers(0, 1440))
        ts = None if i % 60 == 11 else f"2024-02-{day:02d} {minute // 60:02d}:{minute % 60:02d}"
        amount = 33.33 if card == 3 else None if i % 20 == 5 or card == 5 else float(np.round(rng.gamma(1, 50) + 1e7, 2))
        rows.append((i, card, ts, amount, rng.choice(["a", "b", None]), 0))
    df = make(rows)
    return df.withColumns({p: getattr(F, p)("event_ts") for p in ("year", "month", "day")})


def test_moments_of_days_merge_to_those_of_all_rows(make):
    df = many(make)
    moments = daily_state.card_day_moments(df)
    got = {r.card_id: r for r in daily_state.merged_card_stats(moments).collect()}
    want = {r.card_id: r for r in rules.card_stats(df).collect()}
    assert got.keys() == want.keys()
    for card, w in want.items():
        assert got[card].card_mean == pytest.approx(w.card_mean, rel=1e-12) if w.card_mean is not None else got[card].card_mean is None
        assert got[card].card_std == pytest.approx(w.card_std, rel=1e-9, abs=1e-9)
    # parts in any order, and parts merged before, as one file a week might hold them
    halves = moments.where("day <= 9").unionByName(moments.where("day > 9 OR day IS NULL"))
    again = {r.card_id: r.card_std for r in daily_state.merged_card_stats(halves).collect()}
    assert all(again[c] == pytest.approx(got[c].card_std, rel=1e-9, abs=1e-9) for c in got)
    assert daily_state.merged_card_stats(moments.limit(0)).count() == 0


def test_sketches_of_days_keep_their_rank_error(spark):
    n = 60_000
    df = spark.range(n).select(
        F.lit(2024).alias("year"), F.lit(1).alias("month"), (F.col("id") % 30).cast("int").alias("day"),
        F.pmod(F.col("id") * 7_919, F.lit(n)).cast("double").alias("amount"),
    )
    sketches = daily_state.amount_sketches(df)
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    for q in (0.01, 0.5, 0.9, 0.999):
        value = daily_state.merged_quantile(sketches, q).first()[0]
        assert abs(value / n - q) < 0.01
    low = daily_state.rank_bounds(df, daily_state.merged_quantile(sketches, 0.9)).first()
    assert low.n == n and low.below <= 0.91 and low.up_to >= 0.89
    assert daily_state.merged_quantile(sketches.limit(0), 0.9).first()[0] is None
    unknown = daily_state.amount_sketches(df.withColumn("amount", F.lit(None).cast("double")))
    assert daily_state.merged_quantile(unknown, 0.9).first()[0] is None


@pytest.mark.parametrize("slicing", [Slicing(), Slicing(heavy_rows=20)])
def test_previous_transactions_go_on_over_days(make, slicing):
    df = many(make).where("event_ts IS NOT NULL")
    want = {r.txn_id: r for r in rules.card_previous_txn(df, tiebreak=TIE).collect()}
    last, got = None, {}
    # cards that a part lacks, and a part without rows at all
    for part in ("day <= 5", "day BETWEEN 6 AND 9 AND card_id < 4", "day = 31",
                 "day BETWEEN 6 AND 9 AND (card_id >= 4 OR card_id IS NULL)", "day > 9"):
        own = df.where(part)
        for r in rules.card_previous_txn(own, tiebreak=TIE, slicing=slicing, before=last).collect():
            got[r.txn_id] = r
        last = daily_state.last_txns(own, tiebreak=TIE, before=last)
    assert got == want
    assert last.count() == 9 and set(last.columns) == {"card_id", "event_ts", "merchant_state", "txn_id"}


def test_untimed_rows_come_after_all_days(make):
    df = many(make)
    timed, untimed = df.where("event_ts IS NOT NULL"), df.where("event_ts IS NULL")
    last = daily_state.last_txns(timed, tiebreak=TIE)
    got = {r.txn_id: r for r in rules.card_previous_txn(untimed, tiebreak=TIE, before=last).collect()}
    want = {r.txn_id: r for r in rules.card_previous_txn(df, tiebreak=TIE).where("event_ts IS NULL").collect()}
    assert got == want and len(got) > 5


def test_going_on_needs_a_tiebreak(make):
    df = many(make, 20)
    with pytest.raises(ValueError, match="tiebreak"):
        rules.card_previous_txn(df, before=daily_state.last_txns(df, tiebreak=TIE))
