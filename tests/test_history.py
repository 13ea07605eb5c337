import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cardlens.functions.timeparts import epoch_second
from cardlens.operators import history
from cardlens.operators.history import Slicing, previous_row, trailing_totals

SLICINGS = [Slicing(2), Slicing(10), Slicing(40), Slicing()]

START = datetime(2016, 7, 1)


def random_rows(n, seed):
    """One card holds most rows; some cards, times and states are missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        card = rng.choice([1, 1, 1, 1, 2, 3, None])
        minute = rng.choice([rng.randrange(60), rng.randrange(60 * 24 * 40)])
        ts = None if rng.random() < 0.05 else str(START + timedelta(minutes=minute))
        amount = None if rng.random() < 0.05 else round(rng.uniform(-5, 100), 2)
        rows.append((i, card, ts, amount, rng.choice(["A", "B", None]), 0))
    return rows


@pytest.mark.parametrize("slicing", SLICINGS)
def test_previous_row(make, slicing):
    rows = random_rows(400, 3)
    result = previous_row(
        make(rows), ["card_id"], "event_ts", ["merchant_state", "txn_id"], ["txn_id"], slicing
    )
    got = {r["txn_id"]: (r["prev_merchant_state"], r["prev_txn_id"]) for r in result.collect()}
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in rows}
    for card in (1, 2, 3):
        timed = sorted((r for r in rows if r[1] == card and r[2]), key=lambda r: (r[2], r[0]))
        before = None
        for r in timed:
            assert got[r[0]] == ((before[4], before[0]) if before else (None, None))
            before = r
        # rows without a time follow in some fixed order, each exactly once
        rest = {r[0] for r in rows if r[1] == card and not r[2]}
        chain = {got[i][1]: i for i in rest}
        at = before[0]
        for _ in rest:
            at = chain.pop(at)
            assert got[at][0] == by_id[got[at][1]][4]
        assert not chain
    assert all(got[r[0]] == (None, None) for r in rows if r[1] is None)


def slice_sizes(rows, slicing):
    sliced = history._sliced(rows.withColumn("_tie", F.col("txn_id")), ["card_id"], slicing)
    per_slice = sliced.groupBy("card_id", "_heavy", "_slice").count().collect()
    sizes = {}
    for r in per_slice:
        sizes.setdefault((r["card_id"], r["_heavy"]), []).append(r["count"])
    return sizes


def test_heavy_card_is_cut_into_slices(make):
    rows = make(random_rows(400, 3)).withColumn("_at", epoch_second(F.col("event_ts")))
    sizes = slice_sizes(rows, Slicing(80))
    assert max(sizes[(1, True)]) <= 80 and sum(sizes[(1, True)]) > 200
    assert len(sizes[(2, False)]) == len(sizes[(3, False)]) == 1  # others stay whole
    assert len(sizes[(None, False)]) > 20  # rows without a card are spread


@pytest.mark.parametrize("at", ["cast(60 AS bigint)", "cast(NULL AS bigint)"])
def test_one_instant_is_cut_by_the_tiebreaker(spark, at):
    rows = spark.range(300).selectExpr("id AS txn_id", "1 AS card_id", f"{at} AS _at")
    (sizes,) = slice_sizes(rows, Slicing(50)).values()
    assert max(sizes) <= 50


def test_bursts_are_cut_again(spark):
    """Most rows fall into a short part of the range, and most of these into one instant."""
    rows = spark.range(20_000).selectExpr(
        "id AS txn_id", "1 AS card_id",
        "CASE WHEN id % 10 = 0 THEN id * 300 WHEN id % 10 < 4 THEN 1000000 + id % 1000 "
        "ELSE 1000500 END AS _at",
    )
    (sizes,) = slice_sizes(rows, Slicing(100)).values()
    assert max(sizes) <= 100


def test_ties_without_a_tiebreaker_keep_all_rows(make):
    rows = [(i, 1, "2016-07-01 10:00", 1.0, "AB"[i % 2], 0) for i in range(20)]
    result = previous_row(make(rows), ["card_id"], "event_ts", ["txn_id"], slicing=Slicing(3))
    prev = [r["prev_txn_id"] for r in result.collect()]
    assert prev.count(None) == 1 and len(set(prev)) == 20


def test_both_paths_order_ties_alike(make):
    rows = [(i, i % 2, "2016-07-01 10:00", 1.0, "ABC"[i % 3], 0) for i in range(60)]
    for tiebreak in ([], ["txn_id"], ["merchant_state", "txn_id"]):
        prev = [
            {r["txn_id"]: r["prev_txn_id"] for r in
             previous_row(make(rows), ["card_id"], "event_ts", ["txn_id"], tiebreak, s).collect()}
            for s in (Slicing(5), Slicing())
        ]
        assert prev[0] == prev[1]
        if tiebreak == ["txn_id"]:
            assert prev[0] == {i: i - 2 if i > 1 else None for i in range(60)}


@pytest.mark.parametrize("slicing", [SLICINGS[0], SLICINGS[2], SLICINGS[3]])
@pytest.mark.parametrize("span", [3600, 86400 * 3])
def test_trailing_totals(make, span, slicing):
    rows = random_rows(300, 5)
    result = trailing_totals(
        make(rows), ["card_id"], epoch_second(F.col("event_ts")), F.col("amount"), span, slicing
    )
    got = {r["txn_id"]: (r["trailing_sum"], r["trailing_count"]) for r in result.collect()}
    assert len(got) == len(rows)
    parse = lambda text: datetime.fromisoformat(text)
    for i, card, ts, *_ in rows:
        if card is None or ts is None:
            assert got[i] == (None, None)
            continue
        inside = [
            r[3]
            for r in rows
            if r[1] == card and r[2] and r[3] is not None
            and timedelta(seconds=1) <= parse(ts) - parse(r[2]) <= timedelta(seconds=span)
        ]
        assert got[i][1] == len(inside)
        assert got[i][0] == pytest.approx(sum(inside), abs=1e-6)
