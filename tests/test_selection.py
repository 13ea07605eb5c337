import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardlens.operators import selection
from cardlens.operators.selection import exact_quantiles

PS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p99": 0.99, "p100": 1.0}


def both_ways(df, **kwargs):
    return [
        exact_quantiles(df, F.col("v"), PS, one_task=one, **kwargs) for one in (False, True)
    ]


def check(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    expected = np.quantile(values, list(PS.values()))
    for result in both_ways(df):
        assert list(result.first()) == pytest.approx(list(expected), rel=1e-12, abs=1e-12)


def test_uniform_repeated_and_single(spark):
    rng = np.random.default_rng(1)
    check(spark, np.round(rng.gamma(1.0, 50.0, 5000), 2))
    check(spark, rng.normal(0.0, 1e6, 3000))
    check(spark, [5.0] * 100 + [7.0])
    check(spark, [3.25])
    check(spark, [-1e300, -1.0, -1e-300, 0.0, 1e-300, 1.0, 1e300])


@pytest.mark.parametrize("few", [1, 10_000])
def test_values_inside_one_cell(spark, monkeypatch, few):
    """All values share a first-round cell, so later rounds decide, however many they are."""
    monkeypatch.setattr(selection, "FEW_VALUES", few)
    check(spark, 1000.0 + np.arange(5000) * 1e-6)
    check(spark, np.concatenate([np.full(900, -7.5), -7.5 - np.geomspace(1e-9, 1e-3, 300)]))


def test_summaries_agree_with_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(g, float(v)) for g, shift in ((0, 1e9), (1, 0.0), (None, -5.0)) for v in rng.normal(shift, 0.5, 400)]
    df = spark.createDataFrame(rows + [(2, None), (0, float("nan"))], "g int, v double")
    got = {r["g"]: r for r in selection.summaries(df, F.col("v"), PS, ["g"]).collect()}
    assert tuple(got[2])[1:] == (0, *[None] * 10)
    for g in (0, 1, None):
        x = np.array([v for k, v in rows if k == g])
        assert got[g]["count"] == 400 and got[g]["min"] == x.min() and got[g]["max"] == x.max()
        assert got[g]["mean"] == pytest.approx(x.mean(), rel=1e-12)
        assert got[g]["std"] == pytest.approx(x.std(ddof=1), rel=1e-6 if g == 0 else 1e-12)  # a mean of 1e9 has no more digits
    lone = selection.summaries(df.limit(1), F.col("v"), PS).first()
    assert lone["count"] == 1 and lone["std"] is None
    assert tuple(selection.summaries(df.limit(0), F.col("v"), PS).first()) == (0, *[None] * 10)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact_quantiles(df, F.col("v"), PS).first()
    assert list(row) == pytest.approx(list(np.quantile(values, list(PS.values()))), rel=1e-9, abs=1e-9)


def test_by_label_without_null_and_nan(spark):
    rows = [(i % 2, float(i)) for i in range(101)] + [(0, None), (1, float("nan")), (0, float("inf")), (1, float("-inf"))]
    df = spark.createDataFrame(rows, "g int, v double")
    for result in both_ways(df, by=["g"]):
        got = {r["g"]: r for r in result.collect()}
        for g in (0, 1):
            values = [float(i) for i in range(101) if i % 2 == g]
            assert got[g]["p50"] == np.quantile(values, 0.5)
            assert got[g]["p100"] == max(values)


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    for result in both_ways(df):
        assert result.count() == 0
