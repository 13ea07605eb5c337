import pytest

from cardlens.operators import reports

COLUMNS = (
    "year int, month int, day int, merchant_city string, merchant_state string, is_fraud int, "
    "r1_amount_anomaly int, r2_velocity int, r4_odd_hour int, risk_score double, risk_level string"
)


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(
        [
            (2016, 7, 1, "Rome", "Italy", 1, 1, 0, 1, 3.0, "HIGH"),
            (2016, 7, 1, "Rome", "Italy", 0, 1, 0, 0, 2.0, "MEDIUM"),
            (2016, 7, 2, "Rome", "Italy", 1, 0, 0, 0, 0.0, "LOW"),
            (2016, 7, 2, "Oslo", None, 0, 0, 0, 1, 1.0, "LOW"),
            (2016, 7, 2, None, None, 1, 0, 0, 0, 0.0, "LOW"),
        ],
        COLUMNS,
    )


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_levels(scored, nothing):
    assert rows(reports.risk_level_distribution(scored)) == [
        ("HIGH", 1, 1, 100.0), ("MEDIUM", 1, 0, 0.0), ("LOW", 3, 2, 66.667),
    ]
    assert rows(reports.risk_level_counts(scored)) == [("LOW", 3), ("HIGH", 1), ("MEDIUM", 1)]
    assert sorted(rows(reports.risk_fraud_crosstab(scored))) == [
        ("HIGH", 0, 1), ("LOW", 1, 2), ("MEDIUM", 1, 0),
    ]
    assert rows(reports.risk_level_distribution(nothing)) == []


def test_rule_quality(scored, nothing):
    assert rows(reports.rule_precision(scored)) == [
        ("r1_amount_anomaly", 2, 1, 50.0, 3, 33.33),
        ("r4_odd_hour", 2, 1, 50.0, 3, 33.33),
        ("r2_velocity", 0, 0, 0.0, 3, 0.0),
    ]
    assert sorted(rows(reports.rule_precision_simple(scored))) == [
        ("r1_amount_anomaly", 50.0, 1, 2), ("r4_odd_hour", 50.0, 1, 2),
    ]
    assert rows(reports.rule_firing_counts(scored)) == [
        ("r1_amount_anomaly", 2, 40.0), ("r2_velocity", 0, 0.0), ("r4_odd_hour", 2, 40.0),
    ]
    # three rules even without rows, with unknown sums
    assert sorted(rows(reports.rule_precision(nothing))) == [
        (r, None, None, None, None, None) for r in ("r1_amount_anomaly", "r2_velocity", "r4_odd_hour")
    ]
    assert rows(reports.rule_precision_simple(nothing)) == []


def test_no_frauds_give_zero_recall(scored):
    got = rows(reports.rule_precision(scored.where("is_fraud = 0")))
    assert {r[4:] for r in got} == {(0, 0.0)}


def test_alignment(scored, nothing):
    assert rows(reports.overall_alignment(scored)) == [(3, 1, 33.3333, 3, 60.0, 33.3333)]
    assert rows(reports.overall_alignment(nothing)) == [(0, 0, None, 0, None, None)]


def test_days_and_places(scored):
    assert rows(reports.daily_fraud_breakdown(scored)) == [(2016, 7, 1, 2, 1, 1, 2), (2016, 7, 2, 3, 2, 0, 1)]
    assert rows(reports.fraud_hotspots(scored)) == [
        ("Rome", "Italy", 2, 2, 100.0), (None, None, 1, 1, 100.0),
    ]
    assert rows(reports.fraud_hotspots(scored, all_txns=True)) == [
        ("Rome", "Italy", 3, 2, 66.667), (None, None, 1, 1, 100.0), ("Oslo", None, 1, 0, 0.0),
    ]
    assert len(rows(reports.fraud_hotspots(scored, top=1))) == 1
