import pytest
from pyspark.sql import functions as F

from cardlens.operators import sampling
from cardlens.operators.profiling import prepared_summary
from cardlens.operators.sampling import sample_error_bound, sample_keep_fraud, sample_keep_fraud_approx


def rows(spark, n=500, frauds=20):
    return spark.range(n).select(
        F.col("id").alias("txn_id"),
        (F.col("id") * 1.5).alias("amount"),
        (F.col("id") < frauds).cast("int").alias("is_fraud"),
    )


@pytest.mark.parametrize("target", [0, 19, 20, 21, 100, 499, 500, 10_000])
def test_exact_size_with_all_frauds(spark, target):
    got = [r["txn_id"] for r in sample_keep_fraud(rows(spark), target).collect()]
    assert len(got) == len(set(got)) == min(max(target, 20), 500)
    assert set(range(20)) <= set(got)


def test_same_rows_however_the_data_is_split(spark):
    df = rows(spark)
    pick = lambda d, **k: {r["txn_id"] for r in sample_keep_fraud(d, 100, **k).collect()}
    first = pick(df)
    assert pick(df.repartition(7)) == first
    assert pick(df.coalesce(1)) == first
    assert pick(df, seed=43) != first


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_copies_share_one_rank(spark, monkeypatch, chunk):
    monkeypatch.setattr(sampling, "COPIES_PER_CHUNK", chunk)
    df = spark.range(300).select(
        F.lit(5).alias("txn_id"), F.lit(None).cast("string").alias("city"), F.lit(0).alias("is_fraud")
    )
    sample = sample_keep_fraud(df, 123)
    assert sample.count() == 123 and sample.columns == df.columns


def test_own_ranking_is_followed(spark):
    by_id = F.col("txn_id") * (1 << 40)
    got = {r["txn_id"] for r in sample_keep_fraud(rows(spark), 100, rank_by=by_id).collect()}
    assert got == set(range(100))
    one_cell = {r["txn_id"] for r in sample_keep_fraud(rows(spark), 100, rank_by=F.col("txn_id")).collect()}
    assert one_cell == got


def test_unlabelled_rows_count_as_legitimate(spark):
    df = rows(spark).withColumn("is_fraud", F.when(F.col("txn_id") % 2 == 0, F.col("is_fraud")))
    got = sample_keep_fraud(df, 60).collect()
    assert len(got) == 60 and sum(r["is_fraud"] == 1 for r in got) == 10


def test_no_rows(spark):
    assert sample_keep_fraud(rows(spark, 0), 10).count() == 0


@pytest.mark.parametrize("ranks", ["id % 3", "7"])
def test_edges_are_cut_until_small(spark, monkeypatch, ranks):
    """All ranks in one cell, or one rank for all: what one task orders stays bounded."""
    monkeypatch.setattr(sampling, "EDGE_ROWS", 10)
    ordered = []
    keep = sampling._first_rows
    monkeypatch.setattr(
        sampling, "_first_rows", lambda edge, *a: ordered.append(edge.count()) or keep(edge, *a)
    )
    df = spark.range(3000).selectExpr("id", f"{ranks} AS r", "cast(id < 20 AS int) AS is_fraud")
    got = [r["id"] for r in sample_keep_fraud(df, 1000, rank_by=F.col("r").cast("bigint")).collect()]
    assert len(got) == len(set(got)) == 1000 and set(range(20)) <= set(got)
    assert all(n <= 10 for n in ordered)


@pytest.mark.parametrize("target", [0, 20, 300, 2_000, 5_000, 100_000])
def test_approximate_size_within_the_stated_bound(spark, target):
    df = rows(spark, 5_000)
    got = {r["txn_id"] for r in sample_keep_fraud_approx(df, target).collect()}
    assert set(range(20)) <= got
    room = max(target - 20, 0)
    assert abs(len(got) - 20 - min(room, 4_980)) <= sample_error_bound(room, 4_980)


def test_approximate_sample_is_one_filter(spark):
    """Known counts leave a single scan; nothing runs or is stored before the result is asked for."""
    df = rows(spark)
    counts = spark.createDataFrame([tuple(prepared_summary(df).first())[:2]], "n_rows bigint, n_frauds bigint")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    first = sample_keep_fraud_approx(df, 100, counts)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    pick = lambda d, **k: {r["txn_id"] for r in sample_keep_fraud_approx(d, 100, **k).collect()}
    assert {r["txn_id"] for r in first.collect()} == pick(df) == pick(df.repartition(7))
    assert pick(df, seed=43) != pick(df)


def test_approximate_sample_of_odd_tables(spark):
    assert sample_keep_fraud_approx(rows(spark, 0), 10).count() == 0
    assert sample_keep_fraud_approx(rows(spark, 20), 10).count() == 20  # frauds only
    assert sample_keep_fraud_approx(rows(spark, 50, 0), 1_000).count() == 50
    unlabelled = rows(spark).withColumn("is_fraud", F.lit(None).cast("int"))
    assert sample_keep_fraud_approx(unlabelled, 1_000).count() == 500
    copies = spark.range(300).select(F.lit(5).alias("txn_id"), F.lit(0).alias("is_fraud"))
    assert sample_keep_fraud_approx(copies, 100).count() in (0, 300)
