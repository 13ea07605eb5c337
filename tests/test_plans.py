import pytest
from pyspark.sql import functions as F

from cardlens.config import RuleConfig
from cardlens.operators import reports
from cardlens.operators.cells import GOLD_REPORTS, ReportCells, report_cells
from cardlens.operators.profiling import prepared_summary
from cardlens.operators.windows import NoWindow
from cardlens.plans import daily
from cardlens.plans.daily import gold_tables, run_daily_batch
from cardlens.plans.prepare import prepare_dataset
from cardlens.sources.readers import read_raw_transactions
from cardlens.sources.schema import SOURCE_COLUMNS
from cardlens.sources.scratch import discard, new_path, release, shared_folder, small, store


@pytest.fixture
def source(tmp_path):
    """Nine days of July 2016 with frauds on the last three, and a day of 2015."""
    lines = [",".join(SOURCE_COLUMNS)]
    for day in range(1, 10):
        for i in range(40):
            flag = " Yes" if day >= 7 and i < 3 else "No"
            amount = 900 if flag == " Yes" else 5 + i
            lines.append(f"{i % 4},{i % 3},2016,7,{day},{i % 24:02d}:{i:02d},${amount}.50,Chip,{i},Rome,Italy,5411,{flag}")
    lines.append("1,1,2015,7,1,10:00,$5.00,Chip,1,Rome,Italy,5411,Yes")
    path = tmp_path / "source.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_from_source_to_reports(spark, source, tmp_path):
    raw, curated = str(tmp_path / "raw"), str(tmp_path / "curated")
    prepare_dataset(spark, source, raw, target=100)
    rows = read_raw_transactions(spark, raw)
    assert tuple(prepared_summary(rows).first()) == (100, 9, 9.0)
    assert {r["day"] for r in rows.where("is_fraud = 1").collect()} == {7, 8, 9}
    assert rows.agg(F.min("day"), F.max("day")).first() == (3, 9)

    table = run_daily_batch(spark, raw, curated, "scored_week", RuleConfig(velocity_max=2))
    assert table.count() == 100
    assert not set(table.columns) & {"card_mean", "card_std", "hour_bucket", "txn_in_hour"}
    assert table.where("is_fraud = 1 AND r1_amount_anomaly = 0").count() == 0
    again = run_daily_batch(spark, raw, curated, "scored_week", RuleConfig(velocity_max=2), dynamic=True)
    assert again.count() == 100

    paths = gold_tables(spark.table("scored_week"), str(tmp_path / "gold"))
    assert set(paths) == set(GOLD_REPORTS)
    gold = spark.read.parquet(paths["rule_precision"])
    assert sorted(gold.collect()) == sorted(reports.rule_precision(table).collect())
    spark.sql("DROP TABLE scored_week")


def test_no_candidate_years(spark, source, tmp_path):
    with pytest.raises(NoWindow):
        prepare_dataset(spark, source, str(tmp_path / "raw"), years=[2015])


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", shared_folder(spark))
    assert new_path(spark, "x") != new_path(spark, "x")


def test_stored_tables_have_a_known_size(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    kept = store(df.groupBy("g").count(), "groups")
    assert kept.schema["count"].dataType.simpleString() == "bigint"
    assert small(kept, 3) and not small(kept, 2)


def test_discarded_tables_take_no_space(spark):
    path = new_path(spark, "typed")
    spark.range(10).write.parquet(path)
    discard(spark.read.parquet(path), path)
    assert spark.read.parquet(path).count() == 0


def raw_days(spark, source, tmp_path, name, days):
    from cardlens.operators.cleaning import clean_source
    from cardlens.sources.readers import read_source
    from cardlens.sources.writers import write_raw_partitions

    rows = clean_source(read_source(spark, source)).where(f"year = 2016 AND day IN ({days})")
    root = str(tmp_path / name)
    write_raw_partitions(rows, root)
    return root


def test_a_failed_run_leaves_the_old_table(spark, source, tmp_path, monkeypatch):
    curated, table = str(tmp_path / "curated"), "staged_week"
    first = raw_days(spark, source, tmp_path, "first", "1, 2, 3")
    run_daily_batch(spark, first, curated, table)
    old = sorted(map(str, spark.table(table).collect()))

    second = raw_days(spark, source, tmp_path, "second", "2, 3, 4")
    whole = daily.score_transactions
    broken = F.when(F.col("day") == 4, F.raise_error(F.lit("disk full"))).otherwise(F.col("risk_level"))
    with monkeypatch.context() as patch:
        patch.setattr(daily, "score_transactions", lambda *a: whole(*a).withColumn("risk_level", broken))
        for dynamic in (False, True):
            with pytest.raises(Exception, match="disk full"):
                run_daily_batch(spark, second, curated, table, dynamic=dynamic)
            assert sorted(map(str, spark.table(table).collect())) == old

    days = lambda t: {r["day"]: r["n"] for r in t.groupBy("day").agg(F.count("*").alias("n")).collect()}
    assert days(run_daily_batch(spark, second, curated, table, dynamic=True)) == {1: 40, 2: 40, 3: 40, 4: 40}
    assert days(run_daily_batch(spark, second, curated, table)) == {2: 40, 3: 40, 4: 40}
    # the folder itself shows no runs to its own readers
    in_place = run_daily_batch(spark, first, curated, table, staged=False)
    assert days(in_place) == days(spark.read.parquet(curated)) == {1: 40, 2: 40, 3: 40}
    spark.sql(f"DROP TABLE {table}")


def test_publishing_stopped_half_way_is_completed_by_the_same_call(spark, source, tmp_path, monkeypatch):
    from cardlens.sources import catalog

    curated, table = str(tmp_path / "curated"), "stopped_week"
    first = raw_days(spark, source, tmp_path, "first", "1, 2")
    run_daily_batch(spark, first, curated, table)
    monkeypatch.setattr(catalog, "DAYS_PER_STATEMENT", 1)
    shown = catalog._partition

    def fails(day):
        if day[2] == 4:
            raise RuntimeError("catalog away")
        return shown(day)

    second = raw_days(spark, source, tmp_path, "second", "2, 3, 4")
    with monkeypatch.context() as patch:
        patch.setattr(catalog, "_partition", fails)
        with pytest.raises(RuntimeError, match="away"):
            run_daily_batch(spark, second, curated, table)
    assert spark.table(table).where("day = 1").count() == 40  # each day is whole, old or new
    assert run_daily_batch(spark, second, curated, table).select("day").distinct().count() == 3
    spark.sql(f"DROP TABLE {table}")


def scored(spark):
    rows = [(level, r1, r2, 0, 2016, 7, day, city, None, fraud, 2.0 * r1 + r2)
            for level, r1, r2 in (("HIGH", 1, 1), ("MEDIUM", 1, 0), ("LOW", 0, 1), ("LOW", 0, 0))
            for day in (1, 2) for city in ("Rome", None) for fraud in (0, 1, None)]
    names = ("risk_level string, r1_amount_anomaly int, r2_velocity int, r4_odd_hour int, year int, month int, "
             "day int, merchant_city string, merchant_state string, is_fraud int, risk_score double")
    return spark.createDataFrame(rows, names)


@pytest.mark.parametrize("empty", [False, True])
def test_reports_from_cells_are_those_from_rows(spark, empty):
    rows = scored(spark)
    rows = rows.limit(0) if empty else rows.union(rows.where("day = 1"))
    cells = ReportCells(rows)
    for name in ("risk_level_counts", "risk_level_distribution", "risk_fraud_crosstab", "rule_precision",
                 "rule_precision_simple", "rule_firing_counts", "overall_alignment", "daily_fraud_breakdown",
                 "fraud_hotspots"):
        got, want = getattr(cells, name)(), getattr(reports, name)(rows)
        assert got.dtypes == want.dtypes, name
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    got, want = cells.fraud_hotspots(True, 1), reports.fraud_hotspots(rows, True, 1)
    assert got.collect() == want.collect()


def test_gold_tables_scan_once(spark, tmp_path):
    path = str(tmp_path / "scored")
    scored(spark).write.parquet(path)
    plan = report_cells(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    paths = gold_tables(spark.read.parquet(path), str(tmp_path / "gold"))
    assert set(paths) == set(GOLD_REPORTS)


def test_prepared_with_an_approximate_sample(spark, source, tmp_path):
    raw = str(tmp_path / "raw")
    rows = prepare_dataset(spark, source, raw, target=100, approximate=True)
    assert rows.where("is_fraud = 1").count() == 9 and 55 < rows.count() < 145
    again = prepare_dataset(spark, source, str(tmp_path / "raw2"), target=100, approximate=True)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))


def test_released_tables_take_no_space(spark):
    kept = store(spark.range(1000), "released one's")
    files = kept.inputFiles()
    release(kept)
    assert spark.read.parquet(files[0].rsplit("/", 1)[0].replace("%20", " ")).count() == 0
    release(store(spark.range(0), "nothing"))
