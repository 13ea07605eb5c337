from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardlens.operators import rules
from cardlens.sources import readers, writers
from cardlens.sources.catalog import ColumnConflict, register_curated_table, register_days, registered_days
from cardlens.sources.schema import SOURCE_COLUMNS, TRANSACTION_TYPES

HEADER = ",".join(TRANSACTION_TYPES)
ROW = "7,1,2016,7,{day},{time},{amount},Swipe,42,Rome,Italy,5411,{fraud}"


@pytest.fixture
def nested(tmp_path):
    """Daily files that repeat the calendar columns of their folders."""
    root = tmp_path / "transactions"
    for day in (3, 14):
        folder = root / "year=2016" / "month=07" / f"day={day:02d}"
        folder.mkdir(parents=True)
        lines = [HEADER] + [
            ROW.format(day=day, time=t, amount=a, fraud=f)
            for t, a, f in (("06:21", "12.5", 0), ("23:05", "-99.0", 1), ("bad", "x", 0))
        ]
        (folder / "part.csv").write_text("\n".join(lines) + "\n")
    return str(root)


@pytest.mark.parametrize("recursive", [False, True])
def test_repeated_partition_columns_do_not_shift(spark, nested, recursive):
    df = readers.read_raw_transactions(spark, nested, recursive=recursive)
    assert dict(df.dtypes) == TRANSACTION_TYPES
    assert df.columns == list(TRANSACTION_TYPES)
    rows = {(r.day, r.time): r for r in df.collect()}
    assert len(rows) == 6
    row = rows[(14, "23:05")]
    assert (row.year, row.month, row.amount, row.is_fraud, row.merchant_city) == (
        2016, 7, -99.0, 1, "Rome",
    )
    assert rows[(3, "bad")].amount is None


def test_filters_on_days_prune_folders(spark, nested):
    day = readers.read_raw_transactions(spark, nested).where("year = 2016 AND month = 7 AND day = 3")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert day.count() == 3


def test_missing_and_empty_input(spark, tmp_path):
    with pytest.raises(readers.NoInput):
        readers.read_raw_transactions(spark, str(tmp_path / "absent"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(readers.NoInput):
        readers.read_raw_transactions(spark, str(tmp_path / "empty"), recursive=True)


def test_source_columns_are_picked_by_name(spark, tmp_path):
    header = ["Errors?", *reversed(SOURCE_COLUMNS)]
    values = ["none"] + [f"v{i}" for i in range(len(SOURCE_COLUMNS))]
    (tmp_path / "source.csv").write_text(",".join(header) + "\n" + ",".join(values) + "\n")
    row = readers.read_source(spark, str(tmp_path / "source.csv")).first()
    assert row.asDict() == dict(zip(header[1:], values[1:]))
    narrow = readers.read_source(spark, str(tmp_path / "source.csv"), ["Year", "Is Fraud?"])
    assert narrow.columns == ["Year", "Is Fraud?"]


def test_differing_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="header"):
        readers.read_source(spark, str(tmp_path), ["x", "y"]).collect()


def small(spark):
    columns = "year int, month int, day int, time string, amount double, is_fraud int"
    rows = [(2016, 7, 3, "09:00", 1.0, 0), (2016, 7, 3, "01:00", 2.0, 1), (2016, 7, 14, "05:00", 3.0, 0)]
    return spark.createDataFrame(rows, columns)


def test_raw_layout(spark, tmp_path):
    df = small(spark)
    for name in set(TRANSACTION_TYPES) - set(df.columns):
        df = df.withColumn(name, F.lit(1).cast("string"))
    root = str(tmp_path / "raw")
    writers.write_raw_partitions(df, root)
    files = sorted(Path(root).glob("year=2016/month=07/day=*/*.csv"))
    assert [f.parent.name for f in files] == ["day=03", "day=14"]
    header, *lines = files[0].read_text().splitlines()
    at = header.split(",").index("time")
    assert [line.split(",")[at] for line in lines] == ["01:00", "09:00"]
    back = readers.read_raw_transactions(spark, root)
    assert sorted((r.month, r.day, r.amount) for r in back.collect()) == [
        (7, 3, 1.0), (7, 3, 2.0), (7, 14, 3.0),
    ]


def test_curated_full_and_dynamic_overwrite(spark, tmp_path):
    root = str(tmp_path / "curated")
    df = small(spark)
    writers.write_curated(df, root)
    late = df.where("day = 14").withColumn("amount", F.lit(9.0))
    writers.write_curated(late, root, dynamic=True)
    amounts = lambda: sorted(r.amount for r in readers.read_curated(spark, root).collect())
    assert amounts() == [1.0, 2.0, 9.0]
    writers.write_curated(late, root, rebalance=False)
    assert amounts() == [9.0]


def test_table_learns_new_days_and_columns(spark, tmp_path):
    root, table = str(tmp_path / "curated"), "learns_days"
    df = small(spark)
    writers.write_curated(df.where("day = 3"), root)
    assert register_curated_table(spark, table, root).count() == 2
    writers.write_curated(df.where("day = 14").withColumn("note", F.lit("new")), root, dynamic=True)
    again = register_curated_table(spark, table, root)
    assert again.count() == 3 and "note" not in again.columns
    merged = register_curated_table(spark, table, root, merge_schema=True)
    assert sorted((r.day, r.note or "") for r in merged.collect()) == [(3, ""), (3, ""), (14, "new")]
    assert Path(root).exists()
    writers.write_curated(df.where("day = 14").withColumn("note", F.lit("new")), root)
    assert register_curated_table(spark, table, root).count() == 1  # the 3rd has vanished
    spark.sql(f"DROP TABLE {table}")


def test_scored_csv(spark, tmp_path):
    path = str(tmp_path / "flat")
    writers.write_scored_csv(small(spark), path)
    assert spark.read.option("header", True).csv(path).count() == 3


def test_longer_values_are_kept_and_other_days_stay(spark, tmp_path):
    root = str(tmp_path / "raw")
    day = F.when(F.col("day") == 14, 123).otherwise(F.col("day"))
    writers.write_raw_partitions(small(spark).withColumn("day", day), root)
    later = small(spark).limit(1).withColumns({"month": F.lit(8), "day": F.lit(1)})
    writers.write_raw_partitions(later, root)
    names = sorted(str(p.relative_to(root)) for p in Path(root).glob("*/*/*") if p.is_dir())
    assert names == ["year=2016/month=07/day=03", "year=2016/month=07/day=123", "year=2016/month=08/day=01"]


def test_recursive_reading_takes_days_from_folders(spark, tmp_path):
    root = str(tmp_path / "raw")
    df = small(spark)
    for name in set(TRANSACTION_TYPES) - set(df.columns):
        df = df.withColumn(name, F.lit(1).cast("string"))
    writers.write_raw_partitions(df, root)
    back = readers.read_raw_transactions(spark, root, recursive=True)
    assert sorted((r.year, r.month, r.day, r.amount) for r in back.collect()) == [
        (2016, 7, 3, 1.0), (2016, 7, 3, 2.0), (2016, 7, 14, 3.0),
    ]
    df.drop("day").coalesce(1).write.option("header", True).csv(str(tmp_path / "flat"))
    with pytest.raises(Exception, match="neither column nor folder for day"):
        readers.read_raw_transactions(spark, str(tmp_path / "flat"), recursive=True).collect()


def test_quotes_and_too_many_fields(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('x,y,z\n"Joe ""The Bar"", North",NY,1\n"a\nb",LA,2\n')
    rows = readers.read_source(spark, str(path), ["x", "y"], multi_line=True).collect()
    assert [tuple(r) for r in rows] == [('Joe "The Bar", North', "NY"), ("a\nb", "LA")]
    path.write_text("x,y,z\n1,2,3\n1,2,3,4\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_source(spark, str(path), ["x"]).collect()


def test_a_table_follows_its_folder_and_managed_tables_stay(spark, tmp_path):
    first, second, table = str(tmp_path / "one's"), str(tmp_path / "two"), "follows_folder"
    df = small(spark)
    writers.write_curated(df.where("day = 3"), first)
    writers.write_curated(df.where("day = 14"), second)
    assert register_curated_table(spark, table, first).count() == 2
    assert register_curated_table(spark, table, second).count() == 1
    assert readers.read_curated(spark, first).count() == 2
    spark.sql(f"DROP TABLE {table}")
    df.write.saveAsTable("own_table")
    with pytest.raises(ValueError, match="no external table"):
        register_curated_table(spark, "own_table", first, merge_schema=True)
    assert spark.table("own_table").count() == 3
    spark.sql("DROP TABLE own_table")


def test_days_register_without_a_listing_of_others(spark, tmp_path):
    root, table = str(tmp_path / "one's days"), "by_days"
    df = small(spark)
    assert writers.write_curated(df.where("day = 3"), root) == [(2016, 7, 3)]
    register_days(spark, table, root, [(2016, 7, 3)])
    # a folder that a listing would find, with a file that none may open
    stray = Path(root) / "year=2016" / "month=7" / "day=5"
    stray.mkdir()
    (stray / "part-0.parquet").write_text("no parquet")
    days = writers.write_curated(df.where("day = 14"), root, dynamic=True)
    again = register_days(spark, table, root, days)
    assert days == [(2016, 7, 14)] and again.count() == 3
    assert register_days(spark, table, root, days).count() == 3
    assert registered_days(spark, table) == {(2016, 7, 3), (2016, 7, 14)}
    # days that vanish go where this is asked for
    assert register_days(spark, table, root, days, only=True).count() == 1
    assert (Path(root) / "year=2016/month=7/day=3").exists()
    with pytest.raises(ValueError, match="no day"):
        register_days(spark, "nothing_yet", root, [])
    spark.sql(f"DROP TABLE {table}")


def test_days_without_a_date_and_other_roots(spark, tmp_path):
    root, table = str(tmp_path / "cur"), "odd_days"
    df = small(spark).withColumn("year", F.when(F.col("day") == 3, F.col("year")))
    days = writers.write_curated(df, root)
    assert sorted(days, key=str) == [(2016, 7, 3), (None, 7, 14)]
    assert register_days(spark, table, root, days).count() == 3
    other = str(tmp_path / "other")
    days = writers.write_curated(small(spark).where("day = 14"), other)
    moved = register_days(spark, table, other, days)
    assert [r.amount for r in moved.collect()] == [3.0]
    spark.sql(f"DROP TABLE {table}")
    small(spark).write.saveAsTable("own_days")
    with pytest.raises(ValueError, match="no external table"):
        register_days(spark, "own_days", other, days)
    spark.sql("DROP TABLE own_days")


def test_new_columns_join_the_entry_and_conflicts_raise(spark, tmp_path):
    root, table = str(tmp_path / "cur"), "evolving"
    df = small(spark)
    register_days(spark, table, root, writers.write_curated(df.where("day = 3"), root))
    noted = df.where("day = 14").withColumn("Note", F.lit("new"))
    days = writers.write_curated(noted, root, dynamic=True)
    assert "Note" not in register_days(spark, table, root, days).columns
    wide = register_days(spark, table, root, days, evolve=True)
    assert sorted((r.day, r.Note) for r in wide.where("day = 14").collect()) == [(14, "new")]
    assert [r.Note for r in wide.where("day = 3").collect()] == [None, None]
    other = str(tmp_path / "other")
    days = writers.write_curated(df.where("day = 3").withColumn("amount", F.lit("much")), other)
    with pytest.raises(ColumnConflict, match="amount is string in the files and double in the table"):
        register_days(spark, table, root, days, folder=other, evolve=True)
    assert spark.table(table).count() == 3
    writers.write_curated(df.where("day = 3").withColumn("amount", F.lit("much")), root, dynamic=True)
    with pytest.raises(ColumnConflict, match="disagree"):
        register_curated_table(spark, table, root, merge_schema=True)
    spark.sql(f"DROP TABLE {table}")


def test_merging_keeps_the_entry(spark, tmp_path):
    """Columns are added to the table; it is not declared anew, so its properties stay."""
    root, table = str(tmp_path / "cur"), "kept_entry"
    df = small(spark)
    writers.write_curated(df.where("day = 3"), root)
    register_curated_table(spark, table, root)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('owner_note' = 'keep')")
    writers.write_curated(df.where("day = 14").withColumn("note", F.lit("new")), root, dynamic=True)
    assert register_curated_table(spark, table, root, merge_schema=True).where("note = 'new'").count() == 1
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert properties["owner_note"] == "keep"
    spark.sql(f"DROP TABLE {table}")


def test_bad_records_are_set_aside(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('x,y,z\n1,2,3\n1,2,3,4\n"a, ""b""",5,6\nlone\n\n,,\n7,8\n')
    parsed = readers.parse_source(spark, str(path), ["z", "x"])
    assert sorted(map(tuple, parsed.good.collect()), key=str) == [("3", "1"), ("6", 'a, "b"'), (None, None)]
    assert sorted(r.record for r in parsed.bad.collect()) == ["1,2,3,4", "7,8", "lone"]
    assert parsed.good.count() == 3 and parsed.bad.count() == 3
    assert {r.file.rsplit("/", 1)[1] for r in parsed.bad.collect()} == {"a.csv"}
    folder = str(tmp_path / "side")
    assert writers.write_quarantine(parsed.bad, folder) == 3
    assert writers.write_quarantine(parsed.bad.limit(0), folder) == 0
    assert spark.read.parquet(folder).count() == 3
    with pytest.raises(Exception, match="(?i)malformed"):  # the default stays strict
        readers.read_source(spark, str(path), ["x"]).collect()


def test_bad_records_of_a_raw_zone(spark, nested):
    file = Path(nested) / "year=2016" / "month=07" / "day=03" / "part.csv"
    file.write_text(file.read_text() + "8,1,2016\n")
    parsed = readers.parse_raw_transactions(spark, nested)
    assert parsed.good.dtypes == list(TRANSACTION_TYPES.items())
    assert parsed.good.count() == 6
    bad = parsed.bad.collect()
    assert [r.record for r in bad] == ["8,1,2016"] and "day=03" in bad[0].file
    (file.parent / "part2.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="header"):
        readers.parse_raw_transactions(spark, nested).good.collect()


def test_cards_in_buckets_need_no_exchange(spark, tmp_path):
    rows = spark.range(400).selectExpr(
        "id AS txn_id", "id % 7 AS card_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 90) AS event_ts",
        "CASE WHEN id % 3 > 0 THEN cast(id % 5 AS string) END AS merchant_state", "cast(id AS double) AS amount",
    )
    kept = writers.write_by_card(rows, "by_card", str(tmp_path / "by card"), order=("event_ts", "txn_id"), buckets=4)
    before = rules.card_previous_txn(kept, tiebreak=("txn_id",))
    plan = before._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    want = rules.card_previous_txn(rows, tiebreak=("txn_id",))
    assert sorted(map(str, before.select(want.columns).collect())) == sorted(map(str, want.collect()))
    stats = rules.card_stats(kept)
    assert "Exchange" not in stats._jdf.queryExecution().executedPlan().toString()
    assert len(list((tmp_path / "by card").glob("*.parquet"))) <= 4
    again = writers.write_by_card(rows.limit(10), "by_card", str(tmp_path / "by card"), buckets=4)
    assert again.count() == 10
    spark.sql("DROP TABLE by_card")
