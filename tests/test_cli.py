from cardlens.__main__ import main
from cardlens.sources.readers import read_curated
from tests.test_plans import source  # noqa: F401


def test_all_commands(spark, source, tmp_path, capsys):  # noqa: F811
    raw, curated, gold, flat = (str(tmp_path / n) for n in ("raw", "curated", "gold", "flat"))
    main(["diagnose", "--input", source])
    main(["prepare", "--input", source, "--output", raw, "--target", "100"])
    main(["analyze", "--input", raw])
    main(["score", "--input", raw, "--save", flat, "--velocity-max", "2"])
    main(["daily", "--raw", raw, "--curated", curated, "--table", "cli_table", "--analytics", gold])
    main(["report", "--table", "cli_table", "--all-txns"])
    assert spark.table("cli_table").count() == 100
    main(["daily", "--raw", raw, "--curated", curated, "--table", "cli_table", "--in-place"])
    main(["report", "--curated", curated])
    main(["prepare", "--input", source, "--output", f"{raw}2", "--target", "100", "--approximate"])
    shown = capsys.readouterr().out
    assert "|2016|361" not in shown and "|2016|360  |9    |2.5" in shown
    assert "|NULL|361  |10   |" in shown
    assert "r1_amount_anomaly" in shown and "|Rome" in shown
    assert read_curated(spark, curated).count() == 100
    assert spark.read.option("header", True).csv(flat).count() == 100
    spark.sql("DROP TABLE cli_table")
