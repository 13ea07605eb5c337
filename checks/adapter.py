"""The test tables seen as transactions.

``events`` is the only test table with a time of day, so each event plays a card
transaction. ``orders`` spans several years and serves the yearly profiles.
``sql.py`` repeats the same mapping for the comparison queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.config import RuleConfig
from cardlens.sources.scratch import new_path

# No card reaches 130 events an hour in the test tables; 1 makes the rule fire.
CONFIG = RuleConfig(velocity_max=1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("txn_id"),
        "user_id",
        F.col("user_id").alias("card_id"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.day(ts).alias("day"),
        F.format_string("%02d:%02d", F.hour(ts), F.minute(ts)).alias("time"),
        F.col("value").alias("amount"),
        kind.alias("use_chip"),
        F.col("event_id").alias("merchant_id"),
        k.alias("merchant_city"),
        F.when(kind != "signup", kind).alias("merchant_state"),
        k.cast("int").alias("mcc"),
        ((kind == "error") & (F.col("value") > 100)).cast("int").alias("is_fraud"),
        ts.alias("event_ts"),
    )


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as source text: signs, blanks, gaps and one unwanted column."""
    t = transactions(spark, sf_dir)
    kind = F.col("use_chip")
    amount = F.format_string("%.2f", "amount")
    return t.select(
        F.col("txn_id").cast("string").alias("Note"),
        F.col("user_id").cast("string").alias("User"),
        F.col("card_id").cast("string").alias("Card"),
        F.col("year").cast("string").alias("Year"),
        F.col("month").cast("string").alias("Month"),
        F.col("day").cast("string").alias("Day"),
        F.col("time").alias("Time"),
        F.when(kind == "click", F.concat(F.lit("$-"), amount))
        .when((kind == "signup") & (F.col("amount") < 10), "n/a")
        .otherwise(F.concat(F.lit("$"), amount))
        .alias("Amount"),
        kind.alias("Use Chip"),
        F.col("merchant_id").cast("string").alias("Merchant Name"),
        F.col("merchant_city").alias("Merchant City"),
        F.col("merchant_state").alias("Merchant State"),
        F.col("mcc").cast("string").alias("MCC"),
        F.when((F.col("is_fraud") == 1) & (F.col("amount") > 150), " Yes ")
        .when(F.col("is_fraud") == 1, "Yes")
        .when(kind != "view", "No")
        .alias("Is Fraud?"),
    )


def source_file(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "source")
    (
        source_rows(spark, sf_dir)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as dated rows; a finished order stands for a fraud."""
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.day(date).alias("day"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_fraud"),
    )
