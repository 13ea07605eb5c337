from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cardlens.functions.cleaning import build_event_ts, parse_amount, parse_fraud_flag
from cardlens.functions.geo import haversine_km
from cardlens.functions.timeparts import epoch_hour, epoch_second, epoch_us, minutes_between
from cardlens.operators.cleaning import clean_source, order_by_card_ts, order_by_day_time
from cardlens.sources.schema import SOURCE_COLUMNS


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, value",
    [("$12.50", 12.5), ("$-99.00", -99.0), ("$$7", 7.0), ("3", 3.0), ("n/a", None), (None, None),
     ("", None), ("nan", None), ("$NaN", None)],
)
def test_parse_amount(spark, text, value):
    assert one(spark, parse_amount(F.lit(text).cast("string"))) == value


@pytest.mark.parametrize(
    "text, value", [("Yes", 1), (" Yes ", 1), ("Yes\t", 1), ("yes", 0), ("No", 0), (None, 0)]
)
def test_parse_fraud_flag(spark, text, value):
    assert one(spark, parse_fraud_flag(F.lit(text).cast("string"))) == value


@pytest.mark.parametrize(
    "parts, value",
    [
        ((2016, 7, 4, "06:21"), datetime(2016, 7, 4, 6, 21)),
        ((2016, 7, 4, "6:05"), datetime(2016, 7, 4, 6, 5)),
        ((2016, 13, 4, "06:21"), None),
        ((2015, 2, 29, "06:21"), None),
        ((2016, 7, 4, "24:00"), None),
        ((2016, 7, 4, "12:60"), None),
        ((2016, 7, 4, "12:30:10"), None),
        ((2016, 7, 4, "noon"), None),
        ((2016, 7, 4, None), None),
        ((None, 7, 4, "06:21"), None),
        # skipped by daylight saving in the session zone, but a valid naive time
        ((2016, 3, 27, "02:30"), datetime(2016, 3, 27, 2, 30)),
    ],
)
def test_build_event_ts(spark, parts, value):
    year, month, day, time = parts
    columns = [F.lit(p).cast("int") for p in (year, month, day)] + [F.lit(time).cast("string")]
    df = spark.range(1).select(build_event_ts(*columns).alias("v"))
    assert df.schema["v"].dataType.simpleString() == "timestamp_ntz"
    assert df.first()["v"] == value


def test_time_arithmetic_ignores_the_session_zone(spark):
    # the clock jumps from 02:00 to 03:00 in between
    df = spark.sql(
        "SELECT timestamp_ntz'2016-03-27 01:30:00.25' AS a, timestamp_ntz'2016-03-27 03:30:00.75' AS b"
    )
    row = df.select(
        minutes_between(F.col("a"), F.col("b")).alias("gap"),
        epoch_hour(F.col("a")).alias("hour"),
        epoch_us(F.col("a")).alias("us"),
        epoch_second(F.col("a")).alias("s"),
    ).first()
    base = int((datetime(2016, 3, 27) - datetime(1970, 1, 1)).total_seconds())
    assert row["gap"] == (2 * 3600 + 0.5) / 60
    assert row["hour"] == base // 3600 + 1
    assert row["us"] == (base + 5400) * 1_000_000 + 250_000
    assert row["s"] == base + 5400


def test_times_before_1970(spark):
    row = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:59.5' AS a").select(
        epoch_us(F.col("a")).alias("us"), epoch_hour(F.col("a")).alias("h")
    ).first()
    assert (row["us"], row["h"]) == (-500_000, -1)


def test_haversine(spark):
    paris_london = haversine_km(F.lit(48.8566), F.lit(2.3522), F.lit(51.5074), F.lit(-0.1278))
    assert one(spark, paris_london) == pytest.approx(343.6, abs=0.5)
    assert one(spark, haversine_km(*[F.lit(v) for v in (0.0, 0.0, 0.0, 180.0)])) == pytest.approx(
        20015, abs=1
    )


def test_clean_source(spark):
    row = ("3", "0", "2016", "7", "04", "06:21", "$-99.00", "Swipe", "-123", None, None, "5411", " Yes ")
    df = spark.createDataFrame([row], ", ".join(f"`{c}` string" for c in SOURCE_COLUMNS))
    clean = clean_source(df)
    assert dict(clean.dtypes)["merchant_id"] == "bigint"
    assert tuple(clean.first()) == (
        3, 0, 2016, 7, 4, "06:21", -99.0, "Swipe", -123, None, None, 5411, 1,
    )


def test_orders(spark, make):
    df = make([(1, 2, None, 1.0, None, 0), (2, 2, "2016-01-01 05:00", 1.0, None, 0),
               (3, 1, "2016-01-02 05:00", 1.0, None, 0)])
    assert [r.txn_id for r in order_by_card_ts(df).collect()] == [3, 2, 1]
    days = spark.createDataFrame([(2, "01:00"), (1, "23:00"), (1, "09:30")], "day int, time string")
    assert [tuple(r) for r in order_by_day_time(days).collect()] == [
        (1, "09:30"), (1, "23:00"), (2, "01:00"),
    ]


@pytest.mark.parametrize("text", ["$Infinity", "-Infinity", "1e400", "NaN"])
def test_amounts_are_finite(spark, text):
    df = spark.createDataFrame([(text,)], "a string")
    assert df.select(parse_amount(F.col("a"))).first()[0] is None
