"""Source rows to canonical rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions import cleaning
from cardlens.sources.schema import SOURCE_TO_CANONICAL, TRANSACTION_TYPES


def rename_source_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(SOURCE_TO_CANONICAL)


def clean_source(df: DataFrame) -> DataFrame:
    """Canonical names and types; other columns pass through."""
    rows = rename_source_columns(df)
    typed = {
        name: F.col(name).try_cast(kind)
        for name, kind in TRANSACTION_TYPES.items()
        if kind != "string" and name in rows.columns
    }
    if "amount" in typed:
        typed["amount"] = cleaning.parse_amount(F.col("amount"))
    if "is_fraud" in typed:
        typed["is_fraud"] = cleaning.parse_fraud_flag(F.col("is_fraud"))
    return rows.withColumns(typed)


def with_event_ts(df: DataFrame) -> DataFrame:
    """Add ``event_ts`` from the calendar columns and the ``HH:MM`` text."""
    stamp = cleaning.build_event_ts(*[F.col(c) for c in ("year", "month", "day", "time")])
    return df.withColumn("event_ts", stamp)


def order_by_day_time(df: DataFrame, tiebreak=()) -> DataFrame:
    """By day, then by ``HH:MM`` text, whose order is that of time."""
    return df.orderBy("day", "time", *tiebreak)


def order_by_card_ts(df: DataFrame, card_keys=("card_id",), tiebreak=()) -> DataFrame:
    """By card, then by time with unknown times last."""
    return df.orderBy(*card_keys, F.col("event_ts").asc_nulls_last(), *tiebreak)
