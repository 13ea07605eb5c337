"""Turn source text into typed values. Bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\r\n\f\v"


def finite(value: Column) -> Column:
    """NULL for NaN and the infinities.

    NaN compares above every number in Spark, and one infinity spoils the mean of its
    whole card, so neither must reach a rule.
    """
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def parse_amount(text: Column) -> Column:
    """``$-99.00`` to -99.0; unparseable text, NaN and infinities to NULL."""
    return finite(F.replace(text, F.lit("$"), F.lit("")).try_cast("double"))


def trim_flag(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def parse_fraud_flag(text: Column) -> Column:
    """1 for ``Yes`` (surrounding blanks ignored), else 0; NULL counts as 0."""
    return F.coalesce((trim_flag(text) == "Yes").cast("int"), F.lit(0))


def build_event_ts(year: Column, month: Column, day: Column, time: Column) -> Column:
    """TIMESTAMP_NTZ from calendar parts and ``HH:MM`` text; NULL on a bad part."""
    part = lambda i: F.split_part(time, F.lit(":"), F.lit(i)).try_cast("int")
    stamp = F.try_make_timestamp_ntz(
        year.try_cast("int"), month.try_cast("int"), day.try_cast("int"),
        part(1), part(2), F.lit(0),
    )
    return F.when(time.rlike(r"^\d{1,2}:\d{1,2}$"), stamp)
