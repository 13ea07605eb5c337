"""Calendar arithmetic on TIMESTAMP_NTZ that ignores the session time zone.

``timestampdiff`` and ``date_trunc`` cast NTZ values to zoned timestamps, which
moves results around daylight-saving changes. These expressions use only the
fields of the value itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_SECOND = 1_000_000
US_PER_MINUTE = 60 * US_PER_SECOND
US_PER_HOUR = 60 * US_PER_MINUTE
US_PER_DAY = 24 * US_PER_HOUR


def epoch_hour(ts: Column) -> Column:
    """Clock hours since 1970-01-01 00:00 as BIGINT."""
    return F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)


def epoch_us(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 as BIGINT."""
    micros = (F.extract(F.lit("SECOND"), ts) * US_PER_SECOND).cast("bigint")
    return epoch_hour(ts) * US_PER_HOUR + F.minute(ts).cast("bigint") * US_PER_MINUTE + micros


def epoch_second(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 as BIGINT (fractions dropped)."""
    return epoch_hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def minutes_between(earlier: Column, later: Column) -> Column:
    """Exact difference in minutes as DOUBLE."""
    return (epoch_us(later) - epoch_us(earlier)) / F.lit(float(US_PER_MINUTE))
