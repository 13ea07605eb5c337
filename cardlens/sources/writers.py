"""Write the raw zone, the curated zone and flat exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cardlens.sources.schema import DAY_COLUMNS


# the default drops microseconds
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def by_day(df: DataFrame) -> DataFrame:
    """Bring each day's rows together without trusting days to be alike in size.

    A rebalance lets adaptive execution split a day that is too large for one
    task and merge days that are too small for a file of their own.
    """
    return df.hint("rebalance", *DAY_COLUMNS)


def write_raw_partitions(df: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Header CSV under ``year=YYYY/month=MM/day=DD``, each file sorted by time.

    Replaces the days present in ``df`` and leaves all others. Longer values than the
    folder names are made for are kept as they are.
    """

    def padded(name: str, width: int) -> Column:
        text = F.col(name).cast("string")
        return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)

    names = {name: padded(name, width) for name, width in zip(DAY_COLUMNS, (4, 2, 2))}
    (
        by_day(df)
        .withColumns(names)
        .sortWithinPartitions(*DAY_COLUMNS, "time")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY_COLUMNS)
        .options(header=True, quote='"', escape='"')
        .csv(root)
    )


def write_curated(
    df: DataFrame, root: str, dynamic: bool = False, rebalance: bool = True
) -> list[tuple[int | None, ...]]:
    """Parquet partitioned by day; returns the days written, as ``register_days`` takes them.

    Replaces everything under ``root``, or with ``dynamic=True`` only the days
    present in ``df``. ``rebalance=False`` saves the shuffle when rows already
    arrive grouped by day. The days are gathered while the rows are written.
    """
    written = Observation()
    seen = df.observe(written, F.collect_set(F.struct(*DAY_COLUMNS)).alias("days"))
    (
        (by_day(seen) if rebalance else seen)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*DAY_COLUMNS)
        .parquet(root)
    )
    return [tuple(day) for day in written.get["days"]]


def write_scored_csv(df: DataFrame, path: str) -> None:
    """Flat header CSV of the scored table."""
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', timestampNTZFormat=MICROSECONDS).csv(path)


def write_quarantine(bad: DataFrame, folder: str) -> int:
    """Add bad records (``Parsed.bad``) to a side folder and return how many they were.

    They are written as Parquet, so that their text stays as it is.
    """
    counted = Observation()
    bad.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(folder)
    return counted.get["n"]


def write_by_card(
    df: DataFrame,
    table: str,
    path: str,
    card_keys: Sequence[str] = ("card_id",),
    order: Sequence[str] = ("event_ts",),
    buckets: int = 200,
) -> DataFrame:
    """Store ``df`` as ``table`` with the rows of a card in one bucket, and return the table.

    Joins and windows by the card keys read buckets as they are, without an exchange. Rows
    are brought together before the write, so a bucket is one file, sorted by card and
    ``order``. Choose ``buckets`` so that one holds a few hundred MB. A card that holds a large
    share of all rows makes its bucket large; ``card_previous_txn`` still cuts it into slices,
    at the price of an exchange.
    """
    (
        df.repartition(buckets, *card_keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *card_keys)
        .sortBy(*card_keys, *order)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)
