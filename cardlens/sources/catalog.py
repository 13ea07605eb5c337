"""Make a curated folder a named table, and keep the table in step with new days."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from cardlens.sources.readers import read_curated
from cardlens.sources.schema import DAY_COLUMNS, TRANSACTION_TYPES

Day = tuple[int | None, int | None, int | None]

DAYS_PER_STATEMENT = 200


class ColumnConflict(ValueError):
    """Files hold a column in another type than the table."""


def register_curated_table(
    spark: SparkSession, table: str, root: str, merge_schema: bool = False
) -> DataFrame:
    """Create ``table`` over ``root`` if needed and find its day partitions by listing ``root``.

    An existing external table keeps its columns and learns about new and vanished
    days. With ``merge_schema=True`` the columns of all files are united, which reads every
    footer; new columns are added to the entry. A table that stood for another folder is
    declared anew; files stay as they are. A managed table or view of that name is not
    touched: it raises. ``register_days`` does the same for known days without a listing.
    """
    name = quoted(table)
    with _clear_conflicts():
        columns = read_curated(spark, root, merge_schema).dtypes
    known = spark.catalog.tableExists(table)
    if known:
        _check_external(spark, table)
        if not _same_folder(_kind_and_location(spark, name)[1], root):
            spark.sql(f"DROP TABLE {name}")  # external: only the entry goes
            known = False
        elif merge_schema:
            _add_columns(spark, table, columns)
    if not known:
        _create(spark, table, columns, root)
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def register_days(
    spark: SparkSession,
    table: str,
    root: str,
    days: Sequence[Day],
    folder: str | None = None,
    evolve: bool = False,
    only: bool = False,
) -> DataFrame:
    """Make ``days`` partitions of ``table``, as ``write_curated`` has just listed them.

    They lie below ``folder`` (``root`` if left out). No other day is looked at: nothing is
    listed but these days' own folders, and those only to declare a new table or, with
    ``evolve=True``, to find columns that the table lacks. Such columns are added to its
    entry, older days read NULL in them, and a column of another type raises
    ``ColumnConflict`` before anything is changed. A day that is there already is pointed to
    its new folder. ``only=True`` then forgets all other days; files stay as they are.

    Each day changes in one step of the catalog, so a reader sees a day either old or new.
    Stopped half-way, the same call completes the rest. A table that stood for another root
    follows this one and forgets the other days. A managed table or view raises.
    """
    name, folder = quoted(table), (folder or root).rstrip("/")
    days = sorted(set(days), key=str)
    paths = {day: f"{folder}/{_folder_name(day)}" for day in days}
    moved = False
    if spark.catalog.tableExists(table):
        _check_external(spark, table)
        if evolve and days:
            _add_columns(spark, table, _file_columns(spark, paths.values()))
        moved = not _same_folder(_kind_and_location(spark, name)[1], root)
        if moved:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(root)}")
    elif days:
        _create(spark, table, _file_columns(spark, paths.values()) + _day_types(), root)
    else:
        raise ValueError(f"no day to declare {table} by")
    known = registered_days(spark, table)
    for day in days:
        if day in known:
            spark.sql(f"ALTER TABLE {name} {_partition(day)} SET LOCATION {_text(paths[day])}")
    for some in _chunks([d for d in days if d not in known]):
        added = " ".join(f"{_partition(day)} LOCATION {_text(paths[day])}" for day in some)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    if only or moved:
        for some in _chunks(sorted(known - set(days), key=str)):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(_partition, some))}")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def registered_days(spark: SparkSession, table: str) -> set[Day]:
    """The days that the catalog knows of ``table``."""

    def number(text: str) -> int | None:
        value = text.split("=", 1)[1]
        return None if value == "__HIVE_DEFAULT_PARTITION__" or value == "null" else int(value)

    rows = spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()
    return {tuple(number(part) for part in row[0].split("/")) for row in rows}


def quoted(table: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in table.replace("`", "").split("."))


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _chunks(days: Sequence[Day]) -> Iterator[Sequence[Day]]:
    for at in range(0, len(days), DAYS_PER_STATEMENT):
        yield days[at : at + DAYS_PER_STATEMENT]


def _folder_name(day: Day) -> str:
    return "/".join(
        f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
        for column, value in zip(DAY_COLUMNS, day)
    )


def _partition(day: Day) -> str:
    values = ", ".join(f"{c} = {'null' if v is None else v}" for c, v in zip(DAY_COLUMNS, day))
    return f"PARTITION ({values})"


def _day_types() -> list[tuple[str, str]]:
    return [(name, TRANSACTION_TYPES[name]) for name in DAY_COLUMNS]


def _file_columns(spark: SparkSession, paths) -> list[tuple[str, str]]:
    """Columns of the files in some day folders, from these files' footers alone."""
    with _clear_conflicts():
        return spark.read.option("mergeSchema", True).parquet(*paths).dtypes


@contextmanager
def _clear_conflicts() -> Iterator[None]:
    """Spark's error about files that do not go together, as one of this library."""
    try:
        yield
    except Exception as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        raise ColumnConflict(f"the files disagree on the type of a column: {error}") from error


def _create(spark: SparkSession, table: str, columns: Sequence[tuple[str, str]], root: str) -> None:
    ddl = ", ".join(f"`{column}` {kind}" for column, kind in columns)
    spark.sql(
        f"CREATE TABLE {quoted(table)} ({ddl}) USING parquet "
        f"PARTITIONED BY ({', '.join(DAY_COLUMNS)}) LOCATION {_text(root)}"
    )


def _add_columns(spark: SparkSession, table: str, columns: Sequence[tuple[str, str]]) -> None:
    """Add the columns that ``table`` lacks; those it has must be of the same type."""
    known = {name.lower(): kind for name, kind in spark.table(table).dtypes}
    other = [
        f"{name} is {kind} in the files and {known[name.lower()]} in the table"
        for name, kind in columns
        if known.get(name.lower(), kind) != kind
    ]
    if other:
        raise ColumnConflict(f"{table}: {'; '.join(other)}")
    new = [f"`{name}` {kind}" for name, kind in columns if name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({', '.join(new)})")


def _check_external(spark: SparkSession, table: str) -> None:
    kind, _ = _kind_and_location(spark, quoted(table))
    if kind != "EXTERNAL":
        raise ValueError(f"{table} exists and is no external table ({kind}); it is left as it is")


def _kind_and_location(spark: SparkSession, name: str) -> tuple[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    found = {r.col_name: r.data_type for r in rows}
    return found.get("Type", ""), found.get("Location", "")


def _same_folder(a: str, b: str) -> bool:
    def plain(path: str) -> tuple[str, str]:
        parts = urlparse(path)
        scheme = "" if parts.scheme == "file" else parts.scheme
        return f"{scheme}//{parts.netloc}", parts.path.rstrip("/")

    return plain(a) == plain(b)
