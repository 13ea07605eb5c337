"""Read the source file, the raw zone and the curated zone."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardlens.functions.cleaning import finite
from cardlens.sources.schema import DAY_COLUMNS, SOURCE_COLUMNS, TRANSACTION_TYPES


class NoInput(ValueError):
    """There is nothing to read under the given root."""


def read_source(
    spark: SparkSession, path: str, columns=SOURCE_COLUMNS, multi_line: bool = False
) -> DataFrame:
    """Source CSV as text columns, limited to ``columns``.

    Columns are picked by header name: the file may hold more than these and a
    CSV schema binds by position. Large files are split across tasks. Quotes inside
    quoted text are doubled. ``multi_line`` reads line breaks inside quotes; a file is
    then one task. A record with other than the header's number of fields raises.
    """
    return _csv(spark, path, multi_line=multi_line).select(*[F.col(f"`{name}`") for name in columns])


def read_raw_transactions(
    spark: SparkSession,
    root: str,
    recursive: bool = False,
    extra_types: Mapping[str, str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Typed transactions from header CSV files.

    By default ``year=/month=/day=`` folders are discovered, so filters on these
    columns prune folders. ``recursive=True`` instead takes every ``part*.csv``
    below ``root``; day columns that the files lack are taken from their paths. No
    schema is passed to the reader: files that repeat their partition columns would be
    shifted by one made for all columns.
    """
    df = _csv(spark, root, recursive, multi_line)
    if recursive:
        df = _with_path_days(df.select("*", F.col("_metadata.file_path").alias("_file")))
    return _typed(df, extra_types)


def _typed(df: DataFrame, extra_types: Mapping[str, str] | None) -> DataFrame:
    types = {**TRANSACTION_TYPES, **(extra_types or {})}
    typed = {name: F.col(name).try_cast(kind) for name, kind in types.items()}
    typed["amount"] = finite(typed["amount"])
    return df.select(*[column.alias(name) for name, column in typed.items()])


@dataclass(frozen=True)
class Parsed:
    """Records of CSV files that fit their header, and those that do not.

    ``bad`` has the text of each bad record (``record``) and its file (``file``). Together they
    are all records of the files.
    """

    good: DataFrame
    bad: DataFrame


def parse_source(
    spark: SparkSession, path: str, columns=SOURCE_COLUMNS, multi_line: bool = False
) -> Parsed:
    """``read_source`` that sets bad records aside instead of raising at the first.

    Bad are records with another number of fields than the header. Files whose header differs
    still raise: nothing in them can be trusted.
    """
    good, bad = _parted(spark, path, False, multi_line)
    return Parsed(good.select(*[F.col(f"`{name}`") for name in columns]), bad)


def parse_raw_transactions(
    spark: SparkSession,
    root: str,
    extra_types: Mapping[str, str] | None = None,
    multi_line: bool = False,
) -> Parsed:
    """``read_raw_transactions(recursive=True)`` that sets bad records aside."""
    good, bad = _parted(spark, root, True, multi_line)
    return Parsed(_typed(_with_path_days(good), extra_types), bad)


def _parted(spark: SparkSession, path: str, recursive: bool, multi_line: bool) -> tuple[DataFrame, DataFrame]:
    names = _csv(spark, path, recursive, multi_line).columns
    mark = "_corrupt_record"
    while mark in names:
        mark = f"_{mark}"
    schema = StructType([StructField(name, StringType()) for name in [*names, mark]])
    rows = _csv(spark, path, recursive, multi_line, schema, mark).select("*", F.col("_metadata.file_path").alias("_file"))
    # always true; the parser refuses to be asked for nothing but the mark
    asked = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0
    bad = rows.where(F.col(mark).isNotNull() & asked)
    good = rows.where(F.col(mark).isNull() & asked)
    # the file stays with good records until days are taken from its path
    return good.drop(mark), bad.select(F.col(mark).alias("record"), F.col("_file").alias("file"))


def read_curated(spark: SparkSession, root: str, merge_schema: bool = False) -> DataFrame:
    """Scored transactions; ``merge_schema`` unites files with differing columns."""
    return spark.read.option("mergeSchema", merge_schema).parquet(root)


def _with_path_days(df: DataFrame) -> DataFrame:
    """Day columns from ``name=value`` folders of ``_file`` where the files have none."""
    for name in DAY_COLUMNS:
        if name not in df.columns:
            value = F.regexp_extract("_file", rf"/{name}=([^/]+)/", 1)
            missing = F.concat(F.lit(f"neither column nor folder for {name}: "), "_file")
            df = df.select("*", F.when(value == "", F.raise_error(missing)).otherwise(value).alias(name))
    return df


def _csv(
    spark: SparkSession,
    path: str,
    recursive: bool = False,
    multi_line: bool = False,
    schema: StructType | None = None,
    mark: str | None = None,
) -> DataFrame:
    """All records; with ``mark``, a column of ``schema``, bad ones are marked by their text."""
    # enforceSchema off: a file whose header differs fails instead of shifting columns
    reader = spark.read.option("header", True).option("enforceSchema", False)
    # quotes as spreadsheets and data frame libraries write them; columns are not pruned
    # inside the parser, which would hide records with too many fields
    reader = reader.option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE" if mark else "FAILFAST")
    if mark:
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", mark)
    reader = reader.option("columnPruning", False).option("multiLine", multi_line)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "part*.csv")
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise NoInput(f"no CSV files under {path}") from error
        raise
