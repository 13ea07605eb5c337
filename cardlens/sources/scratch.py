"""Intermediate tables in the folder the cluster shares for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Stored facts of so many rows are broadcast: a key and a few numbers each, some 100 MB hashed.
BROADCAST_ROWS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A local session without one gets a fresh folder of its own; on a cluster a
    machine-local folder would not survive or be seen by other nodes, so there
    the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all nodes")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    The result has no lineage to recompute after a lost executor, and its size is
    known from its files, so Catalyst compares a real number with
    ``spark.sql.autoBroadcastJoinThreshold`` when it plans a join.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame, path: str) -> None:
    """Free the space of what was stored under ``path``: an empty table takes its place."""
    df.limit(0).write.mode("overwrite").parquet(path)


def release(stored: DataFrame) -> None:
    """``discard`` for a result of ``store`` that no query will read again."""
    files = stored.inputFiles()
    if files:
        discard(stored, unquote(files[0].rsplit("/", 1)[0]))


def small(stored: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table has few enough rows to be broadcast; its files know their counts."""
    return stored.count() <= rows


def joinable(
    facts: DataFrame, lazy: bool = False, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``facts``, ready to be joined back to the rows that they were learnt from.

    They are stored, for two reasons. Their size is then known before the join is
    planned, so a small table is broadcast and the wide rows are not shuffled at all.
    And where the table is too large for that, both sides of the join are plain
    shuffles, which adaptive execution needs to split the rows of a heavy key; it
    cannot when one side is still an aggregate.

    ``lazy`` leaves them in the plan instead, which saves a job where no key is heavy.
    Both forms give the same rows.
    """
    if lazy:
        return facts
    stored = store(facts, "facts")
    return F.broadcast(stored) if small(stored, broadcast_rows) else stored
