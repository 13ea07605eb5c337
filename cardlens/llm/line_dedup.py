"""Line dedup: drop lines that many documents repeat.

Normalised lines are exploded and hashed, the distinct documents of each hash are counted,
and lines whose hash is in too many go, but for the document with the largest id. What
remains is put together by position.

Only hashes travel until the end: 16 bytes a line, and the positions to drop a document.
The texts move once, to meet these. Counting goes over (hash, document) first and over the
hash after a partial sum, so a line that a third of all documents share is no hot spot; hashes
over the threshold are stored before they are joined, so that adaptive execution can split
such a line's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.tables import fresh, joinable
from cardlens.sources.scratch import store

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def _hashes(value: Column) -> tuple[Column, Column]:
    """128 bits of hash, as two columns: the same function from two seeds."""
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def repeated_lines(docs: DataFrame, least_docs: int = 3, least_chars: int = 20) -> DataFrame:
    """(doc_id, t1, t2, positions) of the lines to drop from texts with the hash (t1, t2).

    One row for each different (doc_id, text) with something to drop; positions count
    from 0 and ascend. Rows without an id neither count nor are listed.
    """
    t1, t2 = _hashes(F.col("text"))
    lines = docs.filter(F.col("doc_id").isNotNull()).select(
        "doc_id", t1.alias("t1"), t2.alias("t2"), F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    key = line_key(F.col("line"))
    long = lines.select("doc_id", "t1", "t2", "pos", key.alias("key")).filter(F.length("key") >= least_chars)
    k1, k2 = _hashes(F.col("key"))
    hashed = store(long.select("doc_id", "t1", "t2", "pos", k1.alias("k1"), k2.alias("k2")), "line-hashes")
    counted = hashed.groupBy("k1", "k2").agg(
        F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper")
    )
    common = store(counted.filter(F.col("n") >= least_docs).drop("n"), "common-lines")
    dropped = hashed.join(joinable(common), ["k1", "k2"]).filter(F.col("doc_id") != F.col("keeper"))
    return dropped.groupBy("doc_id", "t1", "t2").agg(F.sort_array(F.collect_set("pos")).alias("positions"))


def drop_repeated_lines(docs: DataFrame, least_docs: int = 3, least_chars: int = 20) -> DataFrame:
    """``docs`` with ``kept``, ``n_lines`` and ``n_dropped``, for a text column ``text``.

    A line goes where its key (``line_key``) has at least ``least_chars`` characters and is
    in at least ``least_docs`` documents, told apart by ``doc_id``, except in the largest
    ``doc_id`` that holds it. A null or empty text is one empty line. Rows with one id are one
    document. A row without id takes no part: it keeps all lines, and they do not count. All
    columns of ``docs`` stay; if one has a new column's name, the new one gets underscores before it.
    """
    # stored, so that both sides of the join with the texts are plain exchanges
    drops = store(repeated_lines(docs.select("doc_id", "text"), least_docs, least_chars), "lines-to-drop")
    taken = list(docs.columns)
    names = {}
    for name in ("n_lines", "n_dropped", "kept", "lines", "positions", "t1", "t2"):
        names[name] = fresh(name, taken)
        taken.append(names[name])
    t1, t2 = _hashes(F.col("text"))
    # lines are split before the join, as an expression inside a lambda would split anew for each range
    lined = docs.withColumns(
        {
            names["t1"]: t1, names["t2"]: t2,
            names["lines"]: F.split(F.coalesce(F.col("text"), F.lit("")), "\n"),
        }
    )
    keys = [F.col(f"d.{names[t]}") == F.col(f"x.{t}") for t in ("t1", "t2")]
    joined = lined.alias("d").join(drops.alias("x"), [F.col("d.doc_id") == F.col("x.doc_id"), *keys], "left")
    wide = joined.select("d.*", F.col("x.positions").alias(names["positions"]))
    lines, gone = F.col(names["lines"]), F.col(names["positions"])
    kept = F.when(gone.isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(_without(lines, gone), "\n"))
    return wide.withColumns(
        {
            names["kept"]: kept,
            names["n_lines"]: F.size(lines).cast("bigint"),
            names["n_dropped"]: F.coalesce(F.size(gone), F.lit(0)).cast("bigint"),
        }
    ).drop(*[names[t] for t in ("lines", "positions", "t1", "t2")])


def _without(lines: Column, positions: Column) -> Column:
    """``lines`` without those at the ascending ``positions``: the ranges between them, joined."""
    after = F.concat(F.array(F.lit(0)), F.transform(positions, lambda p: p + 1))
    upto = F.concat(positions, F.array(F.size(lines)))
    ranges = F.arrays_zip(after.alias("a"), upto.alias("b"))
    return F.flatten(F.transform(ranges, lambda r: F.slice(lines, r["a"] + 1, r["b"] - r["a"])))
