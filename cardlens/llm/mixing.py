"""Mixing sources to target weights.

Sizes are summed by source, which gives each source a target and a repetition rate
(target / size). A document is emitted floor(rate) times, and once more with the
fraction as probability, decided by a hash of the document, so that reruns agree and
nothing but the source's total has to be known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.tables import fresh
from cardlens.sources.scratch import store

WORD = r"[^\x20\x09-\x0D]+"

# Source tables up to so many rows are broadcast: with names of some 50 bytes about 10 MB.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    The sources in order of code points, null last, take ``weights`` in turn, and
    share the total size by weight. No target exceeds ``most`` times its source's
    size; what is above goes to the others by weight, until none is above. That fixed
    point is min(most * size, level * weight) with one level for all: sources are
    capped in order of most * size / weight for as long as the level that remains for
    the others is higher. One narrow row for each source is sorted, nothing else.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighed = totals.select(
        "source", "source_size",
        F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1).alias("weight"),
    ).withColumn("cap", F.col("source_size") * F.lit(most))
    order = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    levels = weighed.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("left"),
    ).withColumn("level", (F.col("total") - F.col("capped")) / F.col("left"))
    # the first level that its own source can take holds for that source and all after
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    final = levels.withColumn("final", F.max(fits).over(everything))
    target = F.least("cap", F.coalesce(F.col("final") * F.col("weight"), F.col("cap")))
    return final.select("source", "source_size", target.alias("target")).withColumn(
        "rate",
        F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0),
    )


def with_copies(docs: DataFrame, name: str = "mix", seed: int = 17, **options) -> DataFrame:
    """``docs`` with a struct ``name`` of (size, source_size, target, copies).

    Null texts have size 0. Null is a source of its own, the last one. Rows of
    one id in one source share one draw, as reruns do. Only the table of
    sources is joined: broadcast if it is small by count, else as a shuffled join whose
    heavy sources adaptive execution splits.
    """
    flat = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = store(source_targets(flat, **options), "mix-targets")
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    key, facts = fresh("mix_source", docs.columns), fresh("mix_facts", docs.columns)
    learnt = targets.select(F.col("source").alias(key), F.struct("*").alias(facts))
    joined = docs.join(learnt, F.col("source").eqNullSafe(F.col(key)))
    rate = F.col(facts)["rate"]
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(key), 1, 10), 16, 10).cast("double") / float(1 << 40)
    copies = (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")
    decided = F.struct(
        word_count(F.col("text")).alias("size"),
        F.col(facts)["source_size"].alias("source_size"),
        F.col(facts)["target"].alias("target"),
        copies.alias("copies"),
    )
    return joined.select(*docs.columns, decided.alias(name))


def mix(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The mixed documents themselves: rows of ``docs``, each as often as the mix takes it."""
    name = fresh("mix", docs.columns)
    drawn = with_copies(docs, name, seed, **options).filter(F.col(name)["copies"] > 0)
    emitted = drawn.withColumn(name, F.explode(F.sequence(F.lit(1), F.col(name)["copies"])))
    return emitted.select(*docs.columns)
