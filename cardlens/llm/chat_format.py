"""Chat formatting for preference training.

A chosen and a rejected conversation share their first turns. Those are rendered once,
as the prompt; what follows in each is its completion. A completion comes with the
spans in which it is trained on: the texts of the assistant with their end mark. All
else, such as the marks that open a turn and what users say, is masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of a turn in the widely used ChatML layout.
OPEN, BREAK, CLOSE, AFTER = "<|im_start|>", "\n", "<|im_end|>", "\n"
TRAINED_ROLE = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (role, text).

    Order is by turn, then role, then text; turns without number come last. Null roles
    and texts are empty. Repeated rows are repeated turns. Rows without ``conv_id`` are in
    no conversation. A conversation becomes one value, as its rendering does.
    """
    sort = F.struct(
        F.col("turn").isNull().alias("last"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = turns.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.array_sort(F.collect_list(sort)).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return grouped.select("conv_id", plain.alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """How many first turns two arrays of turns share."""
    shorter = F.least(F.size(a), F.size(b))
    places = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))
    differing = F.filter(places, lambda i: F.get(a, i) != F.get(b, i))
    return F.coalesce(F.get(differing, F.lit(0)), shorter)


def _opened(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(BREAK))


def _rendered(turn: Column) -> Column:
    return F.concat(_opened(turn), turn["text"], F.lit(CLOSE + AFTER))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def trained_spans(turns: Column) -> Column:
    """Character spans (start, end) of the rendered turns that are trained on."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_opened(turn))
        span = F.struct(
            begin.alias("start"), (begin + F.length(turn["text"]) + len(CLOSE)).alias("end")
        )
        spans = F.when(turn["role"] == TRAINED_ROLE, F.concat(state["spans"], F.array(span)))
        return F.struct(
            (state["at"] + F.length(_rendered(turn))).alias("at"), F.coalesce(spans, state["spans"]).alias("spans")
        )

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def preference_pairs(pairs: DataFrame) -> DataFrame:
    """Columns prompt_turns, prompt, chosen, chosen_spans, rejected, rejected_spans beside ``pair_id``.

    ``pairs`` has pair_id and the arrays ``chosen_turns`` and ``rejected_turns``. A side
    that is null has a null completion, and the prompt is then empty: nothing is shared. Where one
    conversation begins with all of the other, the other's completion is empty.
    """
    both = F.col("chosen_turns").isNotNull() & F.col("rejected_turns").isNotNull()
    shared = F.when(both, common_turns(F.col("chosen_turns"), F.col("rejected_turns"))).otherwise(0)
    counted = pairs.withColumn("prompt_turns", shared)

    def after(turns: str) -> Column:
        return F.slice(F.col(turns), F.col("prompt_turns") + 1, F.size(turns))

    known = F.coalesce("chosen_turns", "rejected_turns")
    return counted.select(
        "pair_id", "prompt_turns",
        render(F.slice(known, F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        render(after("chosen_turns")).alias("chosen"),
        trained_spans(after("chosen_turns")).alias("chosen_spans"),
        render(after("rejected_turns")).alias("rejected"),
        trained_spans(after("rejected_turns")).alias("rejected_spans"),
    )


def neighbouring_pairs(turns: DataFrame) -> DataFrame:
    """Pairs of conversations 2 p (chosen) and 2 p + 1 (rejected), for tables without a marked
    preference. Each conversation is in one pair, whatever others resemble it."""
    told = conversations(turns).select(
        F.floor(F.col("conv_id") / 2).alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 0).alias("good"), "turns"
    )
    return told.groupBy("pair_id").agg(
        F.first(F.when(F.col("good"), F.col("turns")), ignorenulls=True).alias("chosen_turns"),
        F.first(F.when(~F.col("good"), F.col("turns")), ignorenulls=True).alias("rejected_turns"),
    )
