"""Exact order statistics and moments without sorting everything or gathering it in one task.

Values are counted once (partial aggregation keeps repeats local) and the counts are stored;
all else looks at them alone. Ordered cells locate the wanted ranks: first logarithmic ones,
then, in the few cells that hold a wanted rank, ever finer equal steps, until few enough
values are left to be looked at themselves. No task sees more than one list of cell totals, limited
by the cell counts below, and the driver only learns which cells to look into, two for each
percentile and label at most, and in the end these few values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, floor, sqrt

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from cardlens.functions.cleaning import finite
from cardlens.sources.scratch import store

CELLS_PER_E_FOLD = 256  # first round: logarithmic cells, about 3,500 up to a million
STEPS = 4096  # later rounds: equal steps inside each chosen cell
FEW_VALUES = 10_000  # so many different values are looked at one by one


@dataclass(frozen=True)
class _Cell:
    """Values of one label from ``lo`` to ``hi``: ``n`` with repeats, ``values`` different ones,
    after ``before`` smaller ones, of ``total`` in all."""

    label: tuple
    lo: float
    hi: float
    n: int
    values: int
    before: int
    total: int

    def covers(self, rank: int) -> bool:
        return self.before <= rank < self.before + self.n


def exact_quantiles(
    df: DataFrame,
    value: Column,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    one_task: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles of ``value``, one column per name.

    NULL, NaN and infinities are left out. ``by`` may name label columns with few distinct
    values; there is one row per label, and without ``by`` one row, or none if
    there are no values.

    ``one_task`` uses the built-in ``percentile``, a single lazy aggregate that keeps
    every distinct value of a label in one task. Both forms give the same rows.
    """
    by = list(by)
    if one_task:
        return _in_one_pass(_values(df, value, by), probabilities, by)
    found = summaries(df, value, probabilities, by)
    return found.where(F.col("count") > 0).select(*by, *probabilities)


def summaries(
    df: DataFrame, value: Column, probabilities: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quantiles of ``value``, one row a label.

    NULL, NaN and infinities do not count; a label without values has count 0 and NULLs.
    Without ``by`` there is one row. The figures are found here and now, from one pass over
    ``df``; the result holds nothing but them.
    """
    by = list(by)
    spark = df.sparkSession
    counts = store(value_counts(df, value, by, unknown=True), "value-counts")
    wanted = list(probabilities.values())
    rows = _first_cells(counts, wanted, by).collect()
    cells = [
        _Cell(tuple(r[b] for b in by), c["lo"], c["hi"], c["n"], c["values"], c["before"], r["count"])
        for r in rows for c in r["cells"]
    ]
    done = [c for c in cells if c.lo == c.hi]
    while open_cells := [c for c in cells if c.lo != c.hi]:
        few = sum(c.values for c in open_cells) <= FEW_VALUES
        cells = _values_of(counts, open_cells, by) if few else _finer(counts, open_cells, wanted, by)
        done += [c for c in cells if c.lo == c.hi]
    spread = _deviations(counts, rows, by)
    kinds = dict(df.select(*by).dtypes)
    types = {**{b: kinds[b] for b in by}, "count": "bigint", **dict.fromkeys(["mean", "std", "min", "max", *probabilities], "double")}
    return _local(spark, types, [_summary(r, spread, done, probabilities, by) for r in rows])


def value_counts(
    df: DataFrame, value: Column, by: Sequence[str] = (), unknown: bool = False
) -> DataFrame:
    """How often (``n``) each value (``v``) occurs, per label; ``unknown`` ones only if asked for."""
    return _values(df, value, by, unknown).groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"))


def _values(df: DataFrame, value: Column, by: Sequence[str], unknown: bool = False) -> DataFrame:
    values = df.select(*by, finite(value.cast("double")).alias("v"))
    return values if unknown else values.where(F.col("v").isNotNull())


def _in_one_pass(
    values: DataFrame, probabilities: Mapping[str, float], by: list[str]
) -> DataFrame:
    found = values.groupBy(*by).agg(
        F.percentile("v", list(probabilities.values())).alias("_q")
    )
    return found.where(F.col("_q").isNotNull()).select(
        *by, *[F.col("_q")[i].alias(name) for i, name in enumerate(probabilities)]
    )


def _first_cells(counts: DataFrame, wanted: Sequence[float], by: list[str]) -> DataFrame:
    """Per label: count, mean, extremes, and the logarithmic cells that hold a wanted rank."""
    v, n = F.col("v"), F.col("n")
    log = F.signum(v) * F.floor(F.log1p(F.abs(v)) * CELLS_PER_E_FOLD)
    cells = counts.groupBy(*by, log.cast("bigint").alias("_cell")).agg(
        F.coalesce(F.sum(F.when(v.isNotNull(), n)), F.lit(0)).alias("n"),
        F.count(v).alias("values"),
        F.min(v).alias("lo"),
        F.max(v).alias("hi"),
        F.sum(n * v).alias("_sum"),
    )
    total = F.sum("n").over(Window.partitionBy(*by))
    cells = _before(cells, by, "_cell", F.lit(0)).withColumn("total", total)
    chosen = F.when(_holds_a_rank(wanted, F.col("total")), F.struct("lo", "hi", "n", "values", "before"))
    return cells.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        (F.sum("_sum") / F.nullif(F.sum("n"), F.lit(0))).alias("mean"),
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
        F.collect_list(chosen).alias("cells"),
    )


def _deviations(counts: DataFrame, rows: Sequence[Row], by: list[str]) -> dict[tuple, float | None]:
    """Sample deviation per label, from squares of distances to the known means."""
    mean = F.lit(None).cast("double")
    for r in rows:
        same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.lit(r[b])) for b in by], F.lit(True))
        mean = F.when(same, F.lit(r["mean"])).otherwise(mean)
    squares = F.sum(F.col("n") * F.pow(F.col("v") - mean, 2))
    found = {tuple(r[b] for b in by): r["s"] for r in counts.groupBy(*by).agg(squares.alias("s")).collect()}
    return {
        label: sqrt(found[label] / (r["count"] - 1)) if r["count"] > 1 else None
        for r in rows for label in [tuple(r[b] for b in by)]
    }


def _inside(cell: _Cell, by: list[str]) -> Column:
    same = [F.col(b).eqNullSafe(F.lit(x)) for b, x in zip(by, cell.label)]
    return reduce(lambda a, b: a & b, same, F.col("v").between(cell.lo, cell.hi))


def _values_of(counts: DataFrame, cells: Sequence[_Cell], by: list[str]) -> list[_Cell]:
    """Every value of the given cells, which are few, as a cell of its own."""
    chosen = reduce(lambda a, b: a | b, [_inside(c, by) for c in cells])
    rows = sorted(counts.where(chosen).select(*by, "v", "n").collect(), key=lambda r: r["v"])
    found = []
    for c in cells:
        before = c.before
        for r in rows:
            if tuple(r[b] for b in by) == c.label and c.lo <= r["v"] <= c.hi:
                found.append(_Cell(c.label, r["v"], r["v"], r["n"], 1, before, c.total))
                before += r["n"]
    return found


def _finer(
    counts: DataFrame, cells: Sequence[_Cell], wanted: Sequence[float], by: list[str]
) -> list[_Cell]:
    """Equal steps of the given cells that hold a wanted rank."""
    v = F.col("v")
    number = F.lit(None).cast("int")
    for i, c in enumerate(cells):
        number = F.when(_inside(c, by), F.lit(i)).otherwise(number)
    facts = F.array(
        *[
            F.struct(
                F.lit(float(c.lo)).alias("lo"), F.lit(float(c.hi)).alias("hi"),
                F.lit(c.before).cast("bigint").alias("base"), F.lit(c.total).cast("bigint").alias("total"),
            )
            for c in cells
        ]
    )
    rows = counts.select("v", "n", number.alias("_i")).where(F.col("_i").isNotNull())
    rows = rows.select("v", "n", "_i", F.get(facts, F.col("_i")).alias("_f")).select("v", "n", "_i", "_f.*")
    step = F.floor((v - F.col("lo")) / (F.col("hi") - F.col("lo")) * STEPS)
    found = rows.groupBy("_i", "base", "total", step.alias("_step")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("values"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    found = _before(found, ["_i"], "_step", F.col("base")).where(_holds_a_rank(wanted, F.col("total")))
    return [
        _Cell(cells[r["_i"]].label, r["lo"], r["hi"], r["n"], r["values"], r["before"], r["total"])
        for r in found.collect()
    ]


def _before(df: DataFrame, within: list[str], order: str, base: Column) -> DataFrame:
    """Add the number of values before each row, starting from ``base``."""
    preceding = Window.partitionBy(*within).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return df.withColumn("before", base + F.coalesce(F.sum("n").over(preceding), F.lit(0)))


def _holds_a_rank(wanted: Sequence[float], total: Column) -> Column:
    def covers(rank: Column) -> Column:
        return (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))

    places = [F.lit(float(p)) * (total - 1) for p in wanted]
    return reduce(lambda a, b: a | b, [covers(f(place)) for place in places for f in (F.floor, F.ceil)])


def _summary(
    row: Row,
    spread: Mapping[tuple, float | None],
    cells: Sequence[_Cell],
    probabilities: Mapping[str, float],
    by: list[str],
) -> tuple:
    """One row of the result, from a row of ``_first_cells`` and the single values found."""
    label, total = tuple(row[b] for b in by), row["count"]
    own = [c for c in cells if c.label == label]

    def at(rank: int) -> float:
        return next(c.lo for c in own if c.covers(rank))

    quantiles = []
    for p in probabilities.values():
        place = p * (total - 1)
        if not total:
            quantiles.append(None)
            continue
        low, high = at(floor(place)), at(ceil(place))
        quantiles.append(low + (high - low) * (place - floor(place)))
    return (*label, total, row["mean"], spread[label], row["min"], row["max"], *quantiles)


def _local(spark: SparkSession, types: Mapping[str, str], rows: Sequence[tuple]) -> DataFrame:
    """A few rows as constants, which need no scan."""
    names = ", ".join(f"`{name}`" for name in types)
    if not rows:
        return spark.createDataFrame([], ", ".join(f"`{name}` {kind}" for name, kind in types.items()))
    values = {f"p{i}_{j}": x for i, row in enumerate(rows) for j, x in enumerate(row)}
    constants = [
        "(" + ", ".join(f"CAST(:p{i}_{j} AS {kind})" for j, kind in enumerate(types.values())) + ")"
        for i in range(len(rows))
    ]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(constants)} AS t({names})", args=values)
