"""Exact quantiles, box-plot figures and outliers by bracketed selection.

Spark's ``percentile`` keeps every distinct value of a group in one task, and sorting a
column shuffles all of it. Here a first aggregate sketches each key's distribution, which
gives a narrow bracket of values around every wanted rank. A second one folds the column
to the distinct values inside the brackets and one count for each gap between them, so the
ranks are found exactly in a few rows. Sketches and folds are made by each task before the
shuffle: a key with a third of all rows sends as little as any other, and neither the
column nor its distinct values are sorted or stored. Where even the brackets of a key hold
many values, they are counted and narrowed first, one scan a round.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.storage import broadcast_if_short, stage

ACCURACY = 5_000  # of the sketch: ranks are off by one in so many at most
FEW = 1_000_000  # rows of a key inside its brackets that are folded without narrowing
_SAFETY = 3  # times the sketch's error on either side of a rank
_GRID = 32  # cells a bracket is cut into by one round of narrowing
_ROUNDS = 40
_STATE = "_key_"


def unpivot(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(by..., column, value) rows as doubles, with null and NaN values left out."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value"))
                for c in columns
            ]
        )
    ).alias("_pair")
    keys = [F.col(k) for k in by or []]
    return (
        df.select(*keys, pairs)
        .select(*keys, "_pair.column", "_pair.value")
        .filter(F.col("value").isNotNull())
    )


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _ranks(probs: list[float], total: Column) -> dict[str, Column]:
    """The order statistics below and above each probability, counted from 0."""
    spots = {i: F.lit(float(p)) * (total - 1) for i, p in enumerate(probs)}
    lower = {f"_lo{i}": F.floor(s) for i, s in spots.items()}
    return lower | {f"_hi{i}": F.ceil(s) for i, s in spots.items()}


def _covers(start: Column, weight: Column, rank: Column) -> Column:
    return (start <= rank) & (rank < start + weight)


def _pick(rows: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Linear interpolation between the two neighbouring order statistics.

    ``rows`` hold the values with ``_n``, the count ``_before`` them and ``_total``.
    """
    ranks = _ranks(probs, F.col("_total"))
    hits = {name: _covers(F.col("_before"), F.col("_n"), r) for name, r in ranks.items()}
    picked = [F.max(F.when(hit, F.col("value"))).alias(name) for name, hit in hits.items()]
    # At most two rows per key and probability are left to group.
    found = rows.filter(_any(list(hits.values()))).groupBy(*keys).agg(F.max("_total").alias("n"), *picked)
    out = []
    for i, p in enumerate(probs):
        spot = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        between = lo + (hi - lo) * (spot - F.floor(spot))
        out.append(F.when(lo == hi, lo).otherwise(between).alias(_prob_name(p)))  # also where both are infinite
    return found.select(*keys, "n", *out)


def _prob_name(p: float) -> str:
    return "q" + f"{p * 100:g}".replace(".", "_")


def _edges(probs: list[float]) -> list[tuple[str, str]]:
    return [(f"_from{i}", f"_to{i}") for i in range(len(probs))]


def _keyed(rows: DataFrame, keys: list[str], state: DataFrame) -> DataFrame:
    """The rows next to their key's state, whose keys stand as ``_key_...``; few keys are broadcast."""
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(_STATE + k)) for k in keys])
    return rows.join(broadcast_if_short(state), same)


def _sketched(long: DataFrame, keys: list[str], probs: list[float], accuracy: int, extra: list[Column]) -> DataFrame:
    """Per key: ``_total``, the ``extra`` aggregates of ``value``, and a bracket around each probability's ranks."""
    reach = _SAFETY / accuracy
    ends = [min(max(e, 0.0), 1.0) for p in probs for e in (p - reach, p + reach)]
    sketch = F.percentile_approx("value", F.array(*map(F.lit, ends)), accuracy).alias("_sketch")
    found = long.groupBy(*keys).agg(F.count("value").alias("_total"), sketch, *extra)
    brackets = []
    for i, (low, high) in enumerate(_edges(probs)):
        brackets.append((F.get("_sketch", F.lit(2 * i)) if ends[2 * i] > 0 else F.lit(-math.inf)).alias(low))
        brackets.append((F.get("_sketch", F.lit(2 * i + 1)) if ends[2 * i + 1] < 1 else F.lit(math.inf)).alias(high))
    named = [F.col(k).alias(_STATE + k) for k in keys]
    others = [c for c in found.columns if c not in keys and c != "_sketch"]
    return stage(found.select(*named, *others, *brackets), "brackets")


def _narrowed(long: DataFrame, keys: list[str], probs: list[float], state: DataFrame, few: int, accuracy: int) -> DataFrame:
    """The state with brackets that hold their ranks and at most ``few`` rows, or repeats of few values.

    A round counts the rows below and inside every bracket and cuts the inside into cells of
    about equal mass, of which those around the ranks stay; a bracket that missed its ranks
    is opened on their side. It ends when no bracket moves.
    """
    grid = F.array(*[F.lit(g / _GRID) for g in range(_GRID + 1)])
    slack = 1 + _SAFETY * _GRID / accuracy
    named = [c for c in state.columns if c.startswith(_STATE)]
    carried = [c for c in state.columns if c not in named]
    for _ in range(_ROUNDS):
        figures = []
        for i, (low, high) in enumerate(_edges(probs)):
            here = F.col("value").between(F.col(low), F.col(high))
            figures += [
                F.count_if(F.col("value") < F.col(low)).alias(f"_below{i}"),
                F.count_if(here).alias(f"_inside{i}"),
                F.percentile_approx(F.when(here, F.col("value")), grid, accuracy).alias(f"_grid{i}"),
            ]
        counted = _keyed(long, keys, state).groupBy(*named).agg(*[F.max(c).alias(c) for c in carried], *figures)
        moved = {}
        ranks = _ranks(probs, F.col("_total"))
        for i, (low, high) in enumerate(_edges(probs)):
            first, last = ranks[f"_lo{i}"] - F.col(f"_below{i}"), ranks[f"_hi{i}"] - F.col(f"_below{i}")
            inside = F.col(f"_inside{i}")
            a = F.floor(first * _GRID / inside - slack).cast("int")
            b = F.ceil((last + 1) * _GRID / inside + slack).cast("int")
            cell = lambda at, i=i: F.get(f"_grid{i}", at)
            wide = inside > few
            moved[low] = (
                F.when(first < 0, F.lit(-math.inf)).when(first >= inside, F.col(high)).when(wide & (a > 0), cell(a)).otherwise(F.col(low))
            )
            moved[high] = (
                F.when(last >= inside, F.lit(math.inf)).when(last < 0, F.col(low)).when(wide & (b < _GRID), cell(b)).otherwise(F.col(high))
            )
        changed = _any([~c.eqNullSafe(F.col(name)) for name, c in moved.items()])
        kept = [c for c in carried if c not in moved and c != "_changed"]
        state = stage(counted.select(*named, *kept, *[c.alias(name) for name, c in moved.items()], changed.alias("_changed")), "brackets")
        if state.filter("_changed").isEmpty():
            break
    return state.drop("_changed")


def _selected(long: DataFrame, keys: list[str], probs: list[float], state: DataFrame) -> DataFrame:
    """``_pick`` on the values inside the brackets and one row for every gap between them."""
    rows = _keyed(long, keys, state)
    value = F.col("value")
    inside = _any([value.between(F.col(low), F.col(high)) for low, high in _edges(probs)])
    gap = reduce(lambda a, b: a + b, [F.when(value > F.col(high), 1).otherwise(0) for _, high in _edges(probs)])
    folded = rows.groupBy(*keys, F.when(inside, value).alias("_inner"), F.when(~inside, gap).alias("_gap")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("value").alias("_least"), F.max("_total").alias("_total")
    )
    # A key's rows in this window are its distinct values inside the brackets and at most one more per bracket.
    earlier = Window.partitionBy(*keys).orderBy("_least").rowsBetween(Window.unboundedPreceding, -1)
    placed = folded.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumn("value", F.col("_inner"))
    return _pick(placed, keys, probs)


def _quantiles(
    long: DataFrame, keys: list[str], probs: list[float], extra: list[Column] = [], few: int = FEW, accuracy: int = ACCURACY
) -> tuple[DataFrame, DataFrame]:
    """One row per key with ``n`` and the quantiles, and the state with the ``extra`` aggregates."""
    state = _sketched(long, keys, probs, accuracy, extra)
    most = state.agg(F.max("_total")).first()[0] or 0
    if most * 2 * _SAFETY * len(probs) > few * accuracy:
        state = _narrowed(long, keys, probs, state, few, accuracy)
    found = stage(_selected(long, keys, probs, state), "quantiles")
    names = [_prob_name(p) for p in probs]
    if not found.filter(_any([F.col(c).isNull() for c in names])).isEmpty():  # a sketch was off by more than it promises
        state = _narrowed(long, keys, probs, state, few, accuracy)
        found = stage(_selected(long, keys, probs, state), "quantiles")
    return found, state


def quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    by: list[str] | None = None,
    approximate: bool = False,
    few: int = FEW,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per key and column: ``n`` and the quantiles ``q25``, ``q50``...

    Linear interpolation, nulls and NaN skipped. ``approximate`` trades exactness
    for a single aggregate.
    """
    keys = [*(by or []), "column"]
    long = unpivot(df, columns, by)
    if approximate:
        return long.groupBy(*keys).agg(
            F.count("value").alias("n"),
            *[F.percentile_approx("value", float(p), 100_000).alias(_prob_name(p)) for p in probs],
        )
    return _quantiles(long, keys, probs, [], few, accuracy)[0]


def summaries(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """One row per column that has values: count, mean, sample deviation, extremes and quantiles.

    All but the quantiles come from the aggregate that sketches the columns.
    """
    figures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    found, state = _quantiles(unpivot(df, columns), ["column"], probs, [make("value").alias(name) for name, make in figures.items()])
    side = state.select(F.col(_STATE + "column").alias("column"), *figures)
    return side.join(F.broadcast(found.drop("n")), "column")  # a row per column on either side


def box_stats(
    df: DataFrame,
    column: str,
    by: list[str] | None = None,
    reach: float = 1.5,
) -> DataFrame:
    """Quartiles, whisker ends and outlier count per key, as a box plot draws them."""
    keys = [*(by or []), "column"]
    long = unpivot(df, [column], by)
    boxes, _ = _quantiles(long, keys, [0.25, 0.5, 0.75])
    span = F.col("q75") - F.col("q25")
    fenced = boxes.select(
        *[F.col(k).alias(_STATE + k) for k in keys], "n", "q25", "q50", "q75",
        (F.col("q25") - reach * span).alias("_low"),
        (F.col("q75") + reach * span).alias("_high"),
    )
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    return _keyed(long, keys, fenced).groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.max("q25").alias("q1"),
        F.max("q50").alias("median"),
        F.max("q75").alias("q3"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def iqr_outliers(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Rows whose ``column`` lies beyond ``reach`` interquartile ranges of the box."""
    quartiles = quantiles(df, [column], [0.25, 0.75])
    span = F.col("q75") - F.col("q25")
    fence = quartiles.select(
        F.struct((F.col("q25") - reach * span).alias("low"), (F.col("q75") + reach * span).alias("high"))
    ).scalar()
    return df.filter((F.col(column) < fence.getField("low")) | (F.col(column) > fence.getField("high")))
