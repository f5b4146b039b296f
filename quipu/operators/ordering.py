"""Positions, ranks and running totals that stay distributed.

A window without ``partitionBy`` runs in one task, and a window over a hot key
puts that key's rows in one task. Here rows are range-sorted instead, every
sorted partition keeps its number, and only per-partition totals (at most one
row per partition and key) are accumulated. A key that fills many partitions is
therefore worked on by many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from quipu.storage import broadcast_if_short, stage

PART, SLOT = "_part", "_slot"
_SLOT_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def range_sorted(df: DataFrame, *order: Column) -> DataFrame:
    """Sort globally and store the rows with their partition and slot numbers.

    The row id at the end of the sort key lets a range shuffle split a run of
    equal keys, however long it is.
    """
    split = df.withColumn("_tie", F.monotonically_increasing_id())
    tagged = split.orderBy(*order, "_tie").drop("_tie")
    tagged = tagged.withColumn(SLOT, F.monotonically_increasing_id())
    return stage(tagged.withColumn(PART, F.shiftright(SLOT, _SLOT_BITS)), "sorted")


def part_totals(stored: DataFrame, by: list[str], weight: Column) -> DataFrame:
    """Per (partition, key): its weight, the weight before it in the key, and the key's total.

    Stored as well, as it is read more than once: a row per key and partition.
    """
    sizes = stored.groupBy(PART, *by).agg(
        F.sum(weight).alias("_weight"), F.min(SLOT).alias("_first_slot")
    )
    # At most one row per sorted partition in each of these windows.
    whole = Window.partitionBy(*by) if by else Window.partitionBy()
    earlier = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return stage(
        sizes.withColumns(
            {
                "_earlier": F.coalesce(F.sum("_weight").over(earlier), F.lit(0)),
                "_total": F.sum("_weight").over(whole),
            }
        ),
        "parts",
    )


def attach(stored: DataFrame, facts: DataFrame, by: list[str]) -> DataFrame:
    """Join per-(partition, key) facts to the stored rows; rows without facts go.

    Few facts are broadcast, which leaves the stored rows where they are. Else the
    partition number is part of the join key, so a hot key is spread over as many
    tasks as it has sorted partitions.
    """
    side = facts.select(
        F.col(PART).alias("_fact_part"),
        *[F.col(k).alias(f"_fact_{k}") for k in by],
        *[c for c in facts.columns if c != PART and c not in by],
    )
    on = stored[PART] == F.col("_fact_part")
    for k in by:
        on = on & stored[k].eqNullSafe(F.col(f"_fact_{k}"))
    return stored.join(broadcast_if_short(side), on).drop("_fact_part", *[f"_fact_{k}" for k in by])


def with_position(
    df: DataFrame, *order: Column, by: list[str] | None = None, name: str = "position"
) -> DataFrame:
    """Number the rows from 0 in ``order``, within each ``by`` key if given.

    End ``order`` with a unique column: ties are otherwise numbered arbitrarily.
    """
    by = by or []
    stored = range_sorted(df, *[F.col(k).asc_nulls_last() for k in by], *order)
    totals = part_totals(stored, by, F.lit(1)).select(PART, *by, "_first_slot", "_earlier")
    position = F.col("_earlier") + F.col(SLOT) - F.col("_first_slot")
    return attach(stored, totals, by).select(*df.columns, position.cast("bigint").alias(name))


def with_rank(
    df: DataFrame, value: str, *tiebreak: str, descending: bool = True, name: str = "rank"
) -> DataFrame:
    """SQL ``rank()`` over the whole table: equal values share the best rank."""
    first = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    stored = range_sorted(df, first, *[F.col(c) for c in tiebreak])
    starts = part_totals(stored, [], F.lit(1)).select(
        F.col(PART).alias("_p"), "_earlier", F.col("_first_slot").alias("_base")
    )
    runs = stored.groupBy(PART, value).agg(F.min(SLOT).alias("_run_slot"))
    leaders = (
        runs.groupBy(value)
        .agg(F.min("_run_slot").alias("_lead"))
        .withColumn("_p", F.shiftright("_lead", _SLOT_BITS))
        .join(F.broadcast(starts), "_p")  # one row per sorted partition
        .select(
            F.col(value).alias("_v"),
            (F.col("_earlier") + F.col("_lead") - F.col("_base") + 1).alias("_rank"),
        )
    )
    ranked = runs.join(leaders, runs[value].eqNullSafe(leaders["_v"])).select(PART, value, "_rank")
    return attach(stored, ranked, [value]).select(
        *df.columns, F.col("_rank").cast("bigint").alias(name)
    )


@dataclass(frozen=True)
class Descending:
    """A sort key of ``row_slice`` that falls, nulls last."""

    column: Column


BOUNDS = 12  # parts that rows are counted in: each is a comparison for every row
_DRAWN = 80  # sampled rows for each of them
SORTED_ROWS = 1_000_000  # that are numbered by sorting; more are narrowed down first


def _before(df: DataFrame, order: list[Column | Descending], bound: Row) -> Column:
    """Whether a row stands before ``bound`` (the values of the sort keys)."""
    out = F.lit(False)
    for i in reversed(range(len(order))):
        falling = isinstance(order[i], Descending)
        key, kind = F.col(f"_key{i}"), df.schema[f"_key{i}"].dataType
        at = F.lit(bound[i]).cast(kind)
        if bound[i] is None:  # nulls are the least: first of rising keys, last of falling ones
            less = key.isNotNull() if falling else F.lit(False)
        else:
            less = F.coalesce(key > at, F.lit(False)) if falling else F.coalesce(key < at, F.lit(True))
        out = less | (key.eqNullSafe(at) & out)
    return out


def _slice(df: DataFrame, order: list[Column | Descending], start: int | None, stop: int | None, most: int) -> DataFrame:
    """Rows from place ``start`` to before ``stop`` of rows with their sort keys ``_key0``..., counted in parts between sampled bounds."""
    keys = [f"_key{i}" for i in range(len(order))]
    sort = [F.col(k).desc_nulls_last() if isinstance(o, Descending) else F.col(k).asc_nulls_first() for k, o in zip(keys, order)]
    drawn = df.select(*keys).orderBy(F.rand(7)).limit(BOUNDS * _DRAWN)  # as many rows from every task, then the least of those
    sampled = drawn.orderBy(*sort).collect()[_DRAWN - 1 :: _DRAWN][: BOUNDS - 1]
    bounds = [b for i, b in enumerate(sampled) if not i or b != sampled[i - 1]]
    part = reduce(lambda a, b: a + b, [F.when(_before(df, order, b), 0).otherwise(1) for b in bounds], F.lit(0))
    counts = {r["part"]: r["n"] for r in df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}  # BOUNDS at most
    total = sum(counts.values())
    first, last = ((0 if place is None else place) if place is None or place >= 0 else max(total + place, 0) for place in (start, stop))
    last = total if stop is None else min(last, total)

    def between(low: int, high: int) -> Column:
        """Parts ``low`` to ``high``: at most two comparisons."""
        after = ~_before(df, order, bounds[low - 1]) if low > 0 else F.lit(True)
        return after & (_before(df, order, bounds[high]) if high < len(bounds) else F.lit(True))

    if total <= most:
        place = F.col("_position")
        return with_position(df, *sort, name="_position").filter((place >= first) & (place < last)).drop("_position")
    whole, cut, at = [], [], 0
    for p in range(len(bounds) + 1):
        n = counts.get(p, 0)
        a, b = max(first - at, 0), min(last - at, n)
        if n and a < b:
            (whole if (a, b) == (0, n) else cut).append((p, a, b, n))
        at += n
    found = []
    if whole:  # neighbours, as parts are in order
        found.append(df.filter(between(whole[0][0], whole[-1][0])))
    for p, a, b, n in cut:
        rows = df.filter(between(p, p))
        if n > most and n < total:
            found.append(_slice(rows, order, a, b, most))
        else:
            place = F.col("_position")
            found.append(with_position(rows, *sort, name="_position").filter((place >= a) & (place < b)).drop("_position"))
    return reduce(DataFrame.unionByName, found) if found else df.filter("false")


def row_slice(
    df: DataFrame, start: int | None, stop: int | None, *order: Column | Descending, inclusive: bool = False, sorted_rows: int = SORTED_ROWS
) -> DataFrame:
    """Rows from place ``start`` to before place ``stop`` in ``order``; with ``inclusive`` the end is kept.

    None is the first or last row, and a negative place counts from the end, as in Python.
    Keys rise, nulls first, unless given as ``Descending``; end them with a unique column.

    Rows are counted between bounds that a sample gives. Parts inside the slice are taken as
    they are, and only the two that its ends fall into are sorted, after they have been
    narrowed down in the same way to ``sorted_rows`` or so; the table is not stored.
    """
    if inclusive and stop is not None:
        stop = None if stop == -1 else stop + 1
    names = [f"_key{i}" for i in range(len(order))]
    keys = [(o.column if isinstance(o, Descending) else o).alias(n) for o, n in zip(order, names)]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    return _slice(df.select(row, *keys), list(order), start, stop, sorted_rows).select("_row.*")
