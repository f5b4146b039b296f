"""The data behind histograms, density curves, scatter bins and heat maps."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _present(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None))


def _range_of(df: DataFrame, columns: list[str]) -> Column:
    """Bin range of each column; a single value gets a range of one around it."""
    fields = []
    for c in columns:
        lo, hi = F.min(_present(c)), F.max(_present(c))
        fields += [
            F.when(lo == hi, lo - 0.5).otherwise(lo).alias(f"lo_{c}"),
            F.when(lo == hi, hi + 0.5).otherwise(hi).alias(f"hi_{c}"),
        ]
    return df.agg(F.struct(*fields)).scalar()


def bin_of(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin of ``x``: closed below, open above, the last one closed."""
    step = (hi - lo) / bins
    guess = F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1))
    # Rounding may put a value next to an edge into the neighbouring bin.
    return (
        F.when(x < lo + guess * step, guess - 1)
        .when((guess < bins - 1) & (x >= lo + (guess + 1) * step), guess + 1)
        .otherwise(guess)
        .cast("int")
    )


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Every bin with its edges and count, empty bins included."""
    spread = _range_of(df, [column])
    lo, hi = spread.getField(f"lo_{column}"), spread.getField(f"hi_{column}")
    counts = (
        df.select(_present(column).alias("_x"))
        .filter(F.col("_x").isNotNull())
        .groupBy(bin_of(F.col("_x"), lo, hi, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    places = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    step = (hi - lo) / bins
    return places.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * step).alias("left"),
        F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * step).alias("right"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


MOMENTS = 12  # of a cell of width / 8: what is left out is below 1e-15 of a value's own peak
_CELLS, _REACH = 8, 9  # cells in a bandwidth; bandwidths after which the kernel is below 1e-17 of its peak


def _hermite(gap: Column) -> list[Column]:
    """He_k(gap) / k! for k below MOMENTS, each from the two before it."""
    out = [F.lit(1.0), gap]
    for k in range(2, MOMENTS):
        out.append((gap * out[-1] - out[-2]) / k)
    return out


def density(df: DataFrame, column: str, points: int = 200, bins: int | None = None) -> DataFrame:
    """Gaussian density curve with Scott's bandwidth over the column's range.

    Over the values themselves, or over the centres of ``bins`` equal bins.

    Values are folded to cells of an eighth of a bandwidth, each with the first moments of
    its values about its centre. Around that centre the kernel is a series in those moments,
    which the cell adds to the curve's points within nine bandwidths. So no value meets the
    points, and what leaves a task is a row per cell; the curve differs from the sum over all
    values by rounding (the series and the reach leave out less than 1e-15 of a peak).
    """
    x = _present(column)
    shape = df.agg(
        F.struct(
            F.count(x).alias("n"),
            F.min(x).alias("lo"),
            F.max(x).alias("hi"),
            (F.stddev_samp(x) * F.pow(F.count(x).cast("double"), F.lit(-0.2))).alias("width"),
        )
    ).first()[0]
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    if not shape["n"] or not shape["width"]:  # no values, or none that differ: no curve
        return grid.filter("false").select("point", F.lit(0.0).alias("x"), F.lit(0.0).alias("density"))
    n, lo, hi, width = (shape[f] for f in ("n", "lo", "hi", "width"))
    if bins is None:
        masses = df.select(x.alias("_x"), F.lit(1).alias("_n")).filter(F.col("_x").isNotNull())
    else:
        masses = histogram(df, column, bins).select(((F.col("left") + F.col("right")) / 2).alias("_x"), F.col("n").alias("_n"))
    step, cell = (hi - lo) / (points - 1), width / _CELLS
    placed = masses.withColumn("_cell", F.floor((F.col("_x") - lo) / cell))
    off = (F.col("_x") - lo - (F.col("_cell") + 0.5) * cell) / width
    powers = [F.lit(1.0)]
    for _ in range(MOMENTS - 1):
        powers.append(powers[-1] * off)
    cells = placed.groupBy("_cell").agg(*[F.sum(F.col("_n") * p).alias(f"_m{k}") for k, p in enumerate(powers)])
    centre = (F.col("_cell") + 0.5) * cell  # from ``lo`` on
    first = F.greatest(F.lit(0), F.ceil((centre - _REACH * width) / step))
    last = F.least(F.lit(points - 1), F.floor((centre + _REACH * width) / step))
    near = cells.filter(first <= last).select("*", F.explode(F.sequence(first, last)).alias("point"))
    gap = (F.col("point") * step - centre) / width
    series = reduce(lambda a, b: a + b, [F.col(f"_m{k}") * h for k, h in enumerate(_hermite(F.col("_gap")))])
    sums = near.withColumn("_gap", gap).groupBy("point").agg(F.sum(F.exp(F.col("_gap") * F.col("_gap") * -0.5) * series).alias("_sum"))
    found = grid.join(F.broadcast(sums.withColumnRenamed("point", "_point")), F.col("point") == F.col("_point"), "left")  # a row per point
    height = F.coalesce("_sum", F.lit(0.0)) / (n * width * math.sqrt(2 * math.pi))
    return found.select("point", (F.lit(lo) + F.col("point") * step).alias("x"), height.alias("density"))


def bins_2d(
    df: DataFrame, pairs: list[tuple[str, str]], bins: int = 10, hue: str | None = None
) -> DataFrame:
    """Counts of the filled cells for each pair of columns, in one scan."""
    columns = sorted({c for pair in pairs for c in pair})
    spread = _range_of(df, columns)
    names = ["hue"] if hue else []
    binned = df.select(
        *([F.col(hue).alias("hue")] if hue else []),
        *[
            bin_of(_present(c), spread.getField(f"lo_{c}"), spread.getField(f"hi_{c}"), bins).alias(f"_bin_{c}")
            for c in columns
        ],
    )
    # The pairs of a row are counted by its task: at most bins * bins groups per pair and hue.
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("x"), F.lit(b).alias("y"),
                F.col(f"_bin_{a}").alias("x_bin"), F.col(f"_bin_{b}").alias("y_bin"),
            )
            for a, b in pairs
        ]
    )
    return (
        binned.select(*names, F.inline(cells))
        .filter("x_bin IS NOT NULL AND y_bin IS NOT NULL")
        .groupBy(*names, "x", "y", "x_bin", "y_bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


_FIGURES = ("n", "x", "y", "xx", "yy", "xy")
_BLOCK_ROWS = 4096


def co_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (a, n, x, y, xx, yy, xy) of arrays over all columns: for column ``a`` and each other one, the rows
    that have both, and the sums of both values, their squares and their product over those rows.

    Values are taken from the column's mean first, so the sums keep their digits. Each task lays
    its rows out as dense blocks and adds up four matrix products per block; the tasks' rows for a column
    are added by the task that the column is dealt to.
    """
    width = len(columns)
    numbers = df.select(F.array(*[_present(f"`{c}`") for c in columns]).alias("x"))
    means = df.agg(F.array(*[F.avg(_present(f"`{c}`")) for c in columns])).first()[0]
    mean = F.array(*[F.lit(m or 0.0) for m in means])
    centred = numbers.select(F.zip_with("x", mean, lambda x, m: x - m).alias("x"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK_ROWS):
                values = batch.column(0).slice(at, _BLOCK_ROWS).flatten()
                there = np.asarray(values.is_valid()).reshape(-1, width).astype(float)
                z = values.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, width)
                square, part = (z * z).T @ there, z.T @ there
                found = (there.T @ there, part, part.T, square, square.T, z.T @ z)
                sums = found if sums is None else [s + f for s, f in zip(sums, found)]
        if sums is not None:
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(s).ravel()), width).cast(pa.list_(pa.float64())) for s in sums]
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), *lists], names=["a", *_FIGURES])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of ``a``, one result at a time."""
        column, sums = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([column], pa.int32()), *[pa.array([s.tolist()]) for s in sums]], names=["a", *_FIGURES])

        for batch in batches:
            lists = [batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for i in range(1, 7)]
            for at, a in enumerate(batch.column(0).to_pylist()):
                found = [x[at] for x in lists]
                if a == column:
                    sums = [s + f for s, f in zip(sums, found)]
                    continue
                if column is not None:
                    yield row()
                column, sums = a, found
        if column is not None:
            yield row()

    schema = "a int, " + ", ".join(f"{f} array<double>" for f in _FIGURES)
    parts = centred.mapInArrow(blocks, schema)
    return parts.repartition("a").sortWithinPartitions("a").mapInArrow(merged, schema)


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair, as (a, b, r), in one scan for any number of columns.

    Rows with a missing value are left out of the pairs they would belong to. ``r`` is null
    for fewer than two rows and where one of the columns does not vary over them.
    """
    names = F.array(*[F.lit(c) for c in columns])
    laid = co_moments(df, columns).select("a", F.posexplode(F.arrays_zip(*_FIGURES)).alias("b", "s"))
    n = F.col("s.n")
    both = F.col("s.xy") - F.col("s.x") * F.col("s.y") / n
    own = F.col("s.xx") - F.col("s.x") * F.col("s.x") / n, F.col("s.yy") - F.col("s.y") * F.col("s.y") / n
    # A column that does not vary leaves nothing but rounding of its squares.
    varies = (own[0] > F.col("s.xx") * 1e-14) & (own[1] > F.col("s.yy") * 1e-14)
    r = F.when((n > 1) & varies, F.least(F.lit(1.0), F.greatest(F.lit(-1.0), both / F.sqrt(own[0] * own[1]))))
    return laid.select(F.get(names, F.col("a")).alias("a"), F.get(names, F.col("b")).alias("b"), F.when(F.col("a") == F.col("b"), r * 0 + 1).otherwise(r).alias("r"))
